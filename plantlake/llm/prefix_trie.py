"""The prefix trie of all conversations, built from adaptive radix trees.

A turn becomes a big-endian id of ``ID_BYTES`` bytes and a conversation the string of its turns' ids, so prefixes of
conversations are byte prefixes at multiples of the id's width.  Spark groups equal conversations, range-partitions the
distinct strings in order and tells every part the last string before it and the first one after it.  A part builds
one adaptive radix tree (children in a layout of 4, 16, 48 or 256 places that grows as needed, paths without branches
compressed) and walks it from the leaves up; only depths on a turn's border emit nodes.

Prefixes that reach over a part's border are emitted by each part that holds them.  Because a part knows its
neighbours' nearest strings, it knows which of these prefixes it is the first to hold and whether its last string goes on
behind the border, so all their counts add up: one aggregation over at most two paths per part completes them.  Nothing
else is shuffled again, and no node needs more than its own part.

Turn ids are the first 16 bytes of SHA-256 sums; turns with equal ids count as equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

ID_BYTES = 16
PART_TURNS = 100_000  # turns, before sharing, that a part is planned to hold
FEW_OPEN = 1_000_000  # nodes on part borders that are broadcast to find parents; more are joined by a shuffle
CHUNK_BYTES = 1 << 20  # text of conversation ids handed on as one row
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """32 hexadecimal digits that stand for a turn."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * ID_BYTES)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, ``turns``: array<struct<id, chars>> in the order of turns.

    Null turns come first; rows of one turn are ordered by role and id, repeated rows all stay.  Null roles and texts
    are empty.  Rows without a conversation id belong to none and are left out.  Texts are not shuffled, only ids and
    lengths; a conversation's ids fit in one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), role.alias("role"), turn_id(role, text).alias("id"), F.length(text).alias("chars")
        ).alias("t"),
    ).where("conv_id is not null")
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def with_shared_heads(seqs: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % group.

    h is the unsigned CRC-32 of c's decimal digits modulo ``heads``.  All of the other's turns are taken if it has fewer,
    none if it is absent; own turns follow after the first h.
    """
    own, head = F.col("turns"), F.col("conv_id") - F.col("conv_id") % group
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    placed = seqs.withColumns({"__head": head, "__h": h})
    mine = F.when(F.col("conv_id") == F.col("__head"), F.slice(own, 1, heads))
    shared_head = F.coalesce(F.first(mine, ignorenulls=True).over(Window.partitionBy("__head")), F.slice(own, 1, 0))
    rest = F.slice(own, F.col("__h") + 1, F.greatest(F.size(own) - F.col("__h"), F.lit(0)))
    return placed.withColumn("__shared", shared_head).select("conv_id", F.concat(F.slice("__shared", F.lit(1), F.col("__h")), rest).alias("turns"))


class Layout4:
    """Children under up to ``room`` bytes, in order."""

    room = 4

    def __init__(self, keys: bytes = b"", kids: tuple = ()) -> None:
        self.keys, self.kids = bytearray(keys), list(kids)

    def get(self, byte: int) -> Node | None:
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid: Node) -> None:
        at = self.keys.find(byte)
        if at >= 0:
            self.kids[at] = kid
            return
        at = sum(k < byte for k in self.keys)
        self.keys.insert(at, byte)
        self.kids.insert(at, kid)

    def full(self) -> bool:
        return len(self.keys) == self.room

    def grown(self) -> Layout16 | Layout48:
        return Layout16(bytes(self.keys), tuple(self.kids))

    def children(self) -> list[Node]:
        return self.kids


class Layout16(Layout4):
    room = 16

    def grown(self) -> Layout48:
        wide = Layout48()
        for byte, kid in zip(self.keys, self.kids, strict=True):
            wide.put(byte, kid)
        return wide


class Layout48:
    """A table of 256 places that point into up to 48 children."""

    def __init__(self) -> None:
        self.place, self.kids = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        at = self.place[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid: Node) -> None:
        at = self.place[byte]
        if at:
            self.kids[at - 1] = kid
            return
        self.kids.append(kid)
        self.place[byte] = len(self.kids)

    def full(self) -> bool:
        return len(self.kids) == 48

    def grown(self) -> Layout256:
        wide = Layout256()
        for byte in range(256):
            if self.place[byte]:
                wide.put(byte, self.kids[self.place[byte] - 1])
        return wide

    def children(self) -> list[Node]:
        return [self.kids[at - 1] for at in self.place if at]


class Layout256:
    def __init__(self) -> None:
        self.kids: list = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        self.kids[byte] = kid

    def full(self) -> bool:
        return False

    def children(self) -> list[Node]:
        return [kid for kid in self.kids if kid is not None]


class Node:
    """The strings that begin with the first ``depth`` bytes of string ``model``; ``end`` is the one that ends there."""

    __slots__ = ("model", "depth", "end", "below")

    def __init__(self, model: int, depth: int, end: int | None = None) -> None:
        self.model, self.depth, self.end, self.below = model, depth, end, None

    def get(self, byte: int) -> Node | None:
        return self.below.get(byte) if self.below is not None else None

    def put(self, byte: int, kid: Node) -> None:
        if self.below is None:
            self.below = Layout4()
        elif self.below.full() and self.below.get(byte) is None:
            self.below = self.below.grown()
        self.below.put(byte, kid)

    def children(self) -> list[Node]:
        return self.below.children() if self.below is not None else []


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def radix_tree(keys: list[bytes]) -> Node:
    """An adaptive radix tree of distinct byte strings, which may be prefixes of each other."""
    root = Node(0, 0)
    for i, key in enumerate(keys):
        node, parent, at = root, None, 0
        while True:
            path = keys[node.model]
            if path[at : node.depth] != key[at : node.depth]:  # leaves the compressed path, or ends on it
                fork = Node(node.model, at + shared(path[at : node.depth], key[at : node.depth]))
                parent.put(key[parent.depth], fork)
                fork.put(path[fork.depth], node)
                node = fork
            if len(key) == node.depth:
                node.end = i
                break
            at = node.depth
            kid = node.get(key[at])
            if kid is None:
                node.put(key[at], Node(i, len(key), i))
                break
            parent, node = node, kid
    return root


class Part:
    """The trie nodes of one part of the sorted strings."""

    def __init__(self, keys: list[bytes], chars: list[list[int]], counts: list[int], firsts: list[int], before: bytes | None, after: bytes | None) -> None:
        self.keys, self.chars, self.counts, self.firsts = keys, chars, counts, firsts
        # byte depths down to which the first and the last path are also held by a part before or after
        self.held_before = -1 if before is None else shared(before, keys[0]) // ID_BYTES * ID_BYTES
        self.held_after = -1 if after is None else shared(keys[-1], after) // ID_BYTES * ID_BYTES
        self.goes_on = after is not None and after.startswith(keys[-1])
        self.rows: list[list] = []

    def emit(self) -> list[list]:
        """One row a node: depth, conv_id, n_convs, n_children, n_leaves, saved, n_ends, end_id, open, parent's row, path."""
        root = radix_tree(self.keys)
        order, stack = [], [(root, None)]
        while stack:
            node, parent = stack.pop()
            at = len(order)
            order.append((node, parent))
            stack.extend((kid, at) for kid in node.children())
        # what comes up from the children: members, least id, leaves, saved, new children, any children, least and
        # greatest string, rows that wait for their parent
        held = [[0, None, 0, 0, 0, False, None, None, []] for _ in order]
        for i in range(len(order) - 1, -1, -1):
            (node, parent), up = order[i], held[i]
            if node.end is not None:
                self._merge(up, [self.counts[node.end], self.firsts[node.end], 0, 0, 0, False, node.end, node.end, []])
            self._edge(node, -1 if parent is None else order[parent][0].depth, up)
            if parent is not None:
                self._merge(held[parent], up)
            held[i] = None
        return self.rows

    @staticmethod
    def _merge(into: list, up: list) -> None:
        into[0] += up[0]
        into[1] = up[1] if into[1] is None else min(into[1], up[1])
        for k in (2, 3, 4):
            into[k] += up[k]
        into[5] = into[5] or up[5]
        into[6] = up[6] if into[6] is None else min(into[6], up[6])
        into[7] = up[7] if into[7] is None else max(into[7], up[7])
        into[8].extend(up[8])

    def _edge(self, node: Node, above: int, up: list) -> None:
        """The nodes at turn borders between the parent's depth and this one's, from the lowest up."""
        members, least, low, high = up[0], up[1], up[6], up[7]
        for at in range(node.depth // ID_BYTES * ID_BYTES, above, -ID_BYTES):
            depth = at // ID_BYTES
            size = self.chars[node.model][depth - 1] if depth else 0
            here = at == node.depth and node.end is not None
            if not up[5] and not (self.goes_on and high == len(self.keys) - 1):
                up[2] = 1
            new = not (low == 0 and at <= self.held_before)
            is_open = not new or (high == len(self.keys) - 1 and at <= self.held_after)
            up[3] += (members - new) * size
            ends = (self.counts[node.end], self.firsts[node.end]) if here else (0, None)
            row = len(self.rows)
            for waiting in up[8]:
                self.rows[waiting][9] = row
            self.rows.append([depth, least, members, up[4], up[2], up[3], *ends, is_open, None, (node.model, at)])
            up[4], up[5], up[8] = int(new), True, [row]


NODE_FIELDS = (
    "node binary, parent binary, is_open boolean, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, n_ends bigint, end_id bigint"
)
_ARROW = pa.schema(
    [(n, pa.binary() if t == "binary" else pa.bool_() if t == "boolean" else pa.int64()) for n, t in (f.split() for f in NODE_FIELDS.split(", "))]
)


def digest(path: bytes) -> bytes:
    return hashlib.sha256(path).digest()[:ID_BYTES]


def _nodes_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The nodes of one part from its rows (kind, key, chars, n, first)."""
    before = after = None
    keys, chars, counts, firsts = [], [], [], []
    for kind, key, lengths, n, first in rows:
        if kind == 0:
            before = key
        elif kind == 2:
            after = key
        else:
            keys.append(key)
            chars.append(lengths)
            counts.append(n)
            firsts.append(first)
    if not keys:
        return
    out = Part(keys, chars, counts, firsts, before, after).emit()
    paths: dict[tuple[int, int], bytes] = {}

    def name(row: list) -> bytes:
        model, at = row[10]
        if row[10] not in paths:
            paths[row[10]] = digest(keys[model][:at])
        return paths[row[10]]

    columns = [[] for _ in _ARROW]
    for row in out:
        depth, conv, members, kids, leaves, saved, ends, end_id, is_open, parent, _ = row
        above = out[parent] if parent is not None else None
        known = above is not None and not above[8]
        values = (
            name(row) if is_open or ends > 1 else None,
            name(above) if above is not None and above[8] else None,
            is_open,
            depth,
            conv,
            above[1] if known else None,
            members,
            kids,
            leaves,
            saved,
            ends,
            end_id,
        )
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "kind", "key", "chars", "n", "first")]
        for p, *row in zip(*columns, strict=True):
            if p != part:
                yield from _nodes_of(rows)
                part, rows = p, []
            rows.append(tuple(row))
    yield from _nodes_of(rows)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) -> (node, first, text): runs of ids, comma-joined; a run of one inside a task is dropped."""
    node, first, ids, size, begun, edge = None, None, [], 0, False, True
    out: list[tuple[bytes, int, str]] = []

    def flush(last: bool) -> None:
        nonlocal ids, size, begun, edge
        if ids and (begun or edge or last or len(ids) > 1):
            out.append((node, first, ",".join(map(str, ids))))
        ids, size, begun = [], 0, True

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=["node", "first", "text"])

    for batch in batches:
        for n, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if n != node:
                flush(False)
                edge, begun = node is None, False
                node = n
            elif size > CHUNK_BYTES:
                flush(False)
            if not ids:
                first = conv
            ids.append(conv)
            size += len(str(conv)) + 1
        if out:
            yield batch_of()
    flush(True)
    if out:
        yield batch_of()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks -> one SHA-256 sum a node, read as a stream."""
    node, state = None, None
    for batch in batches:
        done = []
        for n, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if n != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = n, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if done:
            yield _named_sums(done)
    if state is not None:
        yield _named_sums([(node, state.hexdigest())])


def _named_sums(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    names, sums = zip(*done, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums, pa.string())], names=["node", "ends_sha256"])


def _parts(keys: DataFrame, parts: int) -> DataFrame:
    """Strings dealt in order to parts, each with its neighbours' nearest strings as rows of kind 0 and 2."""
    ranged = checkpoint(keys.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()))
    edges = ranged.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))  # one row a part
    order = Window.orderBy("part")
    edges = edges.select("part", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("chars", "array<int>"), ("n", "bigint"), ("first", "bigint"))]
    marks = [
        edges.where(F.col(c).isNotNull()).select("part", F.lit(kind).alias("kind"), F.col(c).alias("key"), *none)
        for kind, c in ((0, "before"), (2, "after"))
    ]
    own = ranged.select("part", F.lit(1).alias("kind"), "key", "chars", "n", "first")
    return own.unionByName(marks[0]).unionByName(marks[1]).repartition(parts, "part").sortWithinPartitions("part", "kind", "key")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """conv_id, ``turns`` (array<struct<id, chars>>, ids of 32 hexadecimal digits) -> one row for each distinct prefix.

    Returns conv_id (least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.  A conversation without turns ends at the root; equal conversations share a node and
    are each counted; an empty table has no nodes, not even a root.  Conversation ids are distinct.
    """
    rows = checkpoint(
        convs.select(
            "conv_id",
            F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"),
            F.transform("turns", lambda t: t["chars"].cast("int")).alias("chars"),
        )
    )
    turns = rows.agg(F.sum(F.size("chars") + 1).alias("n")).first()["n"] or 0
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"), F.first("chars").alias("chars"))
    nodes = checkpoint(_parts(keys, max(1, -(-turns // PART_TURNS))).mapInArrow(_build, NODE_FIELDS))

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends")]
    borders = nodes.where("is_open").groupBy("node")
    borders = borders.agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("end_id").alias("end_id"), *sums
    )
    borders = checkpoint(borders.withColumns({"is_open": F.lit(True), "parent_conv_id": F.lit(None).cast("bigint")}))
    whole = nodes.where("not is_open").unionByName(borders)
    parents = borders.select(F.col("node").alias("parent"), F.col("conv_id").alias("__least"))
    if borders.count() <= FEW_OPEN:
        parents = F.broadcast(parents)
    placed = whole.where("parent is null").unionByName(
        whole.where("parent is not null").join(parents, "parent").withColumn("parent_conv_id", F.col("__least")).drop("__least")
    )

    named = rows.select(F.unhex(F.substring(F.sha2("key", 256), 1, 2 * ID_BYTES)).alias("node"), "conv_id")
    chunks = named.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(_chunks, "node binary, first bigint, text string")
    ends = chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_sums, "node binary, ends_sha256 string")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    one = F.when(F.col("n_ends") == 1, F.sha2(F.col("end_id").cast("string").cast("binary"), 256)).otherwise(F.lit(EMPTY_SHA))
    few = placed.where("n_ends < 2").select(*names, one.alias("ends_sha256"))
    return few.unionByName(placed.where("n_ends > 1").join(ends, "node").select(*names, "ends_sha256"))
