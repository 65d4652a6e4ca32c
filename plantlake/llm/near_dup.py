"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

Rows with the same shingle set are one *class*; everything after the first aggregation works on classes, so a group
of exact copies costs one row however large it is.  Each class has a one-permutation signature (the least hash in
each of ``SLOTS`` bins of the hash range; an empty bin borrows from the first filled bin of its own pseudo-random
sequence).  Bands of the signature give buckets.  In each bucket all classes are paired with the least one only (a
star), and these pairs are confirmed on the full shingle sets of their texts.

A star can miss a link between two members whose hub is similar to only one of them.  So buckets whose members are
still in several components get a second look: their cross-component pairs are compared inside the task that holds
the bucket (large buckets are dealt out in blocks), each pair only in the first bucket it shares, and only pairs
whose sketches come near the threshold leave the task to be confirmed on full sets.  Pairs that are in one component
already are never compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, packed, part_count, per_batch
from .graph import connected_components
from .wordhash import shingle_sets, words

SLOTS = 128  # signature length
ROWS = 4  # slots in a band: 32 bands; two sets of similarity 0.8 share no bucket with probability below 1e-7
BANDS = SLOTS // ROWS
SKETCH = 512  # least hashes kept of a set when pairs are looked at again; smaller sets are kept whole
BLOCK = 2048  # classes of one bucket that one task compares with as many others
SIGMAS = 4.5  # a pair is set aside unconfirmed only if its estimate is so many standard deviations too low

_TRIES = np.random.default_rng(11).integers(0, SLOTS, (SLOTS, 512))


def signature(shingles: np.ndarray) -> np.ndarray:
    """One-permutation signature of a sorted, non-empty set of 64-bit shingles, 16 bits a slot."""
    bins = (shingles >> np.uint64(57)).astype(np.int64)
    first = np.searchsorted(bins, np.arange(SLOTS))
    full = first < len(bins)
    full[full] = bins[first[full]] == np.flatnonzero(full)
    out = np.zeros(SLOTS, dtype=np.uint16)
    out[full] = (shingles[first[full]] >> np.uint64(9)).astype(np.uint16)
    empty = np.flatnonzero(~full)
    if len(empty):
        hits = full[_TRIES[empty]]
        at = _TRIES[empty, hits.argmax(axis=1)]
        none = ~hits.any(axis=1)
        at[none] = np.flatnonzero(full)[0]
        out[empty] = out[at]
    return out


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _classify(n: int, with_signature: bool):
    """Arrow function over (id, text): adds n_shingles, cls (null without words) and the signature."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, signatures = [], [], []
        for chunk in words(batch.column("__text")):
            for shingles in shingle_sets(chunk, n):
                sizes.append(len(shingles))
                keys.append(set_key(shingles) if len(shingles) else None)
                if with_signature:
                    signatures.append(signature(shingles).tobytes() if len(shingles) else None)
        kept = [name for name in batch.schema.names if name != "__text"]
        columns = [batch.column(name) for name in kept] + [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())]
        names = [*kept, "__n", "__cls"]
        if with_signature:
            columns.append(pa.array(signatures, pa.binary()))
            names.append("__sig")
        return pa.RecordBatch.from_arrays(columns, names=names)

    return per_batch(run)


def with_classes(df: DataFrame, text: str, n: int, signatures: bool = False) -> DataFrame:
    """``df`` without ``text`` (its other columns as they are), with ``__n``, ``__cls`` and, if asked for, ``__sig``."""
    rest = df.drop(text)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    schema = f"{fields}, __n bigint, __cls binary" + (", __sig binary" if signatures else "")
    source = df.select(*rest.columns, F.col(text).cast("string").alias("__text"))
    return source.mapInArrow(_classify(n, signatures), schema)


def _margin(threshold: float, slots: int, n: np.ndarray) -> np.ndarray:
    """How far an estimate from ``slots`` samples of sets of ``n`` members may fall below a true ``threshold``."""
    return SIGMAS * np.sqrt(threshold * (1 - threshold) * (1 / slots + 1 / np.maximum(n, 1)))


def _blobs(column: pa.Array, dtype) -> np.ndarray:
    """Equal-length binary values as the rows of one matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def _plausible(threshold: float):
    """Star pairs whose sizes and signatures allow the threshold."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
        same = (_blobs(batch.column("sig_a"), np.uint16) == _blobs(batch.column("sig_b"), np.uint16)).mean(axis=1)
        low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
        keep = (low >= threshold * high - 1e-9) & (same >= threshold - _margin(threshold, SLOTS, high))
        return batch.select(["a", "b"]).filter(pa.array(keep))

    return per_batch(run)


def _confirm(n: int, num: int, den: int):
    """Pairs whose full shingle sets reach num/den."""

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        return (s for chunk in words(column) for s in shingle_sets(chunk, n))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(sets(batch.column("text_a")), sets(batch.column("text_b")), strict=True):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(den * shared >= num * (len(x) + len(y) - shared) and shared > 0)
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return per_batch(run)


def _texts(wanted: int):
    """Rows (node, cls, id, text): those whose text has the class's set, and so may stand for it."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, sketches = [], []
        expected = batch.column("cls").to_pylist()
        i = 0
        for chunk in words(batch.column("text")):
            for shingles in shingle_sets(chunk, wanted):
                keep.append(len(shingles) > 0 and set_key(shingles) == expected[i])
                sketches.append((np.sort(shingles << np.uint64(7))[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes())
                i += 1
        out = pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("text"), pa.array(sketches, pa.binary())], names=["node", "text", "sketch"]
        )
        return out.filter(pa.array(keep, pa.bool_()))

    return per_batch(run)


def _sketch_similarity(x: np.ndarray, y: np.ndarray, n_x: int, n_y: int) -> tuple[float, int]:
    """Estimate from the least hashes of two sets, and its sample size (0: exact)."""
    if n_x <= SKETCH and n_y <= SKETCH:
        shared = len(np.intersect1d(x, y))
        return shared / max(1, n_x + n_y - shared), 0
    least = np.union1d(x, y)[:SKETCH]
    return len(np.intersect1d(np.intersect1d(least, x), y)) / len(least), len(least)


def _cross_pairs(threshold: float):
    """Rows (bucket, block, side, band, node, root, n, sig, sketch), sorted by bucket and block: near pairs."""

    def block_pairs(rows: dict[str, list], diagonal: bool) -> list[tuple[int, int]]:
        node, root, n = (np.array(rows[c], dtype=np.int64) for c in ("node", "root", "n"))
        sig = np.frombuffer(b"".join(rows["sig"]), dtype=np.uint16).reshape(len(node), -1)
        bands = sig.view(np.uint64)
        sketch = [np.frombuffer(x, dtype=np.uint32) for x in rows["sketch"]]
        side, band, found = np.array(rows["side"]), rows["band"][0], []
        for i in range(len(node)):
            if not diagonal and side[i] != 0:
                continue
            others = np.arange(i + 1, len(node)) if diagonal else np.flatnonzero(side == 1)
            others = others[root[others] != root[i]]
            low, high = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
            others = others[low >= threshold * high - 1e-9]
            if not len(others):
                continue
            same = (sig[others] == sig[i]).mean(axis=1)
            near = same >= threshold - _margin(threshold, SLOTS, np.maximum(n[others], n[i]))
            near &= (bands[others] == bands[i]).argmax(axis=1) == band  # the first bucket that they share
            for j in others[near]:
                estimate, sample = _sketch_similarity(sketch[i], sketch[j], int(n[i]), int(n[j]))
                slack = SIGMAS * sqrt(threshold * (1 - threshold) / sample) if sample else 0.005
                if estimate >= threshold - slack:
                    found.append((int(node[i]), int(node[j])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("side", "band", "node", "root", "n", "sig", "sketch")
        key, rows = None, {c: [] for c in names}

        def flush() -> pa.RecordBatch | None:
            pairs = block_pairs(rows, key[1] == key[2]) if key is not None and len(rows["node"]) > 1 else []
            if not pairs:
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                if (now := (row["bucket"], row["low"], row["high"])) != key:
                    if (out := flush()) is not None:
                        yield out
                    key, rows = now, {c: [] for c in names}
                for c in names:
                    rows[c].append(row[c])
        if (out := flush()) is not None:
            yield out

    return run


def near_duplicate_components(docs: DataFrame, id_col: str, text: str, n: int, num: int, den: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): ``rows`` has id, ``__n`` and ``__cls`` for each input row; ``classes`` maps ``__cls`` to its ``least``
    id and its ``component``.

    Two rows are linked if den * |A and B| >= num * |A or B| over their n-word shingle sets.  ``component`` is the
    least id that can be reached.  Rows without words have a null class; rows with a null id link nothing, but rows
    that repeat a text or an id share one class or appear in several without harm.  An empty table gives empty results.
    What is written on the way has ``parts`` files at most.
    """
    threshold = num / den
    base = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text).alias("__t"))
    signed = with_classes(base, "__t", n, signatures=True)
    rows = checkpoint(signed, parts)
    classes = (
        rows.where("__cls is not null and __id is not null")
        .groupBy("__cls")
        .agg(F.min("__id").alias("least"), F.first("__n").alias("n"), F.first("__sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = checkpoint(classes.withColumnRenamed("__cls", "cls"), parts)  # node numbers are fixed from here on
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.col("sig").substr(b * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("bucket")))
    in_bucket = Window.partitionBy("bucket")
    members = checkpoint(
        classes.select("node", F.explode(bands).alias("b"))
        .select("node", "b.band", "b.bucket")
        .withColumn("hub", F.min("node").over(in_bucket))
        .withColumn("size", F.count("*").over(in_bucket))
        .where("size > 1"),
        parts,
    )
    facts = classes.select("node", "n", "sig")
    star = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    star = (
        star.join(facts.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "a")
        .join(facts.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "b")
        .mapInArrow(_plausible(threshold), "a bigint, b bigint")
    )
    # texts of the classes that share a bucket with another one: one row for each
    shared = members.select("node").distinct().join(classes.select("node", "cls", F.col("least").alias("__id")), "node")
    texts = checkpoint(
        base.where("__id is not null")
        .join(shared, "__id")
        .select("node", "cls", F.col("__t").cast("string").alias("text"))
        .mapInArrow(_texts(n), "node bigint, text string, sketch binary"),
        parts,
    )
    pick = texts.select("node", "text").dropDuplicates(["node"])

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(pick.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
            pick.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
        )
        return both.mapInArrow(_confirm(n, num, den), "a bigint, b bigint")

    links = checkpoint(confirmed(star), parts)
    roots = checkpoint(connected_components(links, "a", "b"), parts)
    # buckets whose members, the hub aside, are in several components
    open_members = (
        members.where("size > 2 and node <> hub")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("lowest", F.min("root").over(in_bucket))
        .withColumn("highest", F.max("root").over(in_bucket))
        .where("lowest <> highest")
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK)).cast("int")
    sketches = texts.select("node", "sketch").dropDuplicates(["node"])
    dealt = (
        open_members.join(facts, "node")
        .join(sketches, "node")
        .withColumn("mine", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "bucket",
            F.least("mine", "other").alias("low"),
            F.greatest("mine", "other").alias("high"),
            F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"),
            *("band", "node", "root", "n", "sig", "sketch"),
        )
    )
    again = (
        dealt.repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(_cross_pairs(threshold), "a bigint, b bigint")
        .distinct()
    )
    more = checkpoint(confirmed(again), parts)
    if not more.isEmpty():
        merged = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
        roots = checkpoint(connected_components(merged, "a", "b"), parts)
    labelled = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component"))
    return rows.drop("__sig"), labelled.join(least, "root").select(F.col("cls").alias("__cls"), "least", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    A row without words (or a null text) has the empty set and is its own component.  A row with a null id has a null
    component and is kept: nothing can point at it.
    """
    parts = part_count(docs, text)
    rows, classes = near_duplicate_components(docs, id_col, text, n, num, den, parts)
    component = F.coalesce("component", "__id")
    out = rows.join(classes, "__cls", "left").withColumn("component", F.when(F.col("__id").isNotNull(), component))
    return out.coalesce(parts).select(
        F.col("__id").alias(id_col),
        F.col("__n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("__id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs``, one for each near-duplicate component: the one with the least id.

    Rows that repeat that id are settled by their content, so exactly one stays.  Rows without words or with a null
    id are linked with nothing and all stay.
    """
    parts = part_count(docs, text)
    _, classes = near_duplicate_components(docs, id_col, text, n, num, den, parts)
    names = docs.columns
    content = F.xxhash64("__rest")
    first = Window.partitionBy("component").orderBy("__cls")
    chosen = classes.where("least = component").withColumn("at", F.row_number().over(first)).where("at = 1")
    chosen = chosen.select(F.col("__cls").alias("__key"), F.col("component").alias("__id"), F.lit(True).alias("__hit"))
    # rows without words spread over all partitions; the text is moved once
    key = F.coalesce("__cls", F.concat(F.lit("none"), content.cast("string")).cast("binary"))
    moved = docs.select(packed(docs, names).alias("__rest"), F.col(f"`{text}`").alias("__t"), F.col(f"`{id_col}`").cast("long").alias("__id"))
    every = with_classes(moved, "__t", n).withColumn("__key", key)
    joined = every.join(chosen.hint("merge"), ["__key", "__id"], "left")
    alone = F.col("__cls").isNull() | F.col("__id").isNull()
    order = Window.partitionBy("__key", "__id").orderBy(content)
    kept = joined.where(alone | F.col("__hit")).withColumn("__at", F.row_number().over(order)).where(alone | (F.col("__at") == 1))
    return kept.coalesce(parts).select(*[F.col(f"__rest.`{c}`").alias(c) for c in names])
