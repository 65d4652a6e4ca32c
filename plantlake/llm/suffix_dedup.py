"""Repeated passages by a sparse suffix array.

Suffixes are kept only where a text's content selects them: at the least hash of ``SEED``-word windows in every
``MIN_WORDS - SEED + 1`` neighbouring ones (minimisers), so any two texts that share ``MIN_WORDS`` words keep a suffix at
the same place of the shared passage.  Suffixes whose first ``SEED`` words occur nowhere else are dropped by an
aggregated count.  The others, with the words that follow and precede them, are range-sorted by content over all
partitions.  Neighbours are compared to the right in this order and, in the order of the words before them, to the left;
from these common lengths follows which suffixes share a passage of ``MIN_WORDS`` words around the seed, also those that
are not next to each other.  Suffixes with the same first words stand together and are decided where they are.  Where
they may go on beyond a batch, suffixes that share the same passages form a team, and each team's passages, once, and
those that no other text of the batch has are met by their 64-bit hashes with those of other batches.
Longer passages are covered by the overlapping spans of their suffixes, which are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, part_count, per_batch
from .wordhash import Words, mix, words

MIN_WORDS = 50
SEED = 24
_COEFFICIENTS = np.random.default_rng(20240301).integers(1, 2**63, (2, MIN_WORDS - SEED), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BY_PLACE = np.random.default_rng(20240302).integers(1, 2**63, MIN_WORDS - SEED + 1, dtype=np.uint64)  # tells apart how many words stand before


def minimisers(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the least hash (the last of equal ones) in every ``span`` neighbouring windows, each once."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    span = min(span, n)
    # least of [i, i + span) from two tables of block-wise running minima
    key = (hashes & ~np.uint64(0xFFFFF)) | (np.uint64(0xFFFFF) - (np.arange(n, dtype=np.uint64) & np.uint64(0xFFFFF)))
    blocks = -(-n // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = key
    grid = padded.reshape(blocks, span)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    first = np.arange(n - span + 1)
    least = np.minimum(right[first], left[first + span - 1])
    chosen = np.unique(least)
    order = np.argsort(key, kind="stable")
    return np.sort(order[np.searchsorted(key, chosen, sorter=order)])


def _row_windows(chunk: Words, n: int) -> Iterator[tuple[int, np.ndarray]]:
    hashes, offsets = chunk.windows(n)
    for i in range(len(chunk)):
        yield i, hashes[offsets[i] : offsets[i + 1]]


def seeds(docs: DataFrame) -> DataFrame:
    """(id, text) -> id, at, key: selected suffixes and the hash of their first words.  Texts under ``MIN_WORDS`` have none."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, at, keys = [], [], []
        for chunk in words(batch.column("text")):
            for i, hashes in _row_windows(chunk, SEED):
                if len(hashes) >= MIN_WORDS - SEED + 1:
                    places = minimisers(hashes, MIN_WORDS - SEED + 1)
                    rows.append(np.full(len(places), chunk.first + i))
                    at.append(places)
                    keys.append(hashes[places])
        rows, at, keys = (np.concatenate(x) if x else np.zeros(0, dtype=t) for x, t in ((rows, np.int64), (at, np.int64), (keys, np.uint64)))
        return pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(rows.astype(np.int64))), pa.array(at.astype(np.int32)), pa.array(keys.view(np.int64))], names=["id", "at", "key"])

    return docs.mapInArrow(per_batch(run), "id bigint, at int, key bigint")


def _contexts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(id, text, places) -> key, right, left, id, at: words after the seed and, backwards, before it.

    Words are 32 bits of their hash, big-endian, so that binary order is word order; a missing word is 0.
    """
    side = MIN_WORDS - SEED
    places = batch.column("places").to_pylist()
    out: dict[str, list] = {c: [] for c in ("key", "right", "left", "id", "at")}
    ids = batch.column("id").to_pylist()
    for chunk in words(batch.column("text")):
        for i, hashes in _row_windows(chunk, SEED):
            own = chunk.hashes[chunk.offsets[i] : chunk.offsets[i + 1]] >> np.uint64(32)
            padded = np.concatenate([np.zeros(side, np.uint64), np.maximum(own, 1), np.zeros(side, np.uint64)]).astype(">u4")
            at = np.array([p for p in places[chunk.first + i] or [] if p < len(hashes)], dtype=np.int64)
            right = padded[at[:, None] + side + SEED + np.arange(side)]
            left = padded[at[:, None] + side - 1 - np.arange(side)]
            out["key"].append(hashes[at].view(np.int64))
            out["right"].extend(r.tobytes() for r in right)
            out["left"].extend(r.tobytes() for r in left)
            out["id"].extend([ids[chunk.first + i]] * len(at))
            out["at"].append(at.astype(np.int32))
    key = np.concatenate(out["key"]) if out["key"] else np.zeros(0, np.int64)
    at = np.concatenate(out["at"]) if out["at"] else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(out["right"], pa.binary()), pa.array(out["left"], pa.binary()), pa.array(out["id"], pa.int64()), pa.array(at)],
        names=["key", "right", "left", "id", "at"],
    )


def _window_hashes(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the passages of ``MIN_WORDS`` words with 0, 1, .. words before the seed, and which of them exist."""
    side = MIN_WORDS - SEED
    n = len(t["key"])
    before, after = (np.zeros((n, side + 1), np.uint64) for _ in range(2))
    for sums, words_, coefficients in ((before, t["left"], _COEFFICIENTS[0]), (after, t["right"], _COEFFICIENTS[1])):
        np.cumsum(mix(words_.astype(np.uint64)) * coefficients, axis=1, out=sums[:, 1:])
    whole = mix(t["key"].view(np.uint64)[:, None] + before + after[:, ::-1] + _BY_PLACE)
    there = [np.hstack([np.ones((n, 1), bool), np.logical_and.accumulate(t[c] != 0, axis=1)]) for c in ("left", "right")]
    return whole, there[0] & there[1][:, ::-1]


def _common(words_: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Words that each row has in common with the row before it, -1 where the keys differ."""
    differ = words_[1:] != words_[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), words_.shape[1])
    return np.concatenate([[-1], np.where(key[1:] == key[:-1], common, -1)])


def _passages(t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, words before the seed, class) of the passages of ``MIN_WORDS`` words around each suffix of a sorted batch.

    Neighbours are compared: rows between which every common right part has ``r`` words or more share ``r`` words to the
    right, and so to the left in the order by left parts.  Passages with the same class have the same words.
    """
    side, n = MIN_WORDS - SEED, len(t["key"])
    right = _common(t["right"], t["key"])
    by_left = np.lexsort([np.ascontiguousarray(t["left"]).view(f"S{4 * side}").ravel(), t["key"]])
    left = _common(t["left"][by_left], t["key"][by_left])
    there = [(t[c] != 0).sum(axis=1) for c in ("left", "right")]
    rows, before, classes = [], [], []
    for w in range(side + 1):
        with_left = np.empty(n, np.int64)
        with_left[by_left] = np.cumsum(left < w)
        row = np.flatnonzero((there[0] >= w) & (there[1] >= side - w))
        rows.append(row)
        before.append(np.full(len(row), w))
        classes.append(((np.cumsum(right < side - w) * (n + 1) + with_left) * (side + 1) + w)[row])
    return np.concatenate(rows), np.concatenate(before), np.concatenate(classes)


class _Shared:
    """The passages of a sorted batch, those that two texts of the batch have, and the least two of these texts."""

    def __init__(self, t: dict[str, np.ndarray]) -> None:
        row, before, classes = _passages(t)
        order = np.lexsort([t["id"][row], classes])
        self.row, self.before, classes = row[order], before[order], classes[order]
        self.id = t["id"][self.row]
        new = np.concatenate([[True], classes[1:] != classes[:-1]]) if len(classes) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        least = self.id[new]
        other_id = self.id != least[group]
        second = np.full(len(least), np.iinfo(np.int64).max)
        np.minimum.at(second, group[other_id], self.id[other_id])
        found = np.zeros(len(least), bool)
        found[group[other_id]] = True
        self.found, self.least, self.second = found[group], least[group], second[group]
        self.other = np.where(other_id, self.least, self.second)


def _spans(t: dict[str, np.ndarray], shared: _Shared) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One span for each suffix with passages that another text of the batch has: row, start, stop, least id of the others.

    The passages of a suffix all hold its seed, so together they are one span.
    """
    n, side = len(t["key"]), MIN_WORDS - SEED
    row, before = shared.row[shared.found], shared.before[shared.found]
    most, fewest, other = np.full(n, -1), np.full(n, side + 1), np.full(n, np.iinfo(np.int64).max)
    np.maximum.at(most, row, before)
    np.minimum.at(fewest, row, before)
    np.minimum.at(other, row, shared.other[shared.found])
    hit = np.flatnonzero(most >= 0)
    return hit, (t["at"] - most)[hit], (t["at"] - fewest)[hit] + MIN_WORDS, other[hit]


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    side = MIN_WORDS - SEED
    wide = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=">u4").reshape(-1, side)
    plain = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    return {"key": plain("key"), "right": wide("right"), "left": wide("left"), "id": plain("id"), "at": plain("at").astype(np.int64)}


_DECIDED = "kind string, id bigint, start int, stop int, other bigint, team bigint, hash bigint, a bigint, b bigint"
_TYPES = {"kind": pa.string(), "id": pa.int64(), "start": pa.int32(), "stop": pa.int32()} | {c: pa.int64() for c in ("other", "team", "hash", "a", "b")}


def _rows(kind: str, n: int, **columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(columns[c]).astype(t.to_pandas_dtype())) if c in columns else pa.nulls(n, t) for c, t in _TYPES.items() if c != "kind"]
    return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string()), *arrays], names=list(_TYPES))


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted batches -> spans, and for the first and last key, which may go on in other batches, what decides them there.

    kind span: a span with its least partner.  kind member: a span whose passages other texts of the batch have, too; what
    is open is the least partner, which its team (the suffixes of the batch with the same such passages) looks up
    together.  kind passage: a passage that a team shares, with the least two ids of the batch; or, without a team, one
    that no other text of the batch has.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        t = _columns(batch)
        shared = _Shared(t)
        row, start, stop, other = _spans(t, shared)
        edge = (t["key"] == t["key"][0]) | (t["key"] == t["key"][-1])
        inner = ~edge[row]
        yield _rows("span", int(inner.sum()), id=t["id"][row][inner], start=start[inner], stop=stop[inner], other=other[inner])
        at_edge = edge[shared.row]
        p = {c: getattr(shared, c)[at_edge] for c in ("row", "before", "found", "least", "second")}
        hashes = _window_hashes(t)[0][p["row"], p["before"]] if len(p["row"]) else np.zeros(0, np.uint64)
        team = np.zeros(len(edge), np.uint64)  # the sum does not hang on the order
        np.add.at(team, p["row"][p["found"]], mix(hashes[p["found"]]))
        own = mix(np.array([t["key"][0], t["id"][0], t["at"][0]]).view(np.uint64) * _BY_PLACE[:3]).sum(dtype=np.uint64)
        team = mix(team + own).view(np.int64)
        member = ~inner
        yield _rows("member", int(member.sum()), id=t["id"][row][member], start=start[member], stop=stop[member], team=team[row][member])
        speaks = np.zeros(len(edge), bool)  # one suffix of each team names the team's passages
        speaks[row[member][np.unique(team[row[member]], return_index=True)[1]]] = True
        told = p["found"] & speaks[p["row"]]
        yield _rows("passage", int(told.sum()), hash=hashes[told].view(np.int64), a=p["least"][told], b=p["second"][told], team=team[p["row"][told]])
        alone = ~p["found"]
        rest = p["row"][alone]
        yield _rows("passage", len(rest), hash=hashes[alone].view(np.int64), a=t["id"][rest], id=t["id"][rest], start=t["at"][rest] - p["before"][alone])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages of ``MIN_WORDS`` words or more that a text shares with another one.

    One row for each maximal span of a text: id, first and last word (``start``, ``stop``: exclusive), ``n_words`` and
    the least id among all partners.  Words are compared in lower case.  Null ids, null, empty and shorter texts
    give no rows; rows that repeat an id are one text to each other, so they match other ids only.
    """
    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    parts = part_count(source)
    found = seeds(source)
    shared = found.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("key")
    places = found.join(shared, "key").groupBy("id").agg(F.sort_array(F.collect_set("at")).alias("places"))
    suffixes = source.join(places, "id").mapInArrow(per_batch(_contexts), "key bigint, right binary, left binary, id bigint, at int")
    ordered = suffixes.repartitionByRange("key", "right", "left", "id", "at").sortWithinPartitions("key", "right", "left", "id", "at")
    decided = checkpoint(ordered.mapInArrow(_decided, _DECIDED), parts)
    passages = decided.where("kind = 'passage'")
    # a batch gives a shared passage once for each team, so a set holds two ids for each batch at most
    ids = lambda a, b: F.slice(F.array_sort(F.array_union(F.collect_set(a), F.collect_set(b))), 1, 2)
    two = passages.groupBy("hash").agg(ids("a", "b").alias("two")).where("size(two) = 2").select("hash", F.col("two")[0].alias("first"), F.col("two")[1].alias("second"))
    marked = passages.select("hash", "id", "start", "team").join(two, "hash")
    partner = F.when(F.col("id") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    alone = marked.where("team is null").select("id", "start", (F.col("start") + MIN_WORDS).alias("stop"), partner.alias("other"))
    # a team meets what was found for it in one group, which is no larger than its batch
    teams = marked.where("team is not null").groupBy("team").agg(ids("first", "second").alias("two")).select("team", F.col("two")[0].alias("first"), F.col("two")[1].alias("second"))
    members = decided.where("kind = 'member'").select("team", "id", "start", "stop")
    met = members.unionByName(teams, allowMissingColumns=True)
    for c in ("first", "second"):
        met = met.withColumn(c, F.max(c).over(Window.partitionBy("team")))
    met = met.where("id is not null").select("id", "start", "stop", partner.alias("other"))
    spans = decided.where("kind = 'span'").select("id", "start", "stop", "other").unionByName(alone).unionByName(met)
    spans = spans.groupBy("id", "start", "stop").agg(F.min("other").alias("other"))
    before = Window.partitionBy("id").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("id").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("fresh", (F.col("start") > F.coalesce(F.max("stop").over(before), F.lit(-1))).cast("int"))
    spans = spans.withColumn("part", F.sum("fresh").over(so_far))
    merged = spans.groupBy("id", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("other").alias("other"))
    return merged.coalesce(parts).select(
        F.col("id").alias(id_col), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"),
        (F.col("stop") - F.col("start")).cast("long").alias("n_words"), F.col("other").alias("other_doc_id"),
    )
