"""Ranked lexical search: best-first document intervals bounded by range-maximum queries on posting lists.

Spark turns each document into the query terms that it holds, and counts from that how many documents hold each term.
A task gathers documents into blocks.  A block has one posting list per term, in document order, and over the lists'
impacts a sparse table that answers where the greatest impact of a range is.  An item starts with one interval, the whole
block.  An interval's bound is the sum of its terms' greatest impacts in it, and it is split at the document of the greatest
single one: that document is scored, and what lies left and right of it are the next intervals.  Each round takes the best
intervals of every item; intervals that cannot reach an item's k-th best so far are dropped.  Nothing is estimated, so
the ranking is exact; the best of each task are ranked once more by Spark.

A term is a hash of 64 bits; only the items' terms are kept, so two terms meet with a chance of about (terms of the items)
x (distinct terms of the documents) / 2**64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint
from .wordhash import TERM_BREAKS, words

TOP = 20
BLOCK_POSTINGS = 1 << 20  # postings of a block; a single document may have more
TOGETHER = 16  # items searched at once
TAKE = 24  # intervals split in a round for each item
SLICE_BYTES = 4 << 20  # item texts whose terms are broadcast together; more items make more passes


@dataclass
class Items:
    """Items as ragged arrays: item i has terms ``slots[offsets[i]:offsets[i + 1]]``, ``times`` often."""

    ids: list
    terms: np.ndarray  # sorted hashes; a slot is a place in it
    offsets: np.ndarray
    slots: np.ndarray
    times: np.ndarray


def items_of(ids: list, texts: pa.Array) -> Items:
    hashes, owners = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for chunk in words(texts, separates=TERM_BREAKS):
        hashes.append(chunk.hashes)
        owners.append(chunk.first + np.repeat(np.arange(len(chunk)), np.diff(chunk.offsets)))
    terms, slot = np.unique(np.concatenate(hashes), return_inverse=True)
    both, times = np.unique(np.concatenate(owners) * max(1, len(terms)) + slot, return_counts=True)
    owner, slot = np.divmod(both, max(1, len(terms)))
    return Items(ids, terms, np.searchsorted(owner, np.arange(len(ids) + 1)), slot, times.astype(np.int64))


def _slices(items: DataFrame, item_id: str, text: str, slice_bytes: int) -> Iterator[Items]:
    """The items, a bounded number of bytes at a time."""
    rows = items.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // slice_bytes
    for k in range(parts):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k) if parts > 1 else rows
        got = part.toArrow().combine_chunks()
        yield items_of(got["id"].to_pylist(), pa.chunked_array(got["text"], pa.string()).combine_chunks())


def _postings(terms) -> callable:
    """Documents -> number of terms, slots of the items' terms they hold, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for batch in batches:
            for chunk in words(batch.column("text"), separates=TERM_BREAKS):
                at = np.minimum(np.searchsorted(known, chunk.hashes), max(0, len(known) - 1))
                hit = known[at] == chunk.hashes if len(known) else np.zeros(0, dtype=bool)
                row = np.repeat(np.arange(len(chunk)), np.diff(chunk.offsets))[: len(hit)][hit]
                both, times = np.unique(row * max(1, len(known)) + at[hit], return_counts=True)
                row, slot = np.divmod(both, max(1, len(known)))
                offsets = pa.array(np.searchsorted(row, np.arange(len(chunk) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, len(chunk)),
                        pa.array(np.diff(chunk.offsets), pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(slot, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                    ],
                    names=["doc_id", "n", "slots", "times"],
                )

    return run


class Block:
    """Posting lists of some documents, with sparse tables of where ranges have their greatest impact."""

    def __init__(self, doc: np.ndarray, m: np.ndarray, sizes: np.ndarray, slot: np.ndarray, times: np.ndarray, weight: np.ndarray) -> None:
        order = np.argsort(doc, kind="stable")
        place = np.empty(len(doc), dtype=np.int64)
        place[order] = np.arange(len(doc))
        self.doc = doc[order]
        at = np.repeat(place, sizes)
        impact = weight[slot] * (1_000_000_000 * times // (1000 * times + 12 * np.repeat(m, sizes)))
        self.width = len(doc)
        key = slot.astype(np.int64) * self.width + at
        order = np.argsort(key)
        self.key, self.impact, self.place = key[order], impact[order], at[order]
        self.begin = np.searchsorted(self.key, np.arange(len(weight) + 1) * self.width)
        # level k: the place of the greatest impact among 2**k neighbours; read only where they are of one list
        level = np.arange(len(key), dtype=np.int32)
        self.levels = [level]
        step, longest = 1, int(np.diff(self.begin).max(initial=0))
        while 2 * step <= longest:
            right = level[np.minimum(np.arange(len(level)) + step, len(level) - 1)]
            level = np.where(self.impact[level] >= self.impact[right], level, right)
            self.levels.append(level)
            step *= 2
        self.levels = np.stack(self.levels)

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the greatest impact of each range a..b (not empty) is."""
        k = np.frexp((b - a).astype(np.float64))[1] - 1
        left, right = self.levels[k, a], self.levels[k, b - (1 << k)]
        return np.where(self.impact[left] >= self.impact[right], left, right)


class Best:
    """The k best documents of each item so far: score, then document id."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.last_score = np.zeros(items, dtype=np.int64)  # of the k-th best; 0 while there are fewer
        self.last_doc = np.full(items, -(2**63), dtype=np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        worth = (score > self.last_score[item]) | ((score == self.last_score[item]) & (doc < self.last_doc[item]))
        if not worth.any():
            return
        item, score, doc = (np.concatenate([old, new[worth]]) for old, new in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        self.item, self.score, self.doc = (x[rank < self.k] for x in (item, score, doc))
        last = rank == self.k - 1
        self.last_score[item[last]], self.last_doc[item[last]] = score[last], doc[last]


def search(block: Block, items: Items, chosen: np.ndarray, best: Best) -> None:
    """Add the block's documents to the best of the chosen items."""
    # entries: for each interval the terms that it holds, as ranges a..b of their lists; intervals are runs of entries
    size = np.diff(items.offsets)[chosen]
    entry = np.repeat(items.offsets[chosen], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    slot, times, item = items.slots[entry], items.times[entry], np.repeat(chosen, size)
    a, b = block.begin[slot], block.begin[slot + 1]
    some = b > a
    state = _intervals(block, item[some], item[some], slot[some], times[some], a[some], b[some])
    while len(state["item"]):
        item, bound = state["item"], state["bound"]
        hope = (bound > best.last_score[item]) | ((bound == best.last_score[item]) & (state["doc"] < best.last_doc[item]))
        state = _pick(state, hope & (bound > 0))
        item, bound = state["item"], state["bound"]
        if not len(item):
            break
        order = np.lexsort((-bound, item))
        rank = np.empty(len(item), dtype=np.int64)
        rank[order] = np.arange(len(item)) - np.searchsorted(item[order], item[order])
        taken, state = _pick(state, rank < TAKE), _pick(state, rank >= TAKE)
        # the split document of each interval, and where its lists hold it
        run = np.repeat(np.arange(len(taken["item"])), taken["size"])
        a, b, slot, times = (taken[c] for c in ("a", "b", "slot", "times"))
        split = taken["split"][run]
        wanted = slot * block.width + split
        at = np.searchsorted(block.key, wanted)
        hit = (at < b) & (block.key[np.minimum(at, len(block.key) - 1)] == wanted)
        gain = np.where(hit, times * block.impact[np.minimum(at, len(block.key) - 1)], 0)
        starts = np.cumsum(taken["size"]) - taken["size"]
        best.add(taken["item"], np.add.reduceat(gain, starts), block.doc[taken["split"]])
        left, right = at > a, b > at + hit
        owner = taken["item"][run]
        parts = [
            _intervals(block, run[left], owner[left], slot[left], times[left], a[left], at[left]),
            _intervals(block, run[right], owner[right], slot[right], times[right], (at + hit)[right], b[right]),
        ]
        state = {c: np.concatenate([x[c] for x in (state, *parts)]) for c in state}


_PER_INTERVAL = ("item", "size", "bound", "split", "doc")


def _intervals(block: Block, run: np.ndarray, item: np.ndarray, slot: np.ndarray, times: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict:
    """Intervals from entries in runs: the bound, the document to split at and the least document of each."""
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, dtype=np.int64)
    if not len(run):
        none = np.zeros(0, dtype=np.int64)
        return {**dict.fromkeys(_PER_INTERVAL, none), "slot": none, "times": none, "a": none, "b": none}
    where = block.greatest(a, b)
    value = times * block.impact[where]
    size = np.diff(np.append(starts, len(run)))
    top = np.repeat(np.maximum.reduceat(value, starts), size)
    return {
        "item": item[starts],
        "size": size,
        "bound": np.add.reduceat(value, starts),
        "split": np.minimum.reduceat(np.where(value == top, block.place[where], block.width), starts),
        "doc": block.doc[np.minimum.reduceat(block.place[a], starts)],
        "slot": slot,
        "times": times,
        "a": a,
        "b": b,
    }


def _pick(state: dict, keep: np.ndarray) -> dict:
    if keep.all():
        return state
    entries = np.repeat(keep, state["size"])
    return {c: x[keep] if c in _PER_INTERVAL else x[entries] for c, x in state.items()}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        slots = batch.column("slots")
        ends = slots.offsets.to_numpy()
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + BLOCK_POSTINGS - size, side="right")) - 1
            last = min(batch.num_rows, max(last, first if held else first + 1))
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(ends[last] - ends[first])
            if last < batch.num_rows:
                yield held
                held, size = [], 0
            first = last
    if held:
        yield held


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


NO_ID = 2**63 - 1  # a null document id, which comes after all others


def _search(shared, k: int):
    """Rows of (doc_id, n, slots, times) -> the best of the task: item, doc_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, n_docs, n_terms = shared.value
        best = Best(len(items.ids), k)
        for held in _blocks(batches):
            n = np.concatenate([x.column("n").to_numpy(zero_copy_only=False) for x in held]).astype(np.int64)
            doc = np.concatenate([x.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False) for x in held])
            slot, times = (np.concatenate([_flat(x, c) for x in held]) for c in ("slots", "times"))
            sizes = np.concatenate([np.diff(x.column("slots").offsets.to_numpy()) for x in held])
            block = Block(doc, 100 - 25 + 25 * n * n_docs // n_terms, sizes, slot, times, weight)
            for first in range(0, len(items.ids), TOGETHER):
                search(block, items, np.arange(first, min(first + TOGETHER, len(items.ids))), best)
        if len(best.item):
            ids = pa.array(np.where(best.doc == NO_ID, 0, best.doc), pa.int64(), mask=best.doc == NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array(best.item), pa.array([items.ids[i] for i in best.item], pa.int64()), ids, pa.array(best.score)],
                names=["item", "item_id", "doc_id", "score"],
            )

    return run


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The ``k`` best documents of each row of ``items``: item_id, rank, doc_id, score.

    Only documents that score above 0 are ranked; equal scores by ascending id, null ids last.  Null and empty texts hold
    no terms.  Each row counts for itself, so a repeated document is ranked twice and a repeated item has two rankings.
    Empty tables give an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    out = None
    for part in _slices(items, item_id, item_text, slice_bytes):
        held = checkpoint(source.mapInArrow(_postings(spark.sparkContext.broadcast(part.terms)), "doc_id bigint, n bigint, slots array<int>, times array<int>"))
        total = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
        holding = np.zeros(len(part.terms), dtype=np.int64)
        for row in held.select(F.explode("slots").alias("slot")).groupBy("slot").count().collect():  # one row a term of the items
            holding[row["slot"]] = row["count"]
        weight = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * df + 1))) for df in holding.tolist()], dtype=np.int64)
        shared = spark.sparkContext.broadcast((part, weight, total["docs"], max(1, total["terms"] or 0)))
        found = held.where(F.size("slots") > 0).mapInArrow(_search(shared, k), "item bigint, item_id bigint, doc_id bigint, score bigint")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out
