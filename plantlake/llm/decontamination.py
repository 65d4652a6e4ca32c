"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items become words (lower case, ASCII punctuation apart).  Windows of ``TILE`` words that both
share are the seeds.  For each text and each item that it shares enough seeds with, the longest common run of words is
found by Karp-Rabin hashes of falling lengths and marked in both, again and again, over words that are not marked yet,
until no run of ``TILE`` words is left.  Tiles may come in any order, so reordered passages count.  An item leaks
into a text if its marked words reach ``COVERAGE`` of it.

The benchmark's index goes to every task.  It is built from slices of at most ``SLICE_BYTES`` of item text, checked
before anything is collected, and takes about 30 bytes a word in sorted arrays; a larger benchmark takes one pass over
the texts for each slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .wordhash import Words, powers, window_hashes, words

TILE = 5
COVERAGE = 0.6
SLICE_BYTES = 16 << 20
_FILTER_BITS = 22


class BenchmarkIndex:
    """Windows of benchmark items in sorted arrays, with the items that hold them.

    An item of fewer than ``tile`` words has one window, itself; an empty one has none.
    """

    def __init__(self, ids: list, texts: pa.Array, tile: int) -> None:
        self.ids, self.tile = ids, tile
        self.items = [c.hashes[c.offsets[i] : c.offsets[i + 1]] for c in words(texts, punctuation=False) for i in range(len(c))]
        self.total = np.array([len(x) for x in self.items], dtype=np.int64)
        self.windows: dict[int, tuple[np.ndarray, ...]] = {}
        for n in sorted({min(tile, len(x)) for x in self.items} - {0}):
            own = np.flatnonzero(np.minimum(self.total, tile) == n)
            h = np.concatenate([self.of_item(k) for k in own])
            item = np.repeat(own, self.total[own] - n + 1)
            order = np.lexsort([item, h])
            h, item = h[order], item[order]
            first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (item[1:] != item[:-1])]))
            times = np.diff(np.concatenate([first, [len(h)]]))
            keys, starts = np.unique(h[first], return_index=True)
            bits = np.zeros(1 << _FILTER_BITS, dtype=bool)  # a bitmap by leading bits spares most look-ups
            bits[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.windows[n] = keys, np.concatenate([starts, [len(first)]]), item[first].astype(np.int32), times.astype(np.int32), bits

    def of_item(self, k: int) -> np.ndarray:
        n = min(self.tile, len(self.items[k]))
        return window_hashes(self.items[k], np.arange(len(self.items[k]) - n + 1), n)

    def candidates(self, chunk: Words, coverage: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(row, item, words of the row where shared windows begin, hashes of these) where shared windows could cover enough.

        A row's different windows are looked up, never its places times the item's, so what is held is linear in both.
        """
        for n, (keys, starts, items, times, bits) in self.windows.items():
            hashes, offsets = chunk.windows(n)
            at = np.flatnonzero(bits[hashes >> np.uint64(64 - _FILTER_BITS)])
            place = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
            there = keys[place] == hashes[at]
            at, place = at[there], place[there]
            if not len(at):
                continue
            rows, first = np.unique(np.searchsorted(offsets, at, side="right") - 1, return_index=True)
            for row, i, j in zip(rows.tolist(), first.tolist(), [*first[1:].tolist(), len(at)], strict=True):
                own = np.unique(place[i:j])
                counts = starts[own + 1] - starts[own]
                entry = np.repeat(starts[own] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                held, which = np.unique(items[entry], return_inverse=True)
                most = np.bincount(which, times[entry]) * n  # each window of an item stands for n words at most
                for item in held[most >= coverage * self.total[held]].tolist():
                    yield row, item, at[i:j] - offsets[row], hashes[at[i:j]]


def _room(free: np.ndarray) -> np.ndarray:
    """For each place how many free ones follow without a break, itself included."""
    ends = np.concatenate([np.flatnonzero(~free), [len(free)]])
    return ends[np.searchsorted(ends, np.arange(len(free)))] - np.arange(len(free))


class _Runs:
    """Words with prefix sums, from which Karp-Rabin hashes of any length are read off, and which of them are free."""

    def __init__(self, hashes: np.ndarray, free: np.ndarray) -> None:
        self.words, self.free = hashes, free
        up, self.down = powers(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=self.sums[1:])
        self.room = _room(free)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the free runs of this length, and their hashes."""
        at = np.flatnonzero(self.room >= length)
        return at, (self.sums[at + length] - self.sums[at]) * self.down[at]


def tiles(text: np.ndarray, item: np.ndarray, size: int, free: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the text, place in the item, words), the longest first, of ``size`` words or more.

    Of equally long ones the first in the text, then in the item, goes first.  The greatest length that is left is found
    by bisection over Karp-Rabin hashes, as a common run holds common runs of all smaller lengths; its runs are compared
    word by word and marked, and the search goes on below it.  Memory is linear in text plus item, on periodic ones too.
    """
    a = _Runs(text, np.ones(len(text), dtype=bool) if free is None else free.copy())
    b = _Runs(item, np.ones(len(item), dtype=bool))
    out = []
    longest = len(item)

    def shared(length: int) -> bool:
        return bool(np.isin(a.of(length)[1], b.of(length)[1]).any())

    while True:
        longest = min(longest, int(a.room.max(initial=0)), int(b.room.max(initial=0)))
        if longest < size or not shared(size):
            return sorted(out)
        low, high = size, longest + 1
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if shared(middle) else (low, middle)
        at, ha = a.of(low)
        place, hb = b.of(low)
        order = np.argsort(hb, kind="stable")
        place, hb = place[order], hb[order]
        begin, end = np.searchsorted(hb, ha, side="left"), np.searchsorted(hb, ha, side="right")
        hit = begin < end
        live = dict.fromkeys(begin[hit].tolist(), 0)  # of each group of equal runs of the item, how many are used up
        done = 0
        for i, first, last in zip(at[hit].tolist(), begin[hit].tolist(), end[hit].tolist(), strict=True):
            if i < done:
                continue
            k = first + live[first]
            while k < last and not b.free[place[k] : place[k] + low].all():
                k += 1
            live[first] = k - first
            while k < last:
                j = int(place[k])
                if b.free[j : j + low].all() and np.array_equal(a.words[i : i + low], b.words[j : j + low]):
                    a.free[i : i + low] = b.free[j : j + low] = False
                    out.append((i, j, low))
                    done = i + low
                    break
                k += 1
        a.room, b.room = _room(a.free), _room(b.free)
        longest = low - 1


def leaks(chunk: Words, index: BenchmarkIndex, coverage: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, covered words, item words, tiles) for every item that leaks into a row."""
    for row, item, at, hashes in index.candidates(chunk, coverage):
        needed, total = coverage * index.total[item], int(index.total[item])
        size = min(index.tile, total)
        own = index.of_item(item)
        if _covered(np.flatnonzero(np.isin(own, hashes)), size, total).sum() < needed:
            continue  # even all shared windows together could not reach it
        text = chunk.hashes[chunk.offsets[row] : chunk.offsets[row + 1]]
        inside = np.append(_covered(at[np.isin(hashes, own)], size, len(text)), False)
        kept = inside.copy()
        kept[1:] |= inside[:-1]  # one word that is not free parts the stretches
        found = tiles(np.append(text, np.uint64(0))[kept], index.items[item], size, inside[kept])
        covered = sum(n for _, _, n in found)
        if covered >= needed:
            yield chunk.first + row, item, covered, total, len(found)


def _covered(at: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words stand in the windows of ``size`` words that begin at ``at``."""
    steps = np.zeros(total + 1, dtype=np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return np.cumsum(steps[:-1]) > 0


def benchmark_slices(benchmark: DataFrame, item_id: str, text: str, tile: int, slice_bytes: int) -> Iterator[BenchmarkIndex]:
    items = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // slice_bytes
    for k in range(parts):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k) if parts > 1 else items
        got = part.distinct().toArrow().sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()
        yield BenchmarkIndex(got["id"].to_pylist(), got["text"].combine_chunks(), tile)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    tile: int = TILE, coverage: float = COVERAGE, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row for each text and benchmark item that leaks into it: id, item id, covered and item words, coverage, tiles.

    Null and empty texts leak nothing, nor do null and empty items; a repeated item counts once, a repeated row for
    itself.  An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text).cast("string").alias("__text"))
    schema = f"`{id_col}` bigint, `{item_id}` bigint, covered_words bigint, item_words bigint, coverage double, n_tiles bigint"

    def scan(index: BenchmarkIndex) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [x for chunk in words(batch.column("__text"), punctuation=False) for x in leaks(chunk, shared.value, coverage)]
                if found:
                    row, item, covered, total, n = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(id_col).take(pa.array(row, pa.int64())),
                            pa.array([shared.value.ids[i] for i in item], pa.int64()),
                            pa.array(covered, pa.int64()),
                            pa.array(total, pa.int64()),
                            pa.array([c / t for c, t in zip(covered, total, strict=True)], pa.float64()),
                            pa.array(n, pa.int64()),
                        ],
                        names=[id_col, item_id, "covered_words", "item_words", "coverage", "n_tiles"],
                    )

        return source.mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [scan(x) for x in benchmark_slices(benchmark, item_id, item_text, tile, slice_bytes)])


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    tile: int = TILE, coverage: float = COVERAGE, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The rows of ``docs`` into which no benchmark item leaks, with their columns as they are."""
    schema, hidden = docs.schema, fresh(docs, "__text")
    for index in benchmark_slices(benchmark, item_id, item_text, tile, slice_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(hidden)
                clean = np.ones(batch.num_rows, dtype=bool)
                for chunk in words(column, punctuation=False):
                    clean[[x[0] for x in leaks(chunk, shared.value, coverage)]] = False
                yield batch.drop_columns([hidden]).filter(pa.array(clean))

        docs = docs.withColumn(hidden, F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)
    return docs
