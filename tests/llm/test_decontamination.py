"""Greedy string tiling against a version that tries all pairs of places."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from plantlake.llm.decontamination import BenchmarkIndex, find_leaks, leaks, tiles, without_leaks
from plantlake.llm.wordhash import mix, words


def tiles_of_all_pairs(text, item, size):
    text_marks, item_marks, out = [False] * len(text), [False] * len(item), []
    while True:
        best = (0, 0, size - 1)
        for a in range(len(text)):
            for b in range(len(item)):
                n = 0
                while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and not (text_marks[a + n] or item_marks[b + n]):
                    n += 1
                if n > best[2]:
                    best = (a, b, n)
        if best[2] < size:
            return sorted(out)
        out.append(best)
        for k in range(best[2]):
            text_marks[best[0] + k] = item_marks[best[1] + k] = True


def leaks_of_all_pairs(texts, items, tile, coverage):
    split = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    out = set()
    for i, text in texts:
        for j, item in items:
            item = split(item)
            found = tiles_of_all_pairs(split(text), item, min(tile, len(item))) if item else []
            covered = sum(n for _, _, n in found)
            if item and covered >= coverage * len(item):
                out.add((i, j, covered, len(item), len(found)))
    return out


def some(pick, letters, n):
    return [pick.randrange(letters) for _ in range(n)]


def test_tiles_equal_those_of_all_pairs():
    pick = random.Random(1)
    hashed = lambda x: mix(np.array(x, dtype=np.uint64) + np.uint64(7))
    for _ in range(200):
        letters, size = pick.choice([1, 2, 3, 6]), pick.randint(1, 5)
        text, item = some(pick, letters, pick.randint(0, 40)), some(pick, letters, pick.randint(1, 30))
        assert tiles(hashed(text), hashed(item), size) == tiles_of_all_pairs(text, item, size)


def test_leaks_equal_those_of_all_pairs(spark):
    pick = random.Random(2)
    text = lambda n, letters: pick.choice([" ", ", ", "\n"]).join(f"W{x}" for x in some(pick, letters, n))
    texts = [(k, text(pick.randint(0, 70), pick.choice([1, 2, 4, 12]))) for k in range(60)] + [(60, None), (61, ""), (62, "w1 w2"), (62, "w1 w2")]
    items = [(k, text(pick.randint(0, 20), pick.choice([1, 2, 4, 12]))) for k in range(30)] + [(30, None), (31, " . "), (32, "w1, w2")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    want = leaks_of_all_pairs(texts, items, 5, 0.6)
    for slice_bytes in (1 << 20, 300):
        got = find_leaks(docs, bench, slice_bytes=slice_bytes)
        assert {(r.doc_id, r.item_id, r.covered_words, r.item_words, r.n_tiles) for r in got.collect()} == want
    dirty = {w[0] for w in want}
    assert sorted(r.doc_id for r in without_leaks(docs, bench).collect()) == sorted(i for i, _ in texts if i not in dirty)
    assert find_leaks(docs.limit(0), bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).count() == 0
    assert without_leaks(docs, bench.limit(0)).count() == len(texts)


def test_periodic_texts_take_memory_in_proportion_to_their_length():
    item, text = " ".join(["a"] * 2_000), " ".join(["a"] * 200_000)
    mixed = " ".join(["a", "b", "c"] * 50_000)
    index = BenchmarkIndex([1, 2], pa.array([item, " ".join(["a", "b"] * 500)]), 5)
    tracemalloc.start()
    got = {x[:4] for chunk in words(pa.array([text, mixed]), punctuation=False) for x in leaks(chunk, index, 0.6)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == {(0, 0, 2_000, 2_000)}  # the other shares runs of two words only
    assert peak < 200 << 20
