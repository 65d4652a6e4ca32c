"""Ranked search against scoring every document, and its SQL."""

import collections
import math
import os
import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from plantlake.llm import lexical_search, queries

DOCS = "doc_id bigint, text string, n int, slots string"
ITEMS = "item_id bigint, text string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in held if c)
    n_terms = sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            score = 0
            for t in terms(text):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "日本", "ÀB"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [pick.choice([" ", ", ", "\x00", "_", "-"]).join(pick.choices(vocabulary, weights, k=pick.choice([0, 1, 3, 20, 60, 400]))) for _ in range(n)]
    texts += [texts[5].upper()] * 40 + [None, "", " .,", "w1", "w1", "W1 w1"]
    docs = list(enumerate(texts)) + [(3, texts[3]), (None, texts[9]), (None, "w1")]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.randint(0, 30)))) for i in range(25)] + [(25, None), (26, texts[5]), (26, "w1 unknown"), (None, "w2 w2 w3")]
    return docs, items


@pytest.mark.parametrize(("block", "together", "take", "slice_bytes", "k"), [(1 << 20, 16, 24, 1 << 22, 20), (150, 3, 1, 1 << 22, 20), (700, 50, 2, 400, 3)])
def test_equals_scoring_everything(spark, monkeypatch, block, together, take, slice_bytes, k):
    for name, value in (("BLOCK_POSTINGS", block), ("TOGETHER", together), ("TAKE", take)):
        monkeypatch.setattr(lexical_search, name, value)
    docs, items = corpus(block, 150)
    # the workers' modules have their own settings, so blocks and rounds are also tried in this process
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS)
    wanted = spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS)
    got = lexical_search.rank_documents(df, wanted, k=k, slice_bytes=slice_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute(docs, items, k)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    part = lexical_search.items_of([i for i, _ in items], lexical_search.pa.array([t for _, t in items]))
    assert here(docs, part, k) == sorted({(n, i, s) for n, i, s in positions(docs, items, k)}, key=repr)


def positions(docs, items, k):
    for n, item in enumerate(items):
        yield from ((n, lexical_search.NO_ID if i is None else i, s) for _, _, i, s in brute(docs, [item], k))


def here(docs, part, k):
    """The search of one task in this process, with its blocks."""
    pa = lexical_search.pa

    class Shared:
        value = part.terms

    table = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs])})
    held = list(lexical_search._postings(Shared)(iter(table.to_batches())))
    n = np.concatenate([b.column("n").to_numpy() for b in held])
    df = np.bincount(np.concatenate([lexical_search._flat(b, "slots") for b in held]), minlength=len(part.terms))
    n_docs = int((n > 0).sum())
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df])

    class Both:
        value = (part, weight, n_docs, int(n.sum()))

    out = [r for b in lexical_search._search(Both, k)(iter(held)) for r in b.to_pylist()]
    return sorted({(r["item"], lexical_search.NO_ID if r["doc_id"] is None else r["doc_id"], r["score"]) for r in out}, key=repr)


def test_empty_tables(spark):
    docs, items = corpus(1, 8)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS)
    wanted = spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS)
    assert lexical_search.rank_documents(df.limit(0), wanted).count() == 0
    assert lexical_search.rank_documents(df, wanted.limit(0)).count() == 0
    assert lexical_search.rank_documents(df.where("text is null"), wanted).count() == 0


def test_range_maxima_equal_a_scan():
    pick = np.random.default_rng(2)
    sizes = pick.integers(1, 9, 200)
    slot = np.concatenate([np.sort(pick.choice(9, n, replace=False)) for n in sizes])
    block = lexical_search.Block(np.arange(200), np.full(200, 100), sizes, slot, pick.integers(1, 50, len(slot)), np.arange(1, 10))
    for term in range(9):
        low, high = block.begin[term], block.begin[term + 1]
        assert (np.diff(block.place[low:high]) > 0).all()
        for _ in range(60):
            a = int(pick.integers(low, high))
            b = int(pick.integers(a + 1, high + 1))
            at = int(block.greatest(np.array([a]), np.array([b]))[0])
            assert a <= at < b and block.impact[at] == block.impact[a:b].max()


def test_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{os.path.join(SF_SMALL, name)}.parquet')")
    got = queries.op11_ranked_search(spark, SF_SMALL)
    want = con.execute(queries.ORACLE["op11_ranked_search"])
    assert [c[0] for c in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
