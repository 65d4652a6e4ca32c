"""Token counts against the library whose file is read."""

import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from plantlake.llm import bpe, queries, token_counts

PATH = queries.vocabulary_path("byte_bpe_50k.json")
BITS = ["a", "aa", "aaa", " ", "  ", "\n", "\t ", "é", "日本", "<|endoftext|>", "<|endoftext", "1", "22", "'s", "'ll", "'", "'l", "'re", "'v", "!!!", "the ", " ", "\x1c", "\x85", "՘", "😀", "ing"]


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(bpe.load(PATH))


def library():
    theirs = Tokenizer.from_file(PATH)
    theirs.no_truncation()
    theirs.no_padding()
    return lambda texts: [len(e.ids) for e in theirs.encode_batch(texts, add_special_tokens=False)]


def some_texts(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice([*BITS, "b" * pick.randint(1, 30)]) for _ in range(pick.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("group", [1 << 20, 40])
def test_random_texts_equal_the_library(counter, monkeypatch, group):
    monkeypatch.setattr(token_counts, "GROUP", group)
    texts = some_texts(4000, group)
    assert counter.count(texts).tolist() == library()(texts)


def test_every_code_point_equals_the_library(counter):
    texts = ["".join(f"a{chr(c)}b1{chr(c)}!{chr(c)} {chr(c)}  x" for c in range(k, k + 1)) for k in range(0x20000) if not 0xD800 <= k < 0xE000]
    assert counter.count(texts).tolist() == library()(texts)


def test_long_runs_equal_the_library(counter):
    pick = random.Random(3)
    texts = ["a" * 100_001, "".join(pick.choice("abcdefgh") for _ in range(60_000)), " " * 70_000, "the cat " * 50_000]
    assert counter.count(texts).tolist() == library()(texts)


def test_merging_by_rank_equals_one_pair_at_a_time(counter):
    merger = counter.merger
    rank = {(k >> 32, k & 0xFFFFFFFF): r for k, r in zip(merger.keys.tolist(), merger.ranks.tolist(), strict=True)}
    pick = random.Random(5)
    pieces = [bytes(pick.choice(b"aeht rs\xc3\xa9") for _ in range(pick.randint(0, 40))) for _ in range(300)]

    def slow(data):
        ids = [int(merger.byte_ids[b]) for b in data]
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank), default=None)
            if best is None:
                return len(ids)
            ids[best[1] : best[1] + 2] = [int(merger.made[best[0]])]

    assert merger.counts(pieces).tolist() == [slow(p) for p in pieces]
    assert merger.counts([]).tolist() == [] and merger.counts([b"", b""]).tolist() == [0, 0]


def test_pieces_that_share_a_hash_stay_apart(monkeypatch):
    points = np.frombuffer("ab ab cd ab".encode("utf-32-le"), dtype=np.uint32)
    monkeypatch.setattr(token_counts, "mix", lambda h: h * np.uint64(0))
    starts = np.array([0, 3, 6, 9])
    first, inverse = token_counts.distinct(points, starts, np.array([2, 2, 2, 2]))
    assert [points[starts[first[i]]] for i in inverse] == [ord(c) for c in "aaca"]


def test_a_merge_before_its_parts_is_refused():
    spec = json.loads(bpe.load(PATH))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    with pytest.raises(ValueError, match="comes before"):
        token_counts.RankMerger(spec)


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, 5, "x"), (1, "", 6, "y"), (None, "the cat<|endoftext|>", 7, None), (None, "the cat<|endoftext|>", 7, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, __count string")
    got = token_counts.count_tokens(df, bpe.load(PATH))
    assert got.columns == ["doc_id", "__count", "n_tokens"]
    assert sorted((r.doc_id or 0, r["__count"] or "", r.n_tokens) for r in got.collect()) == [(0, "", 3), (0, "", 3), (1, "x", 0), (1, "y", 0)]
    assert token_counts.count_tokens(df.limit(0), bpe.load(PATH)).count() == 0


def test_query_covers_every_document(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_token_counts(spark, SF_SMALL).collect()}
    want = dict(zip(texts, library()(list(texts.values())), strict=True))
    assert {i: r.n_tokens for i, r in got.items()} == want
    assert all(r.n_bytes == len(texts[i].encode()) and r.over_limit == (r.n_tokens > 512) for i, r in got.items())
