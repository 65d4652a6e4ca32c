"""Bounded samples: which rows go in, and the verdicts learned from them."""

from pyspark.sql import functions as F

from plantlake.llm import quality_rules
from plantlake.llm.common import least_hashes


def test_least_hashes_take_about_as_many_as_wanted(spark):
    ids = spark.range(20_000).select("id", F.xxhash64("id").alias("h"))
    assert ids.where(least_hashes(F.col("h"), 20_000, 20_000)).count() == 20_000
    got = [r.h for r in ids.where(least_hashes(F.col("h"), 20_000, 2_000)).collect()]
    assert 1_800 < len(got) < 2_200
    assert sorted(got) == [r.h for r in ids.orderBy("h").limit(len(got)).collect()]


def made(spark, n):
    """Good texts of ordinary words; bad ones, every third, with symbols in each word."""
    text = lambda i: " ".join(("w%d#$" if i % 3 == 0 else "word%d") % (i * 31 + k) for k in range(30))
    docs = [(i, text(i)) for i in range(n)]
    odd = [(n, "too short"), (n + 1, None), (n + 2, ""), (n + 3, " ".join(["same"] * 200))]
    labels = [(i, int(i % 3 != 0)) for i in range(n)] + [(1, 1), (3, 1), (4, None), (None, 0)]  # repeated, contradictory, null
    return spark.createDataFrame(docs + odd, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_judge_keeps_good_texts_whatever_the_sample(spark, monkeypatch):
    n = 900
    docs, labels = made(spark, n)
    want = {i: i % 3 != 0 for i in range(n)} | {n + k: False for k in range(4)}
    for sample in (20_000, 150):  # all labelled rows, and those with the least hashes; a rule needs some ten bad rows to prove itself
        monkeypatch.setattr(quality_rules, "SAMPLE", sample)
        rows = quality_rules.judge(docs, labels).collect()
        assert {r.doc_id: r.kept for r in rows} == want
        assert {r.doc_id for r in rows if r.base_failed} == {n, n + 1, n + 2, n + 3}


def test_judge_without_labels_or_rows(spark):
    docs, labels = made(spark, 30)
    rows = quality_rules.judge(docs, labels.limit(0)).collect()
    assert {r.doc_id for r in rows if not r.kept} == {30, 31, 32, 33}
    same = labels.select("doc_id", F.lit(1).alias("quality"))
    assert {r.doc_id for r in quality_rules.judge(docs, same).collect() if not r.kept} == {30, 31, 32, 33}
    assert quality_rules.judge(docs.limit(0), labels).count() == 0
