"""Small results are written to few files, whatever the number of shuffle partitions."""

from glob import glob
from urllib.parse import urlparse

import corpus_pipeline
import pytest
from plantlake.llm import common, graph, near_dup, suffix_dedup
from pyspark.sql import functions as F

SETTINGS = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def scattered(spark):
    """(files of each checkpoint written since, cores): more small partitions than cores that nothing puts together by itself."""
    common.ensure_checkpoint_dir(spark)
    folder = urlparse(spark.sparkContext.getCheckpointDir()).path
    before, old = set(glob(f"{folder}/rdd-*")), {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield lambda: [len(glob(f"{d}/part-*")) for d in set(glob(f"{folder}/rdd-*")) - before], spark.sparkContext.defaultParallelism
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def copies(spark):
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(words if i % 2 else [f"{w}x{i // 10}" for w in words])) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(20, "doc_id")


def test_parts_follow_the_bytes_of_text(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.createDataFrame([(1, "é" * 50), (2, None), (3, "")], "doc_id bigint, text string")
    assert common.part_count(docs) == cores == common.part_count(docs.limit(0))
    monkeypatch.setattr(common, "PART_BYTES", 1)
    assert common.part_count(docs) == max(cores, 100)


def test_passages_go_to_few_files(spark, scattered):
    files, cores = scattered
    found = suffix_dedup.repeated_passages(copies(spark))
    assert found.rdd.getNumPartitions() <= cores
    assert max(files()) <= cores
    assert {(r.start, r.stop) for r in found.collect()} == {(0, 80)} and found.count() == 60


def test_near_duplicates_and_components_go_to_few_files(spark, scattered):
    files, cores = scattered
    kept = near_dup.keep_one_of_each(copies(spark))
    assert kept.rdd.getNumPartitions() <= cores
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "a bigint, b bigint")
    roots = graph.connected_components(edges.repartition(20, "a"), "a", "b")
    assert {r.root for r in roots.collect()} == {0}
    assert max(files()) <= cores
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 10, 20, 30, 40, 50]


def test_stages_go_to_few_files(spark, scattered, tmp_path):
    files, cores = scattered
    docs = copies(spark).selectExpr("doc_id", "text", "'en' AS lang", "'web' AS source", "length(text) AS n_chars")
    docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "none of these words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).rdd.getNumPartitions() <= cores, name
    assert max(files()) <= cores
