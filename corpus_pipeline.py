"""Training-data pipeline over ``documents``: each stage is written as Parquet and read again for the next one.

A stage writes a file for ``common.PART_BYTES`` of text, or one for each core; fewer if its input has fewer partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm import bpe, decontamination, near_dup, secret_scan, toxicity
from plantlake.llm.common import ensure_checkpoint_dir, fresh, part_count, table
from plantlake.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "__score")
    scored = toxicity.score(docs, model, out=name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).drop(name).coalesce(part_count(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return near_dup.keep_one_of_each(docs, n=5, num=4, den=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark")).coalesce(part_count(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return secret_scan.redact(docs).coalesce(part_count(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token ids, with the text that they decode to."""
    coded = bpe.encode_decode(docs, bpe.load(vocabulary_path("word_bpe_49k.json")))
    coded = coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded")
    return coded.coalesce(part_count(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scans", mask_secrets),
    ("bpe", tokenize),
]

#: Language models, signatures and merges are not SQL: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages; what lies between them is written to the folder that the cluster shares."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
