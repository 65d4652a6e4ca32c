"""Helpers shared by the operators: table access, shared-folder checkpoints, Arrow batches."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as all the operators here count words.
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: Text for which a result gets a file.  Smaller partitions are written together: without Hadoop's native library, each
#: file on a local path costs two processes that the executor starts to set its mode and that of its checksum.
PART_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(shared)


def checkpoint(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Compute once and cut the lineage, in the shared folder, so a lost executor costs a re-read; in ``parts`` files at most."""
    ensure_checkpoint_dir(df.sparkSession)
    return (df if parts is None else df.coalesce(parts)).checkpoint(eager=True)


def part_count(docs: DataFrame, text: str = "text") -> int:
    """Files for results that grow with ``docs``: one for ``PART_BYTES`` of text, and one for each core at least."""
    held = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-held // PART_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def packed(df: DataFrame, names: list[str]) -> Column:
    """Columns to pass through, as one struct that clashes with nothing."""
    return F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("none"))


def least_hashes(order: Column, rows: int, wanted: int) -> Column:
    """Whether a 64-bit hash is among the least, so that about ``wanted`` of ``rows`` are; all of them if there are no more."""
    if rows <= wanted:
        return F.lit(True)
    return order < F.lit(-(2**63) + int(wanted / rows * 2**64))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def sha256_hex(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


class PerWorker:
    """A value to broadcast, with an object that each Python worker makes of it once.

    The object lives as long as the worker's copy of the broadcast, so it is freed when the worker turns to tasks
    that do not use it; a worker never holds the caches of several operators.
    """

    def __init__(self, make: Callable, value: object) -> None:
        self.make, self.value, self.made = make, value, None

    def __getstate__(self) -> dict:
        return {"make": self.make, "value": self.value, "made": None}

    def get(self) -> object:
        if self.made is None:
            self.made = self.make(self.value)
        return self.made


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that maps each batch on its own; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run
