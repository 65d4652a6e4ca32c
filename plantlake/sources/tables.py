"""Reading parquet tables by directory, and the extract predicate."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_parquet_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """``<data_dir>/<name>.parquet`` (a file or a directory of part files)."""
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))


def extract(df: DataFrame, where: str | None) -> DataFrame:
    """``SELECT * FROM source WHERE <where>``: the filter is pushed to the scan."""
    return df if where is None else df.where(where)
