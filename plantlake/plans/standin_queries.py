"""The operator inventory as runnable queries over the driver's tables.

Each function takes ``(spark, data_dir)`` and returns a lazy DataFrame.  The plant specs
run unchanged on plant-shaped projections of ``events`` (``sources.standins``); only the
site parameters differ (battery devices and radiation JSON keys of the stand-in).

Results are returned as relations, without the trailing sort of the stored tables: the
layer jobs sort when they write (``ordered=True``), which is where the row order matters.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.functions.jsoncols import JsonUnpack, unpack
from plantlake.functions.rounding import stable_round_sql
from plantlake.functions.timegrid import day_of, with_bucket
from plantlake.plans.jobs import preview
from plantlake.plans.layers import build_step, fused_daily_balance, silver_frames
from plantlake.plans.plant import EMI_JSON_KEYS, Extract, Plant, plant_specs
from plantlake.sources.catalog import register_view
from plantlake.sources.standins import (
    STANDIN_BATTERY_DEVICES,
    STANDIN_EMI_KEYS,
    lineitem_bronze,
    standin_bronze,
)
from plantlake.sources.tables import extract, read_parquet_table

Query = Callable[[SparkSession, str], DataFrame]


def standin_plant(silver_sums: str = "plain") -> Plant:
    """The plant specs with the stand-in's devices and JSON keys; bronze extracts take every row."""
    plant = plant_specs(battery_devices=STANDIN_BATTERY_DEVICES, emi_keys=STANDIN_EMI_KEYS, silver_sums=silver_sums)
    bronze = tuple(Extract(x.table, x.source, None, x.split_by) for x in plant.bronze)
    return Plant(bronze, plant.silver, plant.gold, plant.joined_sides, plant.exploratory)


PLANT = standin_plant()
EXACT_PLANT = standin_plant(silver_sums="exact")


def events(spark: SparkSession, data_dir: str) -> DataFrame:
    return read_parquet_table(spark, data_dir, "events")


def bronze(spark: SparkSession, data_dir: str) -> Mapping[str, DataFrame]:
    return standin_bronze(events(spark, data_dir))


# --- time grid and JSON (H1-H7, H13, H14) -------------------------------------------------

def time_grid(spark: SparkSession, data_dir: str) -> DataFrame:
    grid = with_bucket(with_bucket(events(spark, data_dir), "time_interval", "ts", 15), "hora", "ts", 60)
    return grid.select("event_id", "time_interval", "hora", day_of("ts").alias("fecha"))


def json_unpack(spark: SparkSession, data_dir: str) -> DataFrame:
    spec = JsonUnpack("props", STANDIN_EMI_KEYS, EMI_JSON_KEYS, cast=None)
    return unpack(events(spark, data_dir), spec, keep=["event_id"])


# --- silver (C1-C9), exploratory (F1, F2) ----------------------------------------------------

def silver(table: str) -> Query:
    def q(spark: SparkSession, data_dir: str) -> DataFrame:
        return build_step(PLANT.silver_step(table), bronze(spark, data_dir))

    q.__name__ = f"silver_{table}"
    return q


def explore_pcs(spark: SparkSession, data_dir: str) -> DataFrame:
    return build_step(PLANT.exploratory_step("pcs"), bronze(spark, data_dir))


def preview_pcs(spark: SparkSession, data_dir: str) -> DataFrame:
    """What the exploratory job displays: the first 20 rows of the ordered rollup (a top-k, not a sort)."""
    return preview(build_step(PLANT.exploratory_step("pcs"), bronze(spark, data_dir), ordered=True))


def preview_rack(spark: SparkSession, data_dir: str) -> DataFrame:
    """The exploratory job's second display: the first 20 rows of the ordered rack rollup."""
    return preview(build_step(PLANT.silver_step("rack"), bronze(spark, data_dir), ordered=True))


# --- gold (D1-D5) and the joined table (E1-E4) -----------------------------------------------

def gold(table: str) -> Query:
    def q(spark: SparkSession, data_dir: str) -> DataFrame:
        step = PLANT.gold_step(table)
        silver_in = silver_frames(PLANT, bronze(spark, data_dir), only=[step.source])
        return build_step(step, silver_in)

    q.__name__ = f"gold_{table}"
    return q


# --- the same specs on the larger lineitem table ----------------------------------------------

def silver_pcs_lineitem(spark: SparkSession, data_dir: str) -> DataFrame:
    bronze_in = lineitem_bronze(read_parquet_table(spark, data_dir, "lineitem"))
    return build_step(PLANT.silver_step("pcs"), bronze_in)


def silver_pcs_exact(spark: SparkSession, data_dir: str) -> DataFrame:
    """The same rollup with means that do not depend on the order of the rows."""
    bronze_in = lineitem_bronze(read_parquet_table(spark, data_dir, "lineitem"))
    return build_step(EXACT_PLANT.silver_step("pcs"), bronze_in)


def gold_meter_lineitem(spark: SparkSession, data_dir: str) -> DataFrame:
    bronze_in = lineitem_bronze(read_parquet_table(spark, data_dir, "lineitem"))
    return build_step(PLANT.gold_step("aarr"), silver_frames(PLANT, bronze_in, only=["aarr"]))


def daily_balance(spark: SparkSession, data_dir: str) -> DataFrame:
    return fused_daily_balance(PLANT, bronze(spark, data_dir))


# --- bronze extracts (B1-B10): equality predicates pushed to the scan -------------------------

def bronze_extract(table: str, where: str | None) -> Query:
    spec = Extract(table, table, where, split_by=None)

    def q(spark: SparkSession, data_dir: str) -> DataFrame:
        return extract(read_parquet_table(spark, data_dir, spec.source), spec.where)

    return q


# --- SQL text over a temp view (A7, A8) -------------------------------------------------------

def bucket_start_sql(col: str, minutes: int = 15) -> str:
    """SQL text of ``timegrid.bucket_start`` for use inside ``spark.sql``."""
    return f"{col} - make_dt_interval(0, 0, minute({col}) % {minutes}, date_part('SECOND', {col}))"


def view_sql(spark: SparkSession, data_dir: str) -> DataFrame:
    view = register_view(bronze(spark, data_dir)["aarr"], "plantlake_bronze_aarr")
    r = stable_round_sql
    return spark.sql(
        f"""
        SELECT {bucket_start_sql('fecha')} AS time_interval,
               {r('avg(pa)')} AS pa,
               {r('max(ea_import) - min(ea_import)')} AS ea_import,
               {r('max(ea_export) - min(ea_export)')} AS ea_export
        FROM {view}
        GROUP BY 1
        """
    )
