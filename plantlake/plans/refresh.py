"""Refresh only the days that changed.

A rollup's buckets lie inside a day, so a day's rows of a derived table depend on that day's source rows alone.  Every
refresh stores a digest of each source day: the number of rows, the least and greatest time, and an order-free checksum of
the columns that the rollup reads.  The next refresh digests the source again, a pruned scan without a rollup, and
rebuilds the days whose digests differ; days that are gone lose their rows.  The target is stored by day, and only the
partitions of changed days are overwritten.

Digests are written last, so a refresh that fails in between is repeated for the same days.  The days themselves (one row
each, a few thousand in ten years) pass through the driver; no reading does.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.functions.timegrid import day_of
from plantlake.operators.rollup import Chain, Rollup
from plantlake.sources.catalog import is_v2_catalog, layer_tables, qualified, replace_table

DAY = "dia"  # partition column of a table that is kept by day
DIGEST_MARK = "__digest"


@dataclass(frozen=True)
class DayRefresh:
    """What a refresh did."""

    rebuilt: tuple[date | None, ...]
    removed: tuple[date | None, ...]
    unchanged: int


def _first(spec: Rollup | Chain) -> Rollup:
    return spec.steps[0] if isinstance(spec, Chain) else spec


def _last(spec: Rollup | Chain) -> Rollup:
    return spec.steps[-1] if isinstance(spec, Chain) else spec


def read_columns(df: DataFrame, spec: Rollup | Chain) -> list[str]:
    """The columns of ``df`` that the rollup's result depends on."""
    first = _first(spec)
    made = first.json.out_names() if first.json else ()
    needed = {c for c in first.input_columns() if c not in made} | ({first.json.column} if first.json else set())
    if first.where is not None:
        words = first.where.lower()
        needed |= {c for c in df.columns if c.lower() in words}  # more than it names does no harm
    return [c for c in df.columns if c in needed]


def day_digests(df: DataFrame, spec: Rollup | Chain) -> DataFrame:
    """One row a day: ``dia``, ``n``, ``least``, ``greatest`` and ``checksum``; a NULL time is a day of its own."""
    first = _first(spec)
    time = F.col(first.time)
    checksum = F.sum(F.xxhash64(*[F.col(c) for c in read_columns(df, spec)]).cast("decimal(20,0)"))
    return df.groupBy(day_of(time).alias(DAY)).agg(
        F.count("*").alias("n"), F.min(time).cast("string").alias("least"), F.max(time).cast("string").alias("greatest"), checksum.alias("checksum")
    )


def _on_days(time: str, days: list[date | None]) -> Column:
    """Rows of the given days, as few ranges of the time column, which a scan can skip files by."""
    out = F.col(time).isNull() if None in days else F.lit(False)
    runs: list[list[date]] = []
    for d in sorted(x for x in days if x is not None):
        if runs and runs[-1][1] == d:
            runs[-1][1] = d + timedelta(days=1)
        else:
            runs.append([d, d + timedelta(days=1)])
    for low, high in runs:
        out = out | ((F.col(time) >= F.lit(low)) & (F.col(time) < F.lit(high)))
    return out


def refresh_changed_days(source: DataFrame, spec: Rollup | Chain, catalog: str | None, layer: str, table: str) -> DayRefresh:
    """Bring ``<layer>.<table>``, kept by day in partitions ``dia``, up to date with ``source``.

    The first refresh builds every day.  Equal to a full refresh after any inserts, updates and deletes, as long as the
    spec stays the same; drop the table and its digests to build anew.
    """
    spark = source.sparkSession
    target, digests = qualified(catalog, layer, table), f"{table}{DIGEST_MARK}"
    stored = {t.lower() for t in layer_tables(spark, catalog, layer)}
    first_time = table.lower() not in stored or digests.lower() not in stored
    now = {r[DAY]: tuple(r) for r in day_digests(source, spec).collect()}  # one row a day
    before = {} if first_time else {r[DAY]: tuple(r) for r in spark.table(qualified(catalog, layer, digests)).collect()}
    changed = [d for d, row in now.items() if before.get(d) != row]
    gone = [d for d in before if d not in now]
    if first_time:
        _with_day(spec.build(source), spec).write.mode("overwrite").partitionBy(DAY).saveAsTable(target)
    elif changed or gone:
        rows = spec.build(source.where(_on_days(_first(spec).time, changed)))
        _replace_days(spark, rows, spec, catalog, target, [*changed, *gone])
    if first_time or changed or gone:
        replace_table(spark.createDataFrame(list(now.values()), _DIGESTS), catalog, layer, digests)
    return DayRefresh(tuple(sorted(changed, key=str)), tuple(sorted(gone, key=str)), len(now) - len(changed))


_DIGESTS = f"{DAY} date, n bigint, least string, greatest string, checksum decimal(30,0)"


def _with_day(rows: DataFrame, spec: Rollup | Chain) -> DataFrame:
    return rows.withColumn(DAY, day_of(_last(spec).key)).repartition(DAY).sortWithinPartitions(DAY, _last(spec).key)


MODE = "spark.sql.sources.partitionOverwriteMode"


def _overwrite_days(rows: DataFrame, target: str) -> None:
    """Replace the partitions that ``rows`` has; all others stay."""
    conf = rows.sparkSession.conf
    before = conf.get(MODE, "static")
    conf.set(MODE, "dynamic")  # a stored table takes the mode from the session alone
    try:
        rows.write.insertInto(target, overwrite=True)
    finally:
        conf.set(MODE, before)


def _replace_days(spark: SparkSession, rows: DataFrame, spec: Rollup | Chain, catalog: str | None, target: str, days: list[date | None]) -> None:
    if is_v2_catalog(spark, catalog):
        wanted = _on_partitions(days)
        _with_day(rows, spec).writeTo(target).overwrite(wanted)
        return
    _overwrite_days(_with_day(rows, spec), target)
    # days that have no rows any more are not overwritten by the write
    have = {r[DAY] for r in spark.table(target).where(_on_partitions(days)).select(DAY).distinct().collect()}  # at most one row a day
    left = {r[DAY] for r in rows.select(day_of(_last(spec).key).alias(DAY)).distinct().collect()}
    for d in have - left:
        value = f"DATE '{d.isoformat()}'" if d is not None else "NULL"
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({DAY} = {value})")


def _on_partitions(days: list[date | None]) -> Column:
    known = [F.lit(d) for d in days if d is not None]
    out = F.col(DAY).isin(*known) if known else F.lit(False)
    return out | F.col(DAY).isNull() if None in days else out
