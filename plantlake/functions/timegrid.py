"""Time grids: tumbling buckets inside the hour, and calendar days.

The bucket is a plain Column expression, so it stays inside whole-stage codegen and
keeps the input's timestamp flavour (``timestamp`` or ``timestamp_ntz``).  A NULL
timestamp gives a NULL bucket, so the NULL group survives ``groupBy`` the way
``date_trunc`` keeps it (``F.window`` would drop those rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_start(ts: ColumnOrName, minutes: int = 15) -> Column:
    """Start of the left-closed ``minutes``-wide bucket that holds ``ts``.

    Equal to ``date_trunc('hour', ts) + interval 'minutes' * floor(minute(ts) / minutes)``
    for every width that divides the hour; 60 gives the hour itself.  Seconds and
    microseconds are dropped by subtracting them as a day-time interval, which works
    before 1970 and for zoned and zone-less timestamps alike.
    """
    if minutes <= 0 or 60 % minutes:
        raise ValueError(f"bucket width must divide 60 minutes, got {minutes}")
    ts = _col(ts)
    into_bucket = F.make_dt_interval(
        F.lit(0),
        F.lit(0),
        F.minute(ts) % F.lit(minutes),
        F.date_part(F.lit("SECOND"), ts),
    )
    return ts - into_bucket


def with_bucket(df: DataFrame, name: str, ts: str, minutes: int = 15) -> DataFrame:
    """``df`` with ``bucket_start(ts, minutes)`` as column ``name``.

    Zone-less timestamps take a tumbling window's start, which is long arithmetic in codegen; a NULL time gets a
    place-holder there and a NULL bucket after it.  Zoned ones keep ``bucket_start``: their hour may start between
    two whole hours of UTC.
    """
    if minutes <= 0 or 60 % minutes:
        raise ValueError(f"bucket width must divide 60 minutes, got {minutes}")
    if not isinstance(df.select(F.col(ts)).schema[0].dataType, TimestampNTZType):
        return df.withColumn(name, bucket_start(ts, minutes))
    time = F.col(ts)
    filled = F.coalesce(time, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return df.withColumn(name, F.when(time.isNotNull(), F.window(filled, f"{minutes} minutes")["start"]))


def hour_start(ts: ColumnOrName) -> Column:
    """``date_trunc('hour', ts)`` that keeps the input's timestamp type."""
    return bucket_start(ts, 60)


def day_of(ts: ColumnOrName) -> Column:
    """Calendar date of ``ts`` (``date(ts)`` / ``CAST(ts AS date)``).

    Zoned timestamps are read in the session time zone; ``timestamp_ntz`` needs none.
    """
    return F.to_date(_col(ts))


# Grain names accepted by the rollup specs, with their width in minutes (fixed values).
GRAINS = {
    "15 minutes": 15,
    "1 hour": 60,
    "1 day": 1440,
}


def grain_minutes(grain: str | int) -> int:
    if isinstance(grain, int):
        minutes = grain
    elif grain in GRAINS:
        minutes = GRAINS[grain]
    else:
        raise ValueError(f"unknown grain {grain!r}; use one of {sorted(GRAINS)} or a width in minutes")
    if minutes != 1440 and (minutes <= 0 or 60 % minutes):
        raise ValueError(f"grain must divide the hour or be one day, got {minutes} minutes")
    return minutes


def with_grain_key(df: DataFrame, name: str, ts: str, grain: str | int) -> DataFrame:
    """``df`` with the key column of a grain."""
    minutes = grain_minutes(grain)
    return df.withColumn(name, day_of(ts)) if minutes == 1440 else with_bucket(df, name, ts, minutes)


def grain_key(ts: ColumnOrName, grain: str | int) -> Column:
    """Key column for a grain: a bucket start below one day, a ``date`` at one day."""
    minutes = grain_minutes(grain)
    return day_of(ts) if minutes == 1440 else bucket_start(ts, minutes)
