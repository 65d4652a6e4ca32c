"""JDBC source for the bronze extracts.

The table is read by name (``dbtable``) and the extract predicate is applied with
``.where``: Spark pushes it into the ``WHERE`` of the query it sends, so the database
does the filtering.  A raw ``query`` option cannot be combined with partitioned reads,
so it is used only when no partition column is given.

For large tables give ``partition_column`` and ``num_partitions``: Spark then issues one
range query per partition, run in parallel by the executors.  With both bounds given the
ranges are equal widths of any numeric, date or timestamp column.  Without them the column
must be a date or timestamp: the database counts the rows of each day, and neighbouring
days are joined into ranges of about equal row counts, so a wrong clock (1970, 2099) costs
no more than its own rows.  A day with more than a range's share is counted again by hour, and an
hour with more by minute, and cut there.  Rows without a time are read by a query of their own.

What time cannot cut (one minute, the rows without a time, a table without a time column) is cut by
a hash of a key column, evaluated by the database, if the extract names one or the database has a row
id of its own; rows without a key have a query too.  How a database hashes is ``HASH_SQL`` by the
kind of the URL, or ``JdbcSource.hash_sql``; other databases need a whole number as key.

Connection values come from the environment, never from code:

    PLANTLAKE_JDBC_URL, PLANTLAKE_JDBC_USER, PLANTLAKE_JDBC_PASSWORD, PLANTLAKE_JDBC_DRIVER
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ROWS_PER_RANGE = 5_000_000
WORTH_CUTTING = 100_000  # fewer rows are not counted again and not dealt by a key

# SQL by kind of database for a bucket 0 to n - 1 of a key, and row ids that every table has.
HASH_SQL = {
    "postgresql": "MOD(MOD(HASHTEXT(CAST({key} AS TEXT)), {n}) + {n}, {n})",
    "mysql": "MOD(CRC32({key}), {n})",
    "mariadb": "MOD(CRC32({key}), {n})",
    "oracle": "ORA_HASH({key}, {n} - 1)",
    "sqlserver": "ABS(CAST(CHECKSUM({key}) AS BIGINT)) % {n}",
}
WHOLE_NUMBER_SQL = "MOD(MOD({key}, {n}) + {n}, {n})"
ROW_IDS = {"postgresql": "ctid", "oracle": "ROWID"}


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetch_size: int = 10_000
    partition_column: str | None = None
    num_partitions: int = 1  # 0: one for every ROWS_PER_RANGE rows
    lower_bound: object | None = None
    upper_bound: object | None = None
    hash_key: str | None = None
    hash_sql: str | None = None  # with {key} and {n}: a whole number from 0 to n - 1

    def kind(self) -> str:
        """The kind of database: ``jdbc:<kind>:...``."""
        return self.url.split(":", 2)[1] if self.url.startswith("jdbc:") else ""

    def key_and_hash(self) -> tuple[str | None, str]:
        """What rows can be dealt by: a key, if there is one, and the SQL of its bucket."""
        key = self.hash_key or ROW_IDS.get(self.kind())
        return key, self.hash_sql or HASH_SQL.get(self.kind(), WHOLE_NUMBER_SQL)

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, **overrides) -> JdbcSource:
        env = os.environ if env is None else env
        values = {
            "url": env["PLANTLAKE_JDBC_URL"],
            "user": env.get("PLANTLAKE_JDBC_USER"),
            "password": env.get("PLANTLAKE_JDBC_PASSWORD"),
            "driver": env.get("PLANTLAKE_JDBC_DRIVER"),
        }
        values.update(overrides)
        return cls(**values)

    def connection_options(self) -> dict[str, str]:
        # zone-less database times keep their wall clock, whatever the zone of the machine
        opts = {"url": self.url, "fetchsize": str(self.fetch_size), "preferTimestampNTZ": "true"}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        return opts

    def partition_options(self, lower: object, upper: object) -> dict[str, str]:
        return {
            "partitionColumn": self.partition_column or "",
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(self.num_partitions),
        }


def _reader(spark: SparkSession, source: JdbcSource):
    return spark.read.format("jdbc").options(**source.connection_options())


def read_query(spark: SparkSession, source: JdbcSource, query: str) -> DataFrame:
    """Rows of a SQL query run by the database (one partition)."""
    return _reader(spark, source).option("query", query).load()


def fetch_day_counts(spark: SparkSession, source: JdbcSource, table: str, where: str | None) -> list[tuple[date | None, int]]:
    """Rows of each day of the partition column, counted by the database: one row a day, NULL times included."""
    day = f"CAST({source.partition_column} AS DATE)"
    cond = f" WHERE {where}" if where else ""
    counted = read_query(spark, source, f"SELECT {day} AS day, COUNT(*) AS n FROM {table}{cond} GROUP BY {day}")
    return [(r["day"], int(r["n"])) for r in counted.collect()]


Start = date | datetime


def moment(start: Start) -> datetime:
    return start if isinstance(start, datetime) else datetime.combine(start, time())


def _literal(start: Start) -> str:
    at = moment(start)
    return f"DATE '{at.date().isoformat()}'" if at.time() == time() else f"TIMESTAMP '{at:%Y-%m-%d %H:%M:%S}'"


def fetch_finer_counts(
    spark: SparkSession, source: JdbcSource, table: str, where: str | None, grain: str, hot: list[datetime], width: timedelta
) -> list[tuple[datetime, int]]:
    """Rows of each hour (or minute) of the stretches that begin at ``hot``, counted by the database in one query."""
    column = source.partition_column
    stretches = " OR ".join(f"({column} >= {_literal(d)} AND {column} < {_literal(d + width)})" for d in hot)
    fields = [f"CAST({column} AS DATE)", f"EXTRACT(HOUR FROM CAST({column} AS TIMESTAMP))"]
    if grain == "minute":
        fields.append(f"EXTRACT(MINUTE FROM CAST({column} AS TIMESTAMP))")
    named = ", ".join(f"{f} AS {n}" for f, n in zip(fields, ("day", "hour", "minute"), strict=False))
    kept = f"({where}) AND ({stretches})" if where else stretches
    rows = read_query(spark, source, f"SELECT {named}, COUNT(*) AS n FROM {table} WHERE {kept} GROUP BY {', '.join(fields)}").collect()
    return [(datetime.combine(r["day"], time(int(r["hour"]), int(r["minute"]) if grain == "minute" else 0)), int(r["n"])) for r in rows]


def fetch_counts(spark: SparkSession, source: JdbcSource, table: str, where: str | None) -> list[tuple[Start | None, int]]:
    """Rows by day; by hour in days, and by minute in hours, that hold more than a range's share; NULL times apart."""
    counts = fetch_day_counts(spark, source, table, where)
    share = max(WORTH_CUTTING, sum(n for _, n in counts) / max(1, wanted_ranges(source, counts)))
    for grain, width in (("hour", timedelta(days=1)), ("minute", timedelta(hours=1))):
        # an hour counts as hot only where its day was
        step = date if grain == "hour" else datetime
        hot = {moment(d) for d, n in counts if d is not None and n > share and (step is date or isinstance(d, datetime))}
        if not hot:
            break
        finer = fetch_finer_counts(spark, source, table, where, grain, sorted(hot), width)
        counts = [(d, n) for d, n in counts if d is None or moment(d) not in hot] + finer
    return counts


def wanted_ranges(source: JdbcSource, counts: Iterable[tuple[Start | None, int]]) -> int:
    return source.num_partitions or -(-sum(n for _, n in counts) // ROWS_PER_RANGE)


def range_starts(counts: Iterable[tuple[Start | None, int]], ranges: int) -> list[Start]:
    """First moments, ascending, of at most ``ranges`` runs of days (or parts of them); run k ends near k shares of the rows."""
    parts = sorted(((d, n) for d, n in counts if d is not None and n > 0), key=lambda x: moment(x[0]))
    share = sum(n for _, n in parts) / max(1, ranges)
    starts, before = [], 0
    for start, n in parts:
        if not starts or (before + n / 2 > len(starts) * share and len(starts) < ranges):
            starts.append(start)
        before += n
    return starts


def range_predicates(column: str, starts: list[Start]) -> list[str]:
    """One condition per range and one for NULL; together they hold for every row exactly once.

    The first range is open below and the last above, so rows that arrive after the count are read too.
    """
    edges = [_literal(d) for d in starts[1:]]
    out = []
    for lo, hi in zip([None, *edges], [*edges, None], strict=True):
        parts = [f"{column} >= {lo}" if lo else None, f"{column} < {hi}" if hi else None]
        out.append(" AND ".join(filter(None, parts)) or f"{column} IS NOT NULL")
    return [*out, f"{column} IS NULL"]


def hash_predicates(key: str, buckets: int, hash_sql: str) -> list[str]:
    """One condition per bucket of the key's hash and one for NULL keys; every row meets exactly one."""
    bucket = hash_sql.format(key=key, n=buckets)
    return [*(f"{key} IS NOT NULL AND {bucket} = {i}" for i in range(buckets)), f"{key} IS NULL"]


def dealt_predicates(source: JdbcSource, counts: list[tuple[Start | None, int]]) -> list[str]:
    """Conditions for the parallel read: ranges of time, and buckets of the key where one range still has twice its share."""
    ranges = wanted_ranges(source, counts)
    starts = range_starts(counts, ranges)
    share = max(1, sum(n for _, n in counts) / max(1, ranges))
    edges = [moment(d) for d in starts]
    sizes = [0] * max(1, len(starts)) + [sum(n for d, n in counts if d is None)]
    for d, n in counts:
        if d is not None and n > 0:
            sizes[bisect_right(edges, moment(d)) - 1] += n
    key, hash_sql = source.key_and_hash()
    out = []
    for condition, size in zip(range_predicates(source.partition_column, starts), sizes, strict=True):
        if key is not None and size > 2 * max(share, WORTH_CUTTING):
            out += [f"{condition} AND {p}" for p in hash_predicates(key, -(-size // int(share)), hash_sql)]
        else:
            out.append(condition)
    return out


def read_table(spark: SparkSession, source: JdbcSource, table: str, where: str | None = None) -> DataFrame:
    """``SELECT * FROM table WHERE where``, read in parallel when a partition column is set."""
    if source.partition_column and source.num_partitions != 1:
        if source.num_partitions and source.lower_bound is not None and source.upper_bound is not None:
            options = source.partition_options(source.lower_bound, source.upper_bound)
            df = _reader(spark, source).option("dbtable", table).options(**options).load()
        else:
            df = _read_ranges(spark, source, table, dealt_predicates(source, fetch_counts(spark, source, table, where)))
    elif source.num_partitions != 1 and source.key_and_hash()[0] is not None:
        df = _read_hashed(spark, source, table, where)
    else:
        df = _reader(spark, source).option("dbtable", table).load()
    return df if where is None else df.where(F.expr(where))


def _read_ranges(spark: SparkSession, source: JdbcSource, table: str, predicates: list[str]) -> DataFrame:
    """One task, and one query, per predicate."""
    options = source.connection_options()
    return spark.read.jdbc(options.pop("url"), table, predicates=predicates, properties=options)


def _read_hashed(spark: SparkSession, source: JdbcSource, table: str, where: str | None) -> DataFrame:
    """A table without a time column: one task, and one query, per bucket of the key, as many as its rows ask for."""
    cond = f" WHERE {where}" if where else ""
    rows = int(read_query(spark, source, f"SELECT COUNT(*) AS n FROM {table}{cond}").first()["n"])
    buckets = source.num_partitions or -(-rows // ROWS_PER_RANGE)
    if buckets <= 1:
        return _reader(spark, source).option("dbtable", table).load()
    key, hash_sql = source.key_and_hash()
    return _read_ranges(spark, source, table, hash_predicates(key, buckets, hash_sql))


def source_reader(spark: SparkSession, source: JdbcSource, schema: str | None = None):
    """``read_source`` callable for ``jobs.run_bronze``: an extract spec -> its rows.

    Unless ``source.num_partitions`` is 1, each table is read as that many (0: by its row count) range queries on the
    extract's ``split_by`` column (sized by the rows that the predicate keeps) and one for NULL times; an extract
    without a split column is dealt by the hash of its ``hash_by`` column, or read in one query if nothing names a key.
    """

    def read(x) -> DataFrame:
        src = replace(source, partition_column=x.split_by, hash_key=x.hash_by or source.hash_key)
        return read_table(spark, src, f"{schema}.{x.source}" if schema else x.source, x.where)

    return read
