"""Parallel reads: what would be sent to a database, answered by DuckDB inside this process."""

from datetime import date, datetime, timedelta

import duckdb
import pytest

from plantlake.plans.plant import plant_specs
from plantlake.sources import jdbc
from plantlake.sources.jdbc import JdbcSource, dealt_predicates, hash_predicates, range_starts

DUCK_HASH = "CAST(hash({key}) % {n} AS BIGINT)"


@pytest.fixture
def con():
    con = duckdb.connect()
    con.execute("create table t (id bigint, fecha timestamp, site int)")
    con.execute("create table omie (id bigint, precio double)")
    return con


@pytest.fixture
def recorded(spark, monkeypatch, con):
    """Counts are answered by DuckDB, range reads are recorded."""
    asked, read = [], []
    monkeypatch.setattr(jdbc, "WORTH_CUTTING", 1)

    class Reader:
        def __init__(self):
            self.opts = {}

        def option(self, k, v):
            self.opts[k] = v
            return self

        def load(self):
            if "query" not in self.opts:
                read.append((self.opts["dbtable"], [None]))
                return spark.range(1).selectExpr("1 as site")
            asked.append(self.opts["query"])
            rows = con.execute(self.opts["query"])
            names = [c[0] for c in rows.description]
            return [dict(zip(names, r, strict=True)) for r in rows.fetchall()]

    class Rows(list):
        collect = list.copy

        def first(self):
            return self[0]

    monkeypatch.setattr(jdbc, "_reader", lambda *_: Reader())
    monkeypatch.setattr(jdbc, "read_query", lambda _, __, query: Rows(Reader().option("query", query).load()))
    monkeypatch.setattr(jdbc, "_read_ranges", lambda _, __, table, predicates: read.append((table, predicates)) or spark.range(1).selectExpr("1 as site"))
    return asked, read


def sizes(con, table, predicates, where="true"):
    """Rows of each predicate; each row has to meet exactly one."""
    once = " + ".join(f"coalesce(({p})::int, 0)" for p in predicates)
    assert con.execute(f"select count(*) from {table} where {where} and ({once}) <> 1").fetchone()[0] == 0
    return [con.execute(f"select count(*) from {table} where {where} and ({p})").fetchone()[0] for p in predicates]


def test_a_day_with_half_of_all_rows_is_cut_by_hour_and_minute(spark, con, recorded):
    asked, read = recorded
    con.execute("insert into t select i, timestamp '2024-01-01' + interval (i % 40) day + interval (i % 1440) minute, i % 2 from range(20000) r(i)")
    con.execute("insert into t select i, timestamp '2024-01-09 10:00:00' + interval (i % 600) second, 0 from range(20000) r(i)")
    con.execute("insert into t select i, null, 0 from range(50) r(i)")
    src = JdbcSource("jdbc:x", partition_column="fecha", num_partitions=16)
    jdbc.read_table(spark, src, "t", "site < 5")
    ((_, predicates),) = read
    assert len(asked) == 3 and "EXTRACT(HOUR" in asked[1] and "EXTRACT(MINUTE" in asked[2] and all("site < 5" in q for q in asked)
    held = sizes(con, "t", predicates)
    assert sum(held) == 40050 and held[-1] == 50
    assert max(held) <= 2 * 40050 / 16  # by days alone one range would hold more than 20,000
    assert any("TIMESTAMP '2024-01-09 10:0" in p for p in predicates)


def test_even_days_are_counted_once(spark, con, recorded):
    asked, read = recorded
    con.execute("insert into t select i, timestamp '2024-01-01' + interval (i % 400) day, 0 from range(8000) r(i)")
    jdbc.read_table(spark, JdbcSource("jdbc:x", partition_column="fecha", num_partitions=8), "t")
    assert len(asked) == 1
    held = sizes(con, "t", read[0][1])
    assert len(held) == 9 and max(held) <= 1200


def test_a_hot_minute_and_missing_times_are_cut_by_the_key(spark, con, recorded):
    _, read = recorded
    con.execute("insert into t select i, timestamp '1970-01-01', 0 from range(6000) r(i)")
    con.execute("insert into t select i, null, 0 from range(6000) r(i)")
    con.execute("insert into t select null, timestamp '1970-01-01', 0 from range(30) r(i)")
    con.execute("insert into t select i, timestamp '2024-01-01' + interval (i) minute, 0 from range(4000) r(i)")
    src = JdbcSource("jdbc:x", partition_column="fecha", num_partitions=16, hash_key="id", hash_sql=DUCK_HASH)
    jdbc.read_table(spark, src, "t")
    held = sizes(con, "t", read[0][1])
    assert sum(held) == 16030 and max(held) <= 2 * 16030 / 16
    read.clear()
    jdbc.read_table(spark, JdbcSource("jdbc:x", partition_column="fecha", num_partitions=16), "t")  # no key: whole
    assert max(sizes(con, "t", read[0][1])) == 6030


def test_a_table_without_time_is_dealt_by_its_rows(spark, con, recorded, monkeypatch):
    asked, read = recorded
    con.execute("insert into omie select case when i % 10 = 0 then null else i end, i from range(5000) r(i)")
    monkeypatch.setattr(jdbc, "ROWS_PER_RANGE", 700)
    omie = next(x for x in plant_specs(with_market_prices=True, market_key="id").bronze if x.table == "omie")
    jdbc.source_reader(spark, JdbcSource("jdbc:x", num_partitions=0, hash_sql=DUCK_HASH))(omie)
    ((table, predicates),) = read
    assert asked == ["SELECT COUNT(*) AS n FROM omie"] and table == "omie" and len(predicates) == 8 + 1
    held = sizes(con, "omie", predicates)
    assert sum(held) == 5000 and held[-1] == 500 and max(held[:-1]) <= 2 * 4500 / 8
    read.clear()
    monkeypatch.setattr(jdbc, "ROWS_PER_RANGE", 5000)
    jdbc.source_reader(spark, JdbcSource("jdbc:x", num_partitions=0, hash_sql=DUCK_HASH))(omie)
    assert read == [("omie", [None])]  # few rows: one query


def test_hash_sql_by_kind_of_database(con):
    assert JdbcSource("jdbc:postgresql://h/db").key_and_hash() == ("ctid", jdbc.HASH_SQL["postgresql"])
    assert JdbcSource("jdbc:mysql://h/db", hash_key="id").key_and_hash() == ("id", "MOD(CRC32({key}), {n})")
    assert JdbcSource("jdbc:other:x").key_and_hash() == (None, jdbc.WHOLE_NUMBER_SQL)
    assert JdbcSource("jdbc:other:x", hash_sql="f({key}) % {n}").key_and_hash()[1] == "f({key}) % {n}"
    con.execute("insert into omie select i - 50, 0 from range(101) r(i)")
    con.execute("insert into omie values (null, 1)")
    held = sizes(con, "omie", hash_predicates("id", 7, jdbc.WHOLE_NUMBER_SQL.replace("MOD(", "mod(")))
    assert sum(held) == 102 and held[-1] == 1 and min(held[:-1]) == 14


def test_no_rows_and_only_missing_times():
    src = JdbcSource("jdbc:x", partition_column="fecha", num_partitions=4)
    assert dealt_predicates(src, []) == ["fecha IS NOT NULL", "fecha IS NULL"]
    assert dealt_predicates(src, [(None, 7)]) == ["fecha IS NOT NULL", "fecha IS NULL"]


def test_starts_mix_days_and_parts_of_days():
    day = date(2024, 1, 2)
    parts = [(datetime(2024, 1, 2, h), 10) for h in range(24)]
    starts = range_starts([(date(2024, 1, 1), 20), (date(2024, 1, 3), 20), *parts], 14)
    assert starts[0] == date(2024, 1, 1) and len(starts) == 14
    assert all(jdbc.moment(a) < jdbc.moment(b) for a, b in zip(starts, starts[1:]))
    assert jdbc.range_predicates("c", [day, datetime(2024, 1, 2, 5, 30), day + timedelta(1)])[1] == "c >= TIMESTAMP '2024-01-02 05:30:00' AND c < DATE '2024-01-03'"
