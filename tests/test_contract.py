"""Driver contract: entry runs; every query key has an oracle; Spark equals DuckDB on sf0.001."""

import datetime as dt
import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "fecha", "ea_import", "ea_export", "ea_carga", "ea_descarga", "ea_gen", "ea_consumo", "radiacion", "rad_pred",
    ]
    assert df.count() > 0


# The text operators, if they are there, have tests of their own.
OWN = sorted(set(entry.queries()) - set(entry.text_queries()))


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


@pytest.mark.parametrize("key", OWN)
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    s_table = sdf.toArrow()
    s_rows = [tuple(r.values()) for r in s_table.to_pylist()]
    d_table = duck.sql(entry.oracle_sql()[key]).to_arrow_table()
    d_cols = d_table.column_names
    d_rows = [tuple(r.values()) for r in d_table.to_pylist()]
    assert sorted(sdf.columns) == sorted(d_cols)
    s_types = {f.name: str(f.type) for f in s_table.schema}
    assert s_types == {f.name: str(f.type) for f in d_table.schema}
    assert len(s_rows) == len(d_rows)
    assert _digest(sdf.columns, s_rows) == _digest(d_cols, d_rows)


@pytest.mark.parametrize("key", ["daily_balance", "gold_radiation", "silver_strings"])
def test_results_do_not_depend_on_session_settings(spark, duck, key):
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "13",
        "spark.sql.session.timeZone": "America/Los_Angeles",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        s_table = entry.queries()[key](spark, SF_SMALL).toArrow()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    d_table = duck.sql(entry.oracle_sql()[key]).to_arrow_table()
    s_rows = [tuple(r.values()) for r in s_table.to_pylist()]
    d_rows = [tuple(r.values()) for r in d_table.to_pylist()]
    assert _digest(s_table.column_names, s_rows) == _digest(d_table.column_names, d_rows)
