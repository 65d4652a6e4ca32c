"""Column building blocks on inline rows with hand-computed answers (FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlake.functions import bucket_start, day_of, hour_start, stable_round
from plantlake.functions.jsoncols import JsonUnpack, unpack
from plantlake.functions.timegrid import grain_minutes

D = dt.datetime


def test_bucket_edges_ntz(spark):
    rows = [
        (1, D(2024, 1, 1, 10, 0, 0)),
        (2, D(2024, 1, 1, 10, 14, 59, 999999)),
        (3, D(2024, 1, 1, 10, 15, 0)),
        (4, D(2024, 1, 1, 10, 59, 59)),
        (5, D(2024, 1, 1, 23, 59, 59)),
        (6, None),
    ]
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("ts", T.TimestampNTZType())])
    df = spark.createDataFrame(rows, schema).select("id", bucket_start("ts").alias("b"))
    assert df.schema["b"].dataType == T.TimestampNTZType()
    got = {r.id: r.b for r in df.collect()}
    assert got == {
        1: D(2024, 1, 1, 10, 0),
        2: D(2024, 1, 1, 10, 0),
        3: D(2024, 1, 1, 10, 15),
        4: D(2024, 1, 1, 10, 45),
        5: D(2024, 1, 1, 23, 45),
        6: None,
    }


def test_null_bucket_group_is_kept(spark):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (D(2024, 1, 1, 0, 1), 5.0)], schema)
    out = df.groupBy(bucket_start("ts").alias("b")).agg(F.avg("v").alias("m")).collect()
    assert {r.b: r.m for r in out} == {None: 2.0, D(2024, 1, 1, 0, 0): 5.0}


def test_bucket_before_1970_and_hour(spark):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType())])
    df = spark.createDataFrame([(D(1969, 12, 31, 23, 52, 30, 5),)], schema)
    r = df.select(bucket_start("ts").alias("q"), hour_start("ts").alias("h"), day_of("ts").alias("d")).first()
    assert r.q == D(1969, 12, 31, 23, 45)
    assert r.h == D(1969, 12, 31, 23, 0)
    assert r.d == dt.date(1969, 12, 31)


def test_bucket_keeps_zoned_type_and_matches_sql_form_across_dst(spark):
    # Zoned timestamps around both 2024 clock changes in Madrid; compare with the SQL form
    # date_trunc('hour', ts) + interval 15 minutes * floor(minute / 15).
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        base = spark.sql(
            "SELECT explode(sequence(timestamp'2024-03-31 00:00:00', timestamp'2024-03-31 05:00:00', "
            "interval 7 minutes)) AS ts UNION ALL SELECT explode(sequence(timestamp'2024-10-27 00:00:00', "
            "timestamp'2024-10-27 05:00:00', interval 7 minutes)) AS ts"
        )
        out = base.select(
            bucket_start("ts").alias("mine"),
            F.expr("date_trunc('hour', ts) + make_dt_interval(0, 0, floor(minute(ts) / 15) * 15, 0)").alias("ref"),
            F.window("ts", "15 minutes").start.alias("win"),
        )
        assert out.schema["mine"].dataType == T.TimestampType()
        bad = out.where("mine <> ref OR mine <> win").count()
        assert bad == 0
        assert out.count() > 80
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("minutes", [7, 0, 90])
def test_bucket_width_must_divide_hour(minutes):
    with pytest.raises(ValueError):
        bucket_start("ts", minutes)


def test_grain_names():
    assert grain_minutes("15 minutes") == 15
    assert grain_minutes("1 hour") == 60
    assert grain_minutes("1 day") == 1440
    with pytest.raises(ValueError):
        grain_minutes("1 week")


def test_stable_round(spark):
    vals = [(0.25,), (-0.25,), (2.45,), (0.15000000000000036,), (None,), (1.04,), (-1.05,)]
    df = spark.createDataFrame(vals, "x double").select(stable_round("x", 1).alias("r"))
    assert df.schema["r"].dataType == T.DoubleType()
    assert [r.r for r in df.collect()] == [0.3, -0.3, 2.5, 0.2, None, 1.0, -1.1]


def test_stable_round_digits(spark):
    df = spark.createDataFrame([(Decimal("1.2345"),)], "x decimal(10,4)").select(stable_round("x", 2).alias("r"))
    assert df.first().r == 1.23


def test_delta_and_mean(spark):
    from plantlake.functions.measures import delta, mean

    rows = [("a", 5.0), ("a", 7.0), ("a", 9.0), ("b", 5.0), ("c", None), ("c", 5.0), ("d", None),
            ("e", 90.0), ("e", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.x for r in df.groupBy("g").agg(delta("x").column()).collect()}
    assert got == {"a": 4.0, "b": 0.0, "c": 0.0, "d": None, "e": 88.0}

    rows = [("a", 1.0), ("a", None), ("a", 2.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.x for r in df.groupBy("g").agg(mean("x").column()).collect()}
    assert got == {"a": 1.5, "b": None}


def test_measure_kinds():
    from plantlake.functions.measures import Measure

    with pytest.raises(ValueError):
        Measure("median", "x", "x")


def test_json_unpack_edges(spark):
    docs = [
        (1, '{"radiacion": 12.5, "radiacion1": 3}'),
        (2, "bad"),
        (3, None),
        (4, '{"other": 1}'),
        (5, '{"radiacion": null}'),
        (6, '{"radiacion": {"a": 1}}'),
        (7, '{"Radiacion": 4}'),
        (8, "[1, 2]"),
        (9, '{"radiacion": "n/a"}'),
    ]
    df = spark.createDataFrame(docs, "id int, j string")
    text = unpack(df, JsonUnpack("j", ("radiacion", "radiacion1"), cast=None), keep=["id"])
    got = {r.id: (r.radiacion, r.radiacion1) for r in text.collect()}
    assert got[1] == ("12.5", "3")
    assert got[2] == (None, None)
    assert got[3] == (None, None)
    assert got[4] == (None, None)
    assert got[5] == (None, None)
    assert got[6][0] == '{"a":1}'
    assert got[7] == (None, None)
    assert got[8] == (None, None)
    assert got[9] == ("n/a", None)

    typed = unpack(df, JsonUnpack("j", ("radiacion",), ("rad",)), keep=["id"])
    assert typed.schema["rad"].dataType == T.DoubleType()
    got = {r.id: r.rad for r in typed.collect()}
    assert got[1] == 12.5 and got[9] is None and got[6] is None


def test_json_unpack_names_must_match_keys():
    with pytest.raises(ValueError):
        JsonUnpack("j", ("a", "b"), ("x",)).out_names()


def test_json_unpack_repeated_key_takes_the_last_value(spark):
    # Pinned because a faster typed read disagreed here (it kept the first number).
    docs = [(1, '{"a": 0.0, "a": "n/a"}'), (2, '{"a": 1, "a": 2}'), (3, '{"a": "x", "a": 3.5}')]
    df = spark.createDataFrame(docs, "id int, j string")
    got = {r.id: r.a for r in unpack(df, JsonUnpack("j", ("a",)), keep=["id"]).collect()}
    assert got == {1: None, 2: 2.0, 3: 3.5}
    two = {r.id: (r.a, r.b) for r in unpack(df, JsonUnpack("j", ("a", "b")), keep=["id"]).collect()}
    assert two == {1: (None, None), 2: (2.0, None), 3: (3.5, None)}
