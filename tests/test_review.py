"""Cases raised in review: lossless rounding, fast buckets, predicates that run, escaping, settings, lifecycle."""

import json
import math
import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from plantlake.functions.measures import delta, mean, total
from plantlake.functions.rounding import stable_round
from plantlake.functions.timegrid import bucket_start, with_bucket
from plantlake.operators.daily_join import energy_balance
from plantlake.operators.rollup import Rollup, sql_in, sql_literal
from plantlake.plans.jobs import run_bronze
from plantlake.plans.plant import plant_specs
from plantlake.sources import catalog
from plantlake.sources.jdbc import JdbcSource
from plantlake.sources.tables import extract

T = datetime(2024, 1, 1, 10, 7)


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("x", [math.nan, math.inf, -math.inf, 1e33, -1e33, 9.9e30])
def test_values_beyond_the_decimal_round_plainly(spark, x):
    row = spark.createDataFrame([(x,)], "x double").select(stable_round("x").alias("s"), F.round("x", 1).alias("p")).first()
    assert same(row.s, row.p)


def test_odd_values_pass_through_the_layers(spark):
    rows = [(T, math.nan, 1.0), (T, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "fecha timestamp_ntz, pa double, ea double")
    silver = Rollup("t", (mean("pa"), delta("pa", "ea_gen"))).build(df)
    got = silver.first()
    assert math.isnan(got.pa) and math.isnan(got.ea_gen)
    gold = Rollup("d", (total("ea_gen"),), time="time_interval", grain="1 day", key="fecha").build(silver).first()
    assert math.isnan(gold.ea_gen)
    terms = spark.createDataFrame([(1e33, 1.0, 1.0, 1.0, 1.0)], "ea_import double, ea_descarga double, ea_gen double, ea_export double, ea_carga double")
    assert terms.select(energy_balance().alias("b")).first().b == 1e33


def test_plain_rounding_can_be_chosen(spark):
    df = spark.createDataFrame([(T, 0.04999999999)], "fecha timestamp_ntz, pa double")
    both = Rollup("t", (mean("pa", "s"), mean("pa", "p", rounding="plain"))).build(df).first()
    assert (both.s, both.p) == (0.1, 0.0)
    with pytest.raises(ValueError):
        mean("pa", rounding="other")


def test_stable_and_plain_rounding_differ_only_at_ties(spark):
    df = spark.range(20000).select((F.rand(3) * 1000).alias("x")).unionByName(spark.range(2000).select((F.col("id") / 20).alias("x")))
    off = df.where((stable_round("x") != F.round("x", 1)) & (F.abs(F.abs(F.col("x") * 10 % 1) - 0.5) > 2e-5))
    assert off.count() == 0


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "Europe/Madrid"])
def test_fast_bucket_equals_the_general_one(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = [(x,) for x in (T, datetime(1969, 12, 31, 23, 59, 59, 999999), datetime(1900, 2, 3, 4, 59, 1), datetime(2199, 3, 31, 2, 31), None)]
        for kind in ("timestamp_ntz", "timestamp"):
            df = spark.createDataFrame(times, "ts timestamp_ntz").select(F.col("ts").cast(kind).alias("ts"))
            for minutes in (1, 2, 3, 4, 5, 6, 10, 12, 15, 20, 30, 60):
                out = with_bucket(df, "b", "ts", minutes).withColumn("e", bucket_start("ts", minutes))
                assert out.where(~F.col("b").eqNullSafe(F.col("e"))).count() == 0
                assert out.count() == len(times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


ODD = ["l'aldea", "a\\b", "50%", "señal_ñ", "x", None]


@pytest.mark.parametrize("value", ODD[:-1])
def test_predicates_select_exactly_their_rows(spark, value):
    df = spark.createDataFrame([(v,) for v in ODD], "localidad string")
    town = next(x.where for x in plant_specs(town=value).bronze if x.table == "prediccion_meteo")
    for where in (town, sql_in("localidad", (value,)), f"localidad = {sql_literal(value)}"):
        assert [r[0] for r in df.where(where).collect()] == [value]


def test_bronze_specs_run_with_their_predicates(spark):
    specs = plant_specs(site=11, meter=42, town="cieza")
    rows = [(11, 42, "cieza", T, 1), (11, 7, "otra", T, 2), (12, 42, None, T, 3), (None, None, "cieza", T, 4), (11, None, "x", None, 5)]
    source = spark.createDataFrame(rows, "instalacion int, equipo int, localidad string, fecha timestamp_ntz, n int")
    try:
        run_bronze(spark, specs, lambda x: extract(source, x.where), layer="bronze_review")
        expected = {"aarr": [1], "prediccion_meteo": [1, 4]}
        for x in specs.bronze:
            got = sorted(r.n for r in spark.table(f"bronze_review.{x.table}").collect())
            assert got == expected.get(x.table, [1, 2, 5])
    finally:
        catalog.drop_layer(spark, None, "bronze_review")


def test_drop_layer_with_a_view_and_with_capitals(spark):
    spark.sql("CREATE DATABASE Review1")
    spark.range(3).write.saveAsTable("Review1.t")
    spark.sql("CREATE VIEW Review1.v AS SELECT 1 AS x")
    assert catalog.drop_layer(spark, None, "Review1") == ["t"]
    assert not catalog.layer_exists(spark, None, "Review1")
    assert catalog.drop_layer(spark, None, "Review1") == []


def test_a_replaced_session_catalog_counts_as_v2(spark):
    assert not catalog.is_v2_catalog(spark, None)
    assert not catalog.is_v2_catalog(spark, "spark_catalog")


def test_database_times_keep_their_wall_clock():
    assert JdbcSource("jdbc:x:y").connection_options()["preferTimestampNTZ"] == "true"


def test_submitted_settings_win():
    code = (
        "import json; from plantlake.session import build_session; s = build_session('t', master='local[1]');"
        "print('GOT', json.dumps([s.conf.get(k) for k in ('spark.sql.adaptive.coalescePartitions.initialPartitionNum',"
        "'spark.sql.session.timeZone', 'spark.sql.autoBroadcastJoinThreshold', 'spark.sql.adaptive.coalescePartitions.parallelismFirst')])); s.stop()"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    submit = (
        "--conf spark.ui.enabled=false --conf spark.sql.adaptive.coalescePartitions.initialPartitionNum=64 "
        "--conf spark.sql.session.timeZone=Europe/Madrid --conf spark.sql.autoBroadcastJoinThreshold=12345 pyspark-shell"
    )
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": submit, "PYTHONPATH": root}
    env.pop("PLANTLAKE_TIMEZONE", None)
    for key in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET"):
        env.pop(key, None)
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=root)
    line = next(x for x in out.stdout.splitlines() if x.startswith("GOT"))
    assert json.loads(line[4:]) == ["64", "Europe/Madrid", "12345", "false"]
