"""Rollup and day-join operators on inline rows, plus properties over the events table."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from plantlake.functions.measures import avg, delta, high, low, mean, total
from plantlake.operators.daily_join import DaySide, day_join, energy_balance, join_on_day, stack_on_day
from plantlake.operators.rollup import Chain, Rollup, sql_in, sql_literal
from plantlake.plans import standin_queries as q

D = dt.datetime


def _readings(spark, rows):
    schema = T.StructType(
        [
            T.StructField("fecha", T.TimestampNTZType()),
            T.StructField("equipo", T.IntegerType()),
            T.StructField("pa", T.DoubleType()),
            T.StructField("ea", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def test_rollup_device_filter_and_measures(spark):
    rows = [
        (D(2024, 1, 1, 10, 1), 97, 1.0, 10.0),
        (D(2024, 1, 1, 10, 2), 98, 2.0, 10.0),
        (D(2024, 1, 1, 10, 14), 98, 3.0, 12.5),
        (D(2024, 1, 1, 10, 16), 98, 4.0, 13.0),
        (D(2024, 1, 1, 10, 3), 99, 5.0, 1.0),
        (D(2024, 1, 1, 10, 4), None, 6.0, 1.0),
    ]
    spec = Rollup("b", (mean("pa"), delta("ea", "ea_carga")), by=("equipo",), where=sql_in("equipo", (98, 99)))
    out = spec.build(_readings(spark, rows), ordered=True)
    assert out.columns == ["time_interval", "equipo", "pa", "ea_carga"]
    assert [tuple(r) for r in out.collect()] == [
        (D(2024, 1, 1, 10, 0), 98, 2.5, 2.5),
        (D(2024, 1, 1, 10, 0), 99, 5.0, 0.0),
        (D(2024, 1, 1, 10, 15), 98, 4.0, 0.0),
    ]


def test_group_key_not_captured_by_input_column(spark):
    # The input already has a column named like the output key; the key must still be the bucket.
    rows = [(D(2024, 1, 1, 10, 1), 1, 1.0, 0.0), (D(2024, 1, 1, 10, 20), 1, 3.0, 0.0)]
    df = _readings(spark, rows).withColumn("time_interval", F.lit(D(2000, 1, 1)))
    out = Rollup("x", (mean("pa"),)).build(df, ordered=True)
    assert [r.time_interval for r in out.collect()] == [D(2024, 1, 1, 10, 0), D(2024, 1, 1, 10, 15)]


def test_hourly_grain_and_daily_chain(spark):
    rows = [
        (D(2024, 1, 1, 10, 0), 1, 1.0, 0.0),
        (D(2024, 1, 1, 10, 15), 1, 3.0, 0.0),
        (D(2024, 1, 1, 11, 0), 1, 10.0, 0.0),
        (D(2024, 1, 2, 0, 30), 1, 7.0, 0.0),
    ]
    hourly = Rollup("h", (avg("pa"),), time="fecha", grain="1 hour", key="hora")
    daily = Rollup("d", (total("pa"),), time="hora", grain="1 day", key="fecha")
    out = Chain("emi", (hourly, daily)).build(_readings(spark, rows), ordered=True)
    assert out.columns == ["fecha", "pa"]
    assert [tuple(r) for r in out.collect()] == [(dt.date(2024, 1, 1), 12.0), (dt.date(2024, 1, 2), 7.0)]
    with pytest.raises(ValueError):
        Chain("empty", ())


def test_daily_extremes(spark):
    schema = "time_interval timestamp_ntz, soc double"
    df = spark.createDataFrame(
        [(D(2024, 1, 1, 0, 0), 40.04), (D(2024, 1, 1, 12, 0), 80.05), (D(2024, 1, 2, 0, 0), None)], schema
    )
    spec = Rollup("g", (high("soc", "max_soc"), low("soc", "min_soc")), time="time_interval", grain="1 day",
                  key="fecha")
    got = {r.fecha: (r.max_soc, r.min_soc) for r in spec.build(df).collect()}
    assert got == {dt.date(2024, 1, 1): (80.1, 40.0), dt.date(2024, 1, 2): (None, None)}


def test_rollup_needs_measures_and_valid_grain():
    with pytest.raises(ValueError):
        Rollup("x", ())
    with pytest.raises(ValueError):
        Rollup("x", (mean("pa"),), grain=45)


def test_sql_literals():
    assert sql_in("equipo", (98, 99)) == "equipo IN (98, 99)"
    assert sql_literal("o'k") == "'o''k'"
    with pytest.raises(ValueError):
        sql_in("equipo", ())


def test_day_join_inner_semantics_and_balance(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    aarr = spark.createDataFrame([(d1, 10.0, 1.0), (d2, 10.0, 1.0), (d3, 5.0, 1.0), (None, 1.0, 1.0)],
                                 "fecha date, ea_import double, ea_export double")
    bat = spark.createDataFrame([(d1, 2.0, 3.0), (d2, None, 3.0), (d3, 1.0, 1.0), (None, 1.0, 1.0)],
                                "fecha date, ea_carga double, ea_descarga double")
    log = spark.createDataFrame([(d1, 4.25), (d2, 4.0), (None, 1.0)], "fecha date, ea_gen double")
    sides = (DaySide("aarr", ("ea_import", "ea_export")), DaySide("bat", ("ea_carga", "ea_descarga")),
             DaySide("log", (("ea_gen", "gen"),)))
    out = day_join({"aarr": aarr, "bat": bat, "log": log}, sides,
                   ("fecha", "gen", ("ea_consumo", energy_balance(generated="gen"))))
    got = {r.fecha: (r.gen, r.ea_consumo) for r in out.collect()}
    # d3 has no logger row, the NULL day never matches, d2 has a NULL term.
    assert got == {d1: (4.25, 14.3), d2: (4.0, None)}


def test_join_on_day_requires_inputs():
    with pytest.raises(ValueError):
        join_on_day([])
    with pytest.raises(ValueError):
        stack_on_day([])


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stacked_day_join_equals_the_join_on_edge_rows(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    a = spark.createDataFrame([(d1, 1.0), (d2, None), (d3, 3.0), (None, 4.0)], "fecha date, x double")
    b = spark.createDataFrame([(d1, 10.0), (d2, 20.0), (None, 40.0)], "fecha date, y double")
    c = spark.createDataFrame([(d2, 200.0), (d1, None), (d3, 300.0)], "fecha date, z double")
    frames = [a, b, c]
    stacked = stack_on_day(frames)
    assert _same_rows(stacked.select("fecha", "x", "y", "z"), join_on_day(frames).select("fecha", "x", "y", "z"))
    assert {r.fecha: (r.x, r.y, r.z) for r in stacked.collect()} == {d1: (1.0, 10.0, None), d2: (None, 20.0, 200.0)}
    assert _same_rows(stack_on_day([a]), a.where("fecha IS NOT NULL"))


def test_stacked_day_join_refuses_a_repeated_day(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    a = spark.createDataFrame([(d1, 1.0), (d1, 2.0), (None, 3.0), (None, 4.0)], "fecha date, x double")
    b = spark.createDataFrame([(d2, 10.0)], "fecha date, y double")
    c = spark.createDataFrame([(d1, 5.0), (d2, 6.0)], "fecha date, z double")
    with pytest.raises(Exception, match="repeats"):
        stack_on_day([a, b, c]).collect()
    # repeated NULL days are fine: they never match
    ok = spark.createDataFrame([(d1, 1.0), (None, 3.0), (None, 4.0)], "fecha date, x double")
    assert [tuple(r) for r in stack_on_day([ok, c]).collect()] == [(d1, 1.0, 5.0)]


def test_stacked_day_join_rejects_shared_columns(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "fecha date, x double")
    with pytest.raises(ValueError):
        stack_on_day([a, a])


def test_stacked_day_join_equals_the_join_on_daily_tables(spark):
    from plantlake.plans.layers import gold_frames, joined_inputs, silver_frames
    from plantlake.operators.rollup import select_renamed

    gold = gold_frames(q.PLANT, silver_frames(q.PLANT, q.bronze(spark, SF_SMALL)))
    frames = [select_renamed(gold[s.table], ("fecha", *s.columns)) for s in q.PLANT.joined_sides]
    assert [s.table for s in q.PLANT.joined_sides] == joined_inputs(q.PLANT)
    cols = ["fecha", "ea_import", "ea_export", "ea_carga", "ea_descarga", "ea_gen", "radiacion", "rad_pred"]
    stacked = stack_on_day(frames).select(*cols)
    assert stacked.count() > 0
    assert _same_rows(stacked, join_on_day(frames).select(*cols))


# ---- properties over the events table ------------------------------------------------------------


@pytest.fixture(scope="module")
def events_pdf():
    return pd.read_parquet(f"{SF_SMALL}/events.parquet")


def test_bucket_bounds_hold_on_events(spark):
    ev = q.events(spark, SF_SMALL)
    from plantlake.functions.timegrid import bucket_start

    b = ev.select("ts", bucket_start("ts").alias("b"))
    bad = b.where("NOT (b <= ts AND ts < b + INTERVAL 15 MINUTES) OR minute(b) % 15 <> 0 OR second(b) <> 0")
    assert bad.count() == 0
    assert b.count() == ev.count()


def test_silver_meter_matches_pandas_brute_force(spark, events_pdf):
    got = q.silver("aarr")(spark, SF_SMALL).toPandas().set_index("time_interval").sort_index()
    e = events_pdf.assign(b=events_pdf.ts.dt.floor("15min"))
    g = e.groupby("b")
    exp_pa = g.value.mean()
    exp_imp = g.event_id.max() - g.event_id.min()
    assert list(got.index) == list(exp_pa.index)
    assert (got.pa - exp_pa.values).abs().max() <= 0.05 + 1e-9
    assert (got.ea_import.values == exp_imp.values.astype(float)).all()
    assert (got.ea_import >= 0).all() and (got.ea_export >= 0).all()


def test_day_total_equals_sum_of_buckets(spark):
    silver = q.silver("aarr")(spark, SF_SMALL)
    gold = q.gold("aarr")(spark, SF_SMALL)
    by_day = (silver.groupBy(F.to_date("time_interval").alias("fecha"))
              .agg(F.round(F.sum("ea_import"), 1).alias("s")))
    diff = gold.join(by_day, "fecha").where(F.abs(F.col("ea_import") - F.col("s")) > 1e-6)
    assert diff.count() == 0
    assert gold.count() == by_day.count()


def test_ordered_rollup_puts_the_null_bucket_first(spark):
    rows = [(D(2024, 1, 1, 10, 1), 98, 1.0, 0.0), (None, 98, 2.0, 0.0), (D(2024, 1, 1, 9, 59), 98, 3.0, 0.0)]
    out = Rollup("x", (mean("pa"),), by=("equipo",)).build(_readings(spark, rows), ordered=True)
    assert [r.time_interval for r in out.collect()] == [None, D(2024, 1, 1, 9, 45), D(2024, 1, 1, 10, 0)]
