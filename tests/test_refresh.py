"""Publishing, shared scans, shared exchanges and refreshes of changed days."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantlake.functions import JsonUnpack, avg, mean, total
from plantlake.operators.fusion import FusedRollup, fits_together, fuse
from plantlake.operators.rollup import Chain, Rollup
from plantlake.plans import jobs, standin_queries as q
from plantlake.plans.plant import Plant, plant_specs
from plantlake.plans.refresh import DAY, refresh_changed_days
from plantlake.sources import catalog
from plantlake.sources.catalog import drop_layer, ensure_layer, layer_tables, layer_views, replace_table, table_versions


def rows_of(df):
    return sorted(map(repr, df.collect()))


# --- publishing through a view ----------------------------------------------------------------


def test_a_failure_between_write_and_flip_leaves_the_old_rows(spark, monkeypatch):
    ensure_layer(spark, None, "p_view")
    replace_table(spark.range(3), None, "p_view", "T1", publish="view")
    assert layer_views(spark, None, "p_view") == ["t1"] or layer_views(spark, None, "p_view") == ["T1"]

    def fail(*_):
        raise RuntimeError("before the flip")

    with monkeypatch.context() as m:
        m.setattr(catalog, "_point_view", fail)
        with pytest.raises(RuntimeError):
            replace_table(spark.range(5), None, "p_view", "T1", publish="view")
    assert spark.table("p_view.T1").count() == 3
    begun = spark.table("p_view.T1")  # a reader that has begun
    replace_table(spark.createDataFrame([("a",)], "x string"), None, "p_view", "T1", publish="view")
    assert rows_of(spark.table("p_view.T1")) == ["Row(x='a')"]
    assert begun.count() == 3  # the version that was shown stays, the unfinished one is gone
    assert len(table_versions(spark, None, "p_view", "T1")) == 2
    replace_table(spark.range(7), None, "p_view", "T1", publish="view")
    assert len(table_versions(spark, None, "p_view", "T1")) == 2 and spark.table("p_view.T1").count() == 7
    assert [t.lower() for t in drop_layer(spark, None, "p_view")] == ["t1"]
    assert not catalog.layer_exists(spark, None, "p_view")


def test_publishing_changes_its_way(spark):
    ensure_layer(spark, None, "p_both")
    replace_table(spark.range(2), None, "p_both", "t")
    replace_table(spark.range(4), None, "p_both", "t", publish="view")  # the plain table becomes the version before
    assert spark.table("p_both.t").count() == 4 and len(table_versions(spark, None, "p_both", "t")) == 2
    replace_table(spark.range(6), None, "p_both", "t")
    assert layer_tables(spark, None, "p_both") == ["t"] and layer_views(spark, None, "p_both") == []
    assert spark.table("p_both.t").count() == 6
    with pytest.raises(ValueError, match="unknown publish"):
        replace_table(spark.range(1), None, "p_both", "t", publish="rename")
    drop_layer(spark, None, "p_both")


# --- several rollups in one scan -------------------------------------------------------------


def test_silver_of_one_bronze_table_shares_a_scan_and_equals_the_separate_tables(spark):
    from conftest import SF_SMALL

    plant = Plant((), tuple(s for s in q.PLANT.silver if s.source in ("inversor", "aarr")), (), ())
    assert [[s.table for s in g] for g in fuse(q.PLANT.silver)][1] == ["inversor", "strings"]
    assert sum(len(g) for g in fuse(q.PLANT.silver)) == len(q.PLANT.silver) and len(fuse(q.PLANT.silver)) == len(q.PLANT.silver) - 1
    bronze = q.bronze(spark, SF_SMALL)
    ensure_layer(spark, None, "f_bronze")
    for t in ("inversor", "aarr"):
        replace_table(bronze[t], None, "f_bronze", t)
    done = jobs.run_silver(spark, plant, None, "f_bronze", "f_silver", publish="view")
    assert done == [catalog.qualified("f_silver", t) for t in ("aarr", "inversor", "strings")]
    for s in plant.silver:
        own = s.spec.build(spark.table(f"f_bronze.{s.source}"), ordered=True)
        assert spark.table(f"f_silver.{s.table}").columns == own.columns
        assert rows_of(spark.table(f"f_silver.{s.table}")) == rows_of(own)
    assert not [t for t in layer_tables(spark, None, "f_silver") if catalog.STAGING_MARK in t]
    wide = FusedRollup(tuple((s.table, s.spec) for s in fuse(plant.silver)[1])).build(spark.table("f_bronze.inversor"))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(re.findall(r"Exchange hash", plan)) == 1
    jobs.drop_layers(spark, None, "f_bronze", "f_silver")


def test_what_does_not_fit_together():
    a = Rollup("a", (mean("x"),), by=("d",))
    assert fits_together([a, Rollup("b", (total("y"),), by=("d",))])
    assert not fits_together([a, Rollup("b", (mean("x"),))])
    assert not fits_together([a, Rollup("b", (mean("x"),), by=("d",), where="x > 1")])
    assert not fits_together([a, Rollup("b", (mean("x"),), by=("d",), grain="1 hour")])
    assert not fits_together([a, Rollup("b", (mean("x"),), by=("d",), json=JsonUnpack("j", ("x",)))])  # another x
    with pytest.raises(ValueError, match="do not fit"):
        FusedRollup((("a", a), ("b", Rollup("b", (mean("x"),)))))


# --- one exchange for nested rollups -----------------------------------------------------------


def nested(grain="1 day", by=()):
    hourly = Rollup("h", (avg("radiacion"),), time="time_interval", grain="1 hour", key="hora")
    return Chain("emi", (hourly, Rollup("d", (total("radiacion"),), time="hora", grain=grain, key="fecha", by=by)))


def test_a_chain_to_days_has_one_exchange_and_the_same_rows(spark):
    pick = random.Random(4)
    times = [datetime(2024, 3, 30) + timedelta(minutes=15 * pick.randint(0, 400)) if pick.random() > 0.03 else None for _ in range(900)]
    df = spark.createDataFrame([(t, pick.choice([None, pick.random() * 900])) for t in times], "time_interval timestamp_ntz, radiacion double")
    chain = nested()
    assert chain.one_day() and not nested(grain="1 hour").one_day()
    got = chain.build(df)
    step_by_step = chain.steps[1].build(chain.steps[0].build(df))
    assert got.columns == step_by_step.columns and rows_of(got) == rows_of(step_by_step)
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (chain.build(df), chain.steps[1].build(chain.steps[0].build(df)))]
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 2]
    assert rows_of(chain.build(df, ordered=True)) == rows_of(got)


# --- refresh of changed days -------------------------------------------------------------------


def readings(days, seed=1):
    pick = random.Random(seed)
    return [
        (datetime(2024, 5, 1) + timedelta(days=d, minutes=m), f"e{m % 3}", pick.random() * 50, '{"a": %d, "a2": 1}' % m, m)
        for d in range(days)
        for m in range(0, 1440, 37)
    ]


SCHEMA = "fecha timestamp_ntz, equipo string, pa double, j string, unused int"
SPECS = [
    Rollup("r", (mean("pa"),), by=("equipo",)),
    Rollup("r", (mean("a"), mean("pa")), grain="1 hour", json=JsonUnpack("j", ("a",)), where="equipo <> 'e2'"),
    Chain("c", (Rollup("h", (avg("pa"),), grain="1 hour", key="hora"), Rollup("d", (total("pa"),), time="hora", grain="1 day", key="fecha"))),
]


@pytest.mark.parametrize("spec", SPECS, ids=["devices", "json", "chain"])
def test_changed_days_equal_a_full_refresh(spark, spec):
    ensure_layer(spark, None, "r_days")

    def refresh(rows):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        done = refresh_changed_days(df, spec, None, "r_days", "t")
        assert rows_of(spark.table("r_days.t").drop(DAY)) == rows_of(spec.build(df))
        return [str(d) for d in done.rebuilt], [str(d) for d in done.removed], done.unchanged

    rows = readings(6)
    assert refresh(rows) == ([f"2024-05-0{d}" for d in range(1, 7)], [], 0)
    assert refresh(rows) == ([], [], 6)
    assert refresh([(t, e, x, j, u + 1) for t, e, x, j, u in rows]) == ([], [], 6)  # nothing that the rollup reads
    # an insert, an update, a delete, a new day, a day that goes, rows without time
    rows = [r for r in rows if r[0].day != 5 and not (r[0].day == 3 and r[4] > 900)]
    rows = [(t, e, x + (t.day == 2), j, u) for t, e, x, j, u in rows]
    rows += [(datetime(2024, 5, 4, 23, 59, 59, 999999), "e1", 1.0, "{}", 0), (datetime(2024, 7, 1), "e0", 2.0, None, 0), (None, "e0", 3.0, '{"a": 5}', 0)]
    assert refresh(rows) == (["2024-05-02", "2024-05-03", "2024-05-04", "2024-07-01", "None"], ["2024-05-05"], 2)
    # a day whose rows the filter drops entirely, and rows without time go again
    rows = [(t, "e2" if t.day == 6 else e, x, j, u) for t, e, x, j, u in rows if t is not None]
    assert refresh(rows)[1] == ["None"]
    assert refresh([]) == ([], ["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-04", "2024-05-06", "2024-07-01"], 0)
    drop_layer(spark, None, "r_days")
