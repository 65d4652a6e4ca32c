"""Sinks and table lifecycle on the session catalog; the materialised pipeline equals the fused one."""

import re

import pytest

from conftest import SF_SMALL
from test_plans import plan_text
from plantlake.plans import jobs
from plantlake.plans import standin_queries as q
from plantlake.sources.tables import extract
from plantlake.sources.catalog import (
    drop_layer,
    ensure_layer,
    is_v2_catalog,
    layer_exists,
    layer_tables,
    qualified,
    register_view,
    replace_table,
)


def test_replace_table_replaces_data_and_schema(spark):
    ensure_layer(spark, None, "t_replace")
    replace_table(spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string"), None, "t_replace", "t")
    replace_table(spark.createDataFrame([(3.5,)], "z double"), None, "t_replace", "t")
    back = spark.table(qualified(None, "t_replace", "t"))
    assert back.columns == ["z"]
    assert [r.z for r in back.collect()] == [3.5]
    drop_layer(spark, None, "t_replace")


def test_drop_layer_empties_then_drops(spark):
    ensure_layer(spark, "spark_catalog", "t_drop")
    for name in ("a", "b", "c"):
        replace_table(spark.range(3), "spark_catalog", "t_drop", name)
    register_view(spark.range(1), "t_drop_view")  # temp views are not part of a layer
    assert layer_tables(spark, "spark_catalog", "t_drop") == ["a", "b", "c"]
    assert drop_layer(spark, "spark_catalog", "t_drop") == ["a", "b", "c"]
    assert not layer_exists(spark, "spark_catalog", "t_drop")
    # absent layer: nothing to do, no error
    assert drop_layer(spark, "spark_catalog", "t_drop") == []


def test_session_catalog_is_not_v2(spark):
    assert not is_v2_catalog(spark, None)
    assert not is_v2_catalog(spark, "spark_catalog")
    assert not is_v2_catalog(spark, "not_configured")


def test_qualified_quotes_names():
    assert qualified("cat", "layer", "t") == "`cat`.`layer`.`t`"
    assert qualified(None, "layer", "t") == "`layer`.`t`"


@pytest.fixture(scope="module")
def materialised(spark):
    layers = ("t_bronze", "t_silver", "t_gold")
    bronze = q.bronze(spark, SF_SMALL)
    name = jobs.run_all(spark, q.PLANT, lambda x: extract(bronze[x.source], x.where), None, layers)
    yield name, layers
    jobs.drop_layers(spark, None, *layers)


def test_materialised_pipeline_equals_fused(spark, materialised):
    name, layers = materialised
    assert set(layer_tables(spark, None, "t_silver")) == {s.table for s in q.PLANT.silver}
    assert set(layer_tables(spark, None, "t_gold")) == {s.table for s in q.PLANT.gold} | {"conjunto"}
    stored = spark.table(name)
    fused = q.daily_balance(spark, SF_SMALL)
    assert stored.columns == fused.columns
    assert stored.exceptAll(fused).count() == 0 and fused.exceptAll(stored).count() == 0
    assert stored.count() > 0


def test_materialised_silver_is_stored_in_key_order(spark, materialised):
    silver = spark.table(qualified(None, "t_silver", "inversor"))
    rows = [(r.time_interval, r.equipo) for r in silver.collect()]
    assert rows == sorted(rows)


def test_drop_silver_and_gold_together(spark):
    layers = ("t2_silver", "t2_gold")
    for layer in layers:
        ensure_layer(spark, None, layer)
        replace_table(spark.range(2), None, layer, "x")
    dropped = jobs.drop_layers(spark, None, *layers)
    assert dropped == {"t2_silver": ["x"], "t2_gold": ["x"]}
    assert not any(layer_exists(spark, None, layer) for layer in layers)


def test_preview_is_a_limit(spark):
    assert jobs.preview(spark.range(100), 20).count() == 20


def test_cli_drop_job(spark, capsys):
    from plantlake.__main__ import main

    ensure_layer(spark, None, "t_cli")
    replace_table(spark.range(1), None, "t_cli", "one")
    assert main(["drop", "t_cli"], spark=spark) == 0
    assert "t_cli: ['one']" in capsys.readouterr().out
    assert not layer_exists(spark, None, "t_cli")


def test_explore_previews(spark, materialised):
    previews = jobs.explore(spark, q.PLANT, None, "t_bronze", n=5)
    assert set(previews) == {"pcs", "rack"}
    pcs = previews["pcs"]
    assert pcs.columns == ["time_interval", "equipo", "pa", "ea_carga", "ea_descarga"]
    rows = [(r.time_interval, r.equipo) for r in pcs.collect()]
    assert len(rows) == 5 and rows == sorted(rows)


def test_failed_refresh_keeps_the_previous_table(spark):
    from pyspark.sql import functions as F

    ensure_layer(spark, None, "t_fail")
    replace_table(spark.createDataFrame([(1,)], "x int"), None, "t_fail", "t")
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).alias("y"))
    with pytest.raises(Exception):
        replace_table(bad, None, "t_fail", "t")
    assert [r.x for r in spark.table(qualified(None, "t_fail", "t")).collect()] == [1]
    drop_layer(spark, None, "t_fail")
    assert not layer_exists(spark, None, "t_fail")


def test_bronze_rows_are_sorted_by_time_within_each_task(spark):
    from plantlake.plans.plant import Extract

    bronze = q.bronze(spark, SF_SMALL)
    read = lambda x: extract(bronze[x.source], x.where)
    plan = plan_text(jobs.bronze_frame(Extract("aarr", "aarr", None), read))
    assert re.search(r"Arguments: \[fecha#\d+ ASC NULLS FIRST\], false", plan)
    assert "Exchange" not in plan
    unsplit = plan_text(jobs.bronze_frame(Extract("omie", "aarr", None, split_by=None), read))
    assert "Sort" not in unsplit


def test_cli_layer_jobs_in_one_session(spark, capsys):
    from plantlake.__main__ import main
    from plantlake.plans.plant import BRONZE, GOLD, SILVER

    bronze = q.bronze(spark, SF_SMALL)
    jobs.run_bronze(spark, q.PLANT, lambda x: extract(bronze[x.source], x.where), None, BRONZE)
    args = ["--battery-devices", "click", "view", "--parallel", "3"]
    for job in ("silver", "gold", "joined", "explore"):
        assert main([job, *args], spark=spark) == 0
    out = capsys.readouterr().out
    assert "`gold`.`conjunto`" in out and "rack" in out
    assert set(layer_tables(spark, None, SILVER)) == {s.table for s in q.PLANT.silver}
    joined = spark.table(qualified(None, GOLD, "conjunto"))
    assert joined.count() == q.daily_balance(spark, SF_SMALL).count()
    assert main(["drop", BRONZE, SILVER, GOLD], spark=spark) == 0
    assert not any(layer_exists(spark, None, x) for x in (BRONZE, SILVER, GOLD))


def test_parallel_refresh_writes_the_same_tables(spark, materialised):
    jobs.run_silver(spark, q.PLANT, None, "t_bronze", "t_par_silver", parallel=4)
    for step in q.PLANT.silver:
        a = spark.table(qualified(None, "t_silver", step.table))
        b = spark.table(qualified(None, "t_par_silver", step.table))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, step.table
    drop_layer(spark, None, "t_par_silver")


def test_v2_catalog_refresh_uses_create_or_replace(spark, monkeypatch):
    from plantlake.sources import catalog as cat

    calls = []

    class Writer:
        def __init__(self, name):
            self.name = name

        def createOrReplace(self):
            calls.append(("createOrReplace", self.name))

    class Frame:
        sparkSession = spark

        def writeTo(self, name):
            return Writer(name)

    monkeypatch.setattr(spark.conf, "get", lambda key, default=None: "org.example.Catalog"
                        if key == "spark.sql.catalog.lake" else default)
    assert cat.is_v2_catalog(spark, "lake")
    assert cat.replace_table(Frame(), "lake", "silver", "aarr") == "`lake`.`silver`.`aarr`"
    assert calls == [("createOrReplace", "`lake`.`silver`.`aarr`")]
