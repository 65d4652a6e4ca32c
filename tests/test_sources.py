"""Sources: JDBC options (no database is started here), session settings, stand-ins, extracts."""

from datetime import date, timedelta

from plantlake.plans.plant import BRONZE_TABLES, plant_specs, string_keys
from plantlake.session import catalog_conf_from_env, lake_catalog
from plantlake.sources.jdbc import JdbcSource, range_predicates, range_starts
from plantlake.sources.standins import STANDINS, string_currents_json


def test_jdbc_options_from_env_keep_user_and_password_apart():
    env = {
        "PLANTLAKE_JDBC_URL": "jdbc:example://db:5432/monitoring",
        "PLANTLAKE_JDBC_USER": "reader",
        "PLANTLAKE_JDBC_PASSWORD": "secret",
        "PLANTLAKE_JDBC_DRIVER": "org.example.Driver",
    }
    src = JdbcSource.from_env(env, fetch_size=500)
    opts = src.connection_options()
    assert opts["user"] == "reader" and opts["password"] == "secret"
    assert opts["driver"] == "org.example.Driver"
    assert opts["fetchsize"] == "500"


def test_jdbc_partition_options():
    src = JdbcSource("jdbc:x", partition_column="fecha", num_partitions=16)
    assert src.partition_options("2024-01-01", "2024-12-31") == {
        "partitionColumn": "fecha",
        "lowerBound": "2024-01-01",
        "upperBound": "2024-12-31",
        "numPartitions": "16",
    }


def test_catalog_conf_from_env():
    env = {
        "PLANTLAKE_CATALOG": "lake",
        "PLANTLAKE_CATALOG_IMPL": "org.example.Catalog",
        "PLANTLAKE_CATALOG_OPTIONS": "uri=http://catalog:1/api; warehouse=s3://w/",
    }
    assert catalog_conf_from_env(env) == {
        "spark.sql.catalog.lake": "org.example.Catalog",
        "spark.sql.catalog.lake.uri": "http://catalog:1/api",
        "spark.sql.catalog.lake.warehouse": "s3://w/",
    }
    assert lake_catalog(env) == "lake"
    assert catalog_conf_from_env({}) == {} and lake_catalog({}) is None


def test_plant_extract_predicates():
    plant = plant_specs()
    where = {x.table: x.where for x in plant.bronze}
    assert where["aarr"] == "instalacion = 11 AND equipo = 42"
    assert where["inversor"] == "instalacion = 11"
    assert where["prediccion_meteo"] == "localidad = 'cieza'"
    assert set(where) == set(BRONZE_TABLES)
    assert "omie" in {x.table for x in plant_specs(with_market_prices=True).bronze}
    assert plant.silver_step("bateria").spec.where == "equipo IN (98, 99)"


def test_standins_cover_every_bronze_table():
    assert set(STANDINS) == set(BRONZE_TABLES)


def test_string_currents_round_trip(spark):
    df = spark.createDataFrame([(6.55,), (19.17,)], "value double").select(string_currents_json().alias("j"))
    from plantlake.functions.jsoncols import JsonUnpack, unpack

    keys = string_keys()
    back = unpack(df.withColumn("id", df.j), JsonUnpack("j", keys), keep=["id"]).collect()
    for row, v in zip(back, (6.55, 19.17)):
        assert [row[k] for k in keys] == [v * i for i in range(1, 21)]


class _FakeReader:
    """Stands in for ``spark.read.format('jdbc')``: records options, loads a local DataFrame."""

    def __init__(self, spark, rows, schema):
        self.spark, self.rows, self.schema, self.opts = spark, rows, schema, {}

    def option(self, key, value):
        self.opts[key] = value
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def load(self):
        if "query" in self.opts:  # the count of each day
            return self.spark.createDataFrame([(date(2024, 1, 1), 5), (date(2024, 1, 2), 5), (None, 1)], "day date, n long")
        return self.spark.createDataFrame(self.rows, self.schema)


def test_jdbc_read_table_partitions_and_filters(spark, monkeypatch):
    from plantlake.sources import jdbc

    made = []

    def fake(spark_, source):
        r = _FakeReader(spark_, [(11, 42, 1.0), (11, 7, 2.0), (12, 42, 3.0)], "instalacion int, equipo int, pa double")
        r.opts.update(source.connection_options())
        made.append(r)
        return r

    monkeypatch.setattr(jdbc, "_reader", fake)
    src = JdbcSource("jdbc:x", user="u", password="p", partition_column="id", num_partitions=4, lower_bound=1, upper_bound=9)
    df = jdbc.read_table(spark, src, "public.aarr", "instalacion = 11 AND equipo = 42")
    assert [tuple(r) for r in df.collect()] == [(11, 42, 1.0)]
    (table,) = made
    assert table.opts["dbtable"] == "public.aarr"
    assert (table.opts["partitionColumn"], table.opts["lowerBound"], table.opts["upperBound"]) == ("id", "1", "9")
    assert table.opts["numPartitions"] == "4" and table.opts["user"] == "u"


def test_jdbc_source_reader_for_bronze_jobs(spark, monkeypatch):
    from plantlake.sources import jdbc

    seen = []

    def fake(spark_, source):
        r = _FakeReader(spark_, [(1,)], "instalacion int")
        seen.append(r)
        return r

    def ranges(spark_, source, table, predicates):
        asked.append((table, predicates))
        return spark_.createDataFrame([(1,), (11,)], "instalacion int")

    asked = []
    monkeypatch.setattr(jdbc, "_reader", fake)
    monkeypatch.setattr(jdbc, "_read_ranges", ranges)
    plant = plant_specs(with_market_prices=True)
    src = JdbcSource("jdbc:x", num_partitions=8)
    read = jdbc.source_reader(spark, src, "public")
    inversor = next(x for x in plant.bronze if x.table == "inversor")
    assert read(inversor).count() == 1
    counts = seen[0]
    assert counts.opts["query"] == (
        "SELECT CAST(fecha AS DATE) AS day, COUNT(*) AS n FROM public.inversor WHERE instalacion = 11 GROUP BY CAST(fecha AS DATE)"
    )
    by_day = asked[:]
    asked.clear()
    jdbc.source_reader(spark, JdbcSource("jdbc:x", num_partitions=0), "public")(inversor)
    assert asked == [("public.inversor", ["fecha IS NOT NULL", "fecha IS NULL"])]  # few rows: one range
    assert by_day == [("public.inversor", ["fecha < DATE '2024-01-02'", "fecha >= DATE '2024-01-02'", "fecha IS NULL"])]
    seen.clear()
    omie = next(x for x in plant.bronze if x.table == "omie")
    assert read(omie).count() == 1
    assert len(seen) == 1 and "partitionColumn" not in seen[0].opts


def test_jdbc_ranges_follow_the_rows_of_each_day():
    days = [(date(2024, 1, 1) + timedelta(k), 100) for k in range(80)]
    wrong_clocks = [(date(1970, 1, 1), 1), (date(2099, 12, 31), 2), (None, 7)]
    starts = range_starts([*wrong_clocks, *reversed(days)], 8)
    assert len(starts) == 8
    sizes = [sum(n for d, n in [*days, *wrong_clocks[:2]] if lo <= d and (hi is None or d < hi)) for lo, hi in zip(starts, [*starts[1:], None])]
    assert sum(sizes) == 8003 and max(sizes) <= 1100
    assert range_starts([], 8) == [] and range_starts([(None, 5)], 8) == []
    assert range_starts(days[:3], 8) == [d for d, _ in days[:3]]  # never less than a day
    assert range_starts([(date(2024, 1, 1), 1), (date(2024, 1, 2), 1_000_000), (date(2024, 1, 3), 1)], 4)[:2] == [date(2024, 1, 1), date(2024, 1, 2)]


def test_jdbc_range_predicates_hold_for_every_row_once(spark):
    rows = [("1970-01-01 00:00:00",), ("2024-01-01 23:59:59",), ("2024-01-02 00:00:00",), ("2024-01-05 12:00:00",), ("2099-12-31 00:00:00",), (None,)]
    df = spark.createDataFrame(rows, "t string").selectExpr("cast(t as timestamp_ntz) as fecha")
    for starts in ([], [date(2024, 1, 1)], [date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 5)]):
        held = [df.where(p).count() for p in range_predicates("fecha", starts)]
        assert sum(held) == len(rows) and held[-1] == 1


def test_standins_provide_every_column_the_specs_read(spark):
    from conftest import SF_SMALL
    from plantlake.plans import standin_queries as q

    bronze = q.bronze(spark, SF_SMALL)
    for step in (*q.PLANT.silver, *q.PLANT.exploratory):
        spec = step.spec
        have = set(bronze[step.source].columns)
        produced = set(spec.json.out_names()) if spec.json else set()
        needed = {c for c in spec.input_columns() if c not in produced}
        if spec.json:
            needed.add(spec.json.column)
        assert needed <= have, (step.table, sorted(needed - have))


def test_build_session_applies_defaults_and_env_catalog(tmp_path):
    import json
    import os
    import subprocess
    import sys

    code = (
        "import json, sys; sys.path.insert(0, %r)\n"
        "from plantlake.session import build_session\n"
        "s = build_session('t', master='local[1]', conf={'spark.ui.enabled': 'false'})\n"
        "keys = ['spark.sql.autoBroadcastJoinThreshold', 'spark.sql.adaptive.enabled', "
        "'spark.sql.session.timeZone', 'spark.sql.catalog.lake', 'spark.sql.catalog.lake.uri']\n"
        "print(json.dumps({k: s.conf.get(k, None) for k in keys}))\n"
        "s.stop()\n"
    ) % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PLANTLAKE_CATALOG="lake", PLANTLAKE_CATALOG_IMPL="org.example.Catalog",
               PLANTLAKE_CATALOG_OPTIONS="uri=http://catalog:1/api", PLANTLAKE_TIMEZONE="Europe/Madrid")
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True,
                         timeout=300)
    got = json.loads(out.stdout.strip().splitlines()[-1])
    assert got == {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "Europe/Madrid",
        "spark.sql.catalog.lake": "org.example.Catalog",
        "spark.sql.catalog.lake.uri": "http://catalog:1/api",
    }
