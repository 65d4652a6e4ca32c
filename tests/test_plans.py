"""Plan shape: pushed filters, pruned columns, one JSON parse, no Python in the plans."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from conftest import SF_CHECK

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_text(fn(spark, SF_CHECK)) for k, fn in entry.queries().items() if k not in entry.text_queries()}


def test_no_python_in_any_plan(plans):
    for key, text in plans.items():
        assert not any(node in text for node in PYTHON_NODES), key


def test_flagship_scans_are_pruned(plans):
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plans["daily_balance"])
    assert len(schemas) == 5
    # No stand-in stream reads every column of events, and only the radiation stream reads the JSON.
    assert all(s.count(":") < 6 for s in schemas)
    assert sum("props" in s for s in schemas) == 1


def test_device_filter_reaches_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type, \[click,view\]\)", plans["silver_battery"])


def test_extract_predicates_reach_the_scan(plans):
    assert "EqualTo(l_linenumber,1)" in plans["bronze_extract_eq"]
    text = plans["bronze_extract_and"]
    assert "EqualTo(l_linenumber,1)" in text and "EqualTo(l_suppkey,1)" in text
    assert "EqualTo(o_orderstatus,F)" in plans["bronze_extract_text"]


def test_json_parsed_once_and_unused_keys_pruned(plans):
    strings = plans["silver_strings"]
    assert len(re.findall(r"Arguments: json_tuple\(", strings)) == 1
    radiation = plans["silver_radiation"]
    gen = re.search(r"Arguments: json_tuple\(([^)]*)\)", radiation).group(1)
    assert "k1" not in gen and "k2" not in gen


def test_aggregates_are_partial_before_the_shuffle(plans):
    text = plans["silver_meter"]
    assert "partial_avg" in text and "partial_max" in text and "partial_min" in text


def test_flagship_day_join_adds_no_exchange_and_no_row_filter(plans):
    text = plans["daily_balance"]
    # The five daily tables are stacked and aggregated by day: no join operator at all,
    assert "Join" not in text and "Union" in text
    # 5 streams x (bucket exchange + day exchange), which the hours of the radiation chain use too;
    # the union is already partitioned by day, so combining the days adds none,
    assert len(re.findall(r"\(\d+\) Exchange", text)) == 10
    # and no join-derived isnotnull(day(bucket(ts))) filter is re-evaluated on the input rows.
    for filters in re.findall(r"DataFilters: \[([^\]]*)\]", text):
        assert "make_dt_interval" not in filters


def test_no_global_sort_in_registered_queries(plans):
    # The stored tables are sorted by the layer jobs.
    for key, text in plans.items():
        assert "rangepartitioning" not in text.lower(), key


def test_scans_read_only_needed_columns(plans):
    # events has 6 columns and lineitem 11; no rollup needs more than 5 of them.
    for key, text in plans.items():
        if key.startswith("bronze_extract"):
            continue  # SELECT * by definition
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
            assert schema.count(":") <= 5, (key, schema)
