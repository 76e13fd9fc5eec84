"""The physical plans that the operators are meant to get."""

from __future__ import annotations

import pytest

from gridloom.operators.fact import upsert_fact
from gridloom.plans import catalog
from gridloom.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_cut_before_the_shuffle(spark):
    text = plan(catalog.stage_readings(spark, SF))
    partial = text.index("Partial")
    assert "WindowGroupLimit" in text and text.count("Exchange hashpartitioning") == 1
    assert text.index("Final") < text.index("Exchange hashpartitioning") < partial


def test_fact_has_one_shuffle_per_input_and_one_for_the_grain(spark):
    text = plan(catalog.fact(spark, SF))
    assert "SortMergeJoin" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("Exchange hashpartitioning") <= 4


def test_merge_of_a_built_fact_does_not_shuffle_it_again(spark):
    """Both sides of the merge come out of an aggregate on the fact's grain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = catalog.fact(spark, SF)
        stored = rows.filter("_stg_id % 4 = 0")
        text = plan(upsert_fact(stored, rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(date_key" not in text and "hashpartitioning(time_key" not in text
    below = text[text.index("FullOuter"):].splitlines()[1:]
    nodes = [line.split("- ")[-1].split("(")[0].split(" ")[0] for line in below]
    assert "Exchange" not in nodes[: nodes.index("HashAggregate")]


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in
    {"csv_ingest", "weather_ingest", "json_ingest", "directory_ingest", "reference_ingest", "reference_meters",
     "reference_locations", "run_day", "backfill", "stream_ingest"}])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert node not in text


def test_only_needed_columns_are_read(spark):
    text = plan(catalog.dim_date_query(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text
    weather = plan(fx.raw_weather(spark, SF))
    assert "PushedFilters: []" in weather  # weather comes from all events
