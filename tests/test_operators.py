from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions.tariff import customer_segment, energy_cost, tariff_rate
from gridloom.operators import marts, quality
from gridloom.operators.calendar import build_dim_date, build_dim_time
from gridloom.operators.dims import build_dim_meter, merge_dim_customer, upsert_dim_location
from gridloom.operators.fact import build_fact_consumption, meter_profile, upsert_fact
from gridloom.operators.merge import (
    ConstraintError, insert_if_absent, merge_upsert, orphan_rows, require_constraints,
)
from gridloom.operators.quantiles import group_quantiles
from gridloom.operators.scd2 import as_of
from gridloom.operators.surrogate import assign_keys
from gridloom.schemas import DIM_CUSTOMER, DIM_LOCATION, DIM_METER, FACT_CONSUMPTION
from tests.conftest import rows


def test_merge_updates_only_named_columns(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, keep string")
    updates = spark.createDataFrame([(2, "B", "Y", 1), (3, "C", "Z", 1), (3, "D", "W", 2)], "k int, v string, keep string, seq int")
    merged = merge_upsert(target, updates, ["k"], ["v"], order=["seq"])
    assert rows(merged) == [(1, "a", "x"), (2, "B", "y"), (3, "D", "W")]
    assert rows(merge_upsert(merged, updates, ["k"], ["v"], order=["seq"])) == rows(merged)


def test_merge_can_set_null(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    updates = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(merge_upsert(target, updates, ["k"])) == [(1, None)]


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "k int, v string")
    assert rows(insert_if_absent(target, new, ["k"])) == [(1, "a"), (2, "c")]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    with pytest.raises(ConstraintError, match="NULL"):
        require_constraints(df, not_null=["k", "v"])
    with pytest.raises(ConstraintError, match="duplicate"):
        require_constraints(df, unique=["k"])
    assert require_constraints(df, not_null=["k"], unique=["k", "v"]) is df


def test_orphans_ignore_null_references(spark):
    child = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None)], "id string, ref string")
    parent = spark.createDataFrame([("1",)], "id string")
    assert rows(orphan_rows(child, parent, "ref", "id"), "id") == [("b",)]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_surrogates_are_dense(spark, buckets):
    new = spark.range(1000).select(F.concat(F.lit("n"), "id").alias("name"))
    old = spark.createDataFrame([(10,), (3,)], "k int")
    keys = sorted(r.k for r in assign_keys(new, old, "k", ["name"], buckets).collect())
    assert keys == list(range(11, 1011))


def test_calendar(spark):
    days = build_dim_date(spark)
    assert days.count() == 7670
    first = days.filter("full_date = DATE'2027-01-01'").first()
    assert (first.date_key, first.week_of_year, first.day_of_week, first.day_name, first.is_weekend) == (
        20270101, 53, 4, "Friday", False)
    assert build_dim_date(spark, date(2024, 5, 1), date(2024, 5, 1), pad=True).first().month_name == "May      "
    slots = {r.time_key: r for r in build_dim_time(spark).collect()}
    assert len(slots) == 96 and slots[2045].is_peak and not slots[2100].is_peak and not slots[645].is_peak
    assert [slots[k].period_name for k in (545, 600, 1145, 1200, 1645, 1700, 2145, 2200)] == [
        "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night"]
    assert slots[930].time_of_day == "09:30:00" and slots[1645].is_business_hr and not slots[1700].is_business_hr
    with pytest.raises(ValueError):
        build_dim_time(spark, 7)


@pytest.mark.parametrize(
    "tariff, peak, rate, segment",
    [
        ("residential", True, "0.28", "residential"), ("residential", False, "0.12", "residential"),
        ("commercial", True, "0.22", "commercial"), ("commercial", False, "0.10", "commercial"),
        ("industrial", True, "0.10", "industrial"), ("Residential", True, "0.10", "residential"),
        ("light_COMMERCIAL", True, "0.10", "commercial"), (None, True, "0.10", "residential"),
    ],
)
def test_tariff(spark, tariff, peak, rate, segment):
    df = spark.createDataFrame([(tariff, peak, Decimal("2.3456"))], "t string, p boolean, k decimal(12,4)")
    got = df.select(energy_cost(F.col("k"), tariff_rate(F.col("t"), F.col("p"))), customer_segment(F.col("t"))).first()
    assert got[0] == (Decimal("2.3456") * Decimal(rate)).quantize(Decimal("0.01")) and got[1] == segment


# --- type-2 history --------------------------------------------------------

CUSTOMER = "customer_id string, customer_name string, tariff_type string, signup_date date, status string"
T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def customers(spark, *data):
    return spark.createDataFrame(list(data), CUSTOMER)


def test_history(spark):
    start = spark.createDataFrame([], DIM_CUSTOMER.ddl)
    first = customers(
        spark, ("a", "A", "residential", date(2020, 1, 1), "active"), ("b", "B", None, None, "active"),
        ("c", "C", "commercial", None, "active"), ("d", "D", "x", None, None),
    )
    dim1 = merge_dim_customer(start, first, T1)
    second = customers(
        spark, ("a", "A", "commercial", date(2020, 1, 1), "active"),  # tariff changes
        ("b", "B", None, date(2021, 1, 1), "active"),  # signup date alone makes no version
        ("d", "D", "x", None, "active"),  # NULL to a value is a change
        ("e", "E", "residential", None, "active"),  # new; c is missing and stays
    )
    dim2 = merge_dim_customer(dim1, second, T2)
    assert rows(dim2, "customer_id", "tariff_type", "valid_from", "valid_to", "is_current") == sorted(
        [
            ("a", "residential", datetime(2020, 1, 1), T2, False), ("a", "commercial", T2, None, True),
            ("b", None, T1, None, True), ("c", "commercial", T1, None, True),
            ("d", "x", T1, T2, False), ("d", "x", T2, None, True), ("e", "residential", T2, None, True),
        ],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )
    keys = [r.customer_key for r in dim2.collect()]
    assert sorted(keys) == list(range(1, 8))
    again = merge_dim_customer(dim2, second, T3)
    assert rows(again) == rows(dim2)
    overlap = merge_dim_customer(dim1, second, T2, policy="reference").filter("customer_id = 'a' AND is_current")
    assert overlap.first().valid_from == datetime(2020, 1, 1)

    events = spark.createDataFrame(
        [("a", datetime(2024, 1, 31, 23, 59)), ("a", T2), ("a", datetime(2019, 1, 1)), ("z", T2)],
        "customer_id string, at timestamp_ntz",
    )
    assert rows(as_of(events, dim2, "customer_id", "customer_id", "at"), "tariff_type") == [
        ("commercial",), ("residential",)]
    assert as_of(events, dim2, "customer_id", "customer_id", "at", "left").count() == 4
    assert rows(marts.customer_at(dim2, datetime(2024, 1, 15)).filter("customer_id = 'a'"), "tariff_type") == [
        ("residential",)]


def test_location_and_meter_keys_are_kept(spark):
    dim = spark.createDataFrame([(7, "L1", "old", "c", "r", "UK", None, None, "z")], DIM_LOCATION.ddl)
    raw = spark.createDataFrame(
        [("L1", "new", "c", "r", "UK", None, None, "z"), ("L2", "b", "c", "r", "UK", None, None, "z")],
        DIM_LOCATION.ddl.replace("location_key int, ", ""),
    )
    locations = upsert_dim_location(dim, raw)
    assert rows(locations, "location_key", "location_id", "address") == [(7, "L1", "new"), (8, "L2", "b")]
    cust = merge_dim_customer(
        spark.createDataFrame([], DIM_CUSTOMER.ddl), customers(spark, ("a", "A", "t", None, "s")), T1)
    raw_meters = spark.createDataFrame(
        [("M1", "a", "smart", None, "L2", "on"), ("M2", "zz", "smart", None, None, "on")],
        "meter_id string, customer_id string, meter_type string, install_date date, location_id string, status string",
    )
    meters = build_dim_meter(spark.createDataFrame([], DIM_METER.ddl), raw_meters, cust, locations)
    assert rows(meters, "meter_id", "customer_key", "location_key") == [("M1", 1, 8), ("M2", None, None)]


# --- fact ------------------------------------------------------------------

STG = "meter_id string, reading_timestamp timestamp_ntz, consumption_kwh decimal(12,4), reading_date date, reading_hour smallint, _raw_id long, _batch_id string"
WEATHER = "location_id string, observation_time timestamp_ntz, observation_date date, observation_hour smallint, temperature_c decimal(5,1)"


def staged(spark, *data):
    full = [(m, t, Decimal(k), t.date(), t.hour, i, "b") for i, (m, t, k) in enumerate(data, 1)]
    return spark.createDataFrame(full, STG)


def star(spark):
    cust = spark.createDataFrame(
        [(1, "a", "A", "residential", "residential", "s", T1, None, True),
         (2, "b", "B", "commercial", "commercial", "s", T1, T2, False)], DIM_CUSTOMER.ddl)
    loc = spark.createDataFrame([(5, "L1", "a", "c", "r", "UK", None, None, "z")], DIM_LOCATION.ddl)
    met = spark.createDataFrame(
        [(10, "M1", "s", None, "on", 1, 5), (11, "M2", "s", None, "on", 2, 5), (12, "M3", "s", None, "on", 1, None)],
        DIM_METER.ddl)
    return meter_profile(met, cust, loc)


def test_fact_joins(spark):
    stg = staged(
        spark,
        ("M1", datetime(2024, 1, 6, 8, 0), "1.5"),  # Saturday, peak
        ("M1", datetime(2024, 1, 6, 8, 0, 30), "2.5"),  # same slot, later: wins
        ("M1", datetime(2024, 1, 6, 6, 45), "1"),  # off-peak
        ("M1", datetime(2024, 1, 6, 8, 7), "1"),  # off the grid
        ("M1", datetime(2031, 1, 1, 8, 0), "1"),  # outside the calendar
        ("M2", datetime(2024, 1, 6, 8, 0), "1"),  # its customer version is expired
        ("M3", datetime(2024, 1, 6, 8, 0), "1"),  # no location
        ("", datetime(2024, 1, 6, 8, 0), "1"),  # no meter
    )
    weather = spark.createDataFrame(
        [("L1", datetime(2024, 1, 6, 8, 10), date(2024, 1, 6), 8, Decimal("3.0")),
         ("L1", datetime(2024, 1, 6, 8, 50), date(2024, 1, 6), 8, Decimal("4.0"))], WEATHER)
    fact = build_fact_consumption(stg, star(spark), build_dim_date(spark), build_dim_time(spark), weather)
    got = rows(fact, "meter_key", "customer_key", "date_key", "time_key", "consumption_kwh", "cost_usd",
               "peak_demand_kw", "temperature_c", "is_peak_hour", "is_weekend", "_stg_id")
    assert got == [
        (10, 1, 20240106, 645, Decimal("1.0000"), Decimal("0.12"), Decimal("4.00"), None, False, True, 3),
        (10, 1, 20240106, 800, Decimal("2.5000"), Decimal("0.70"), Decimal("10.00"), Decimal("4.0"), True, True, 2),
    ]
    bare = build_fact_consumption(stg, star(spark), build_dim_date(spark), build_dim_time(spark), None)
    assert bare.count() == 2 and bare.filter("temperature_c IS NOT NULL").isEmpty()


def test_fact_merge_keeps_the_stored_customer(spark):
    stored = spark.createDataFrame(
        [(1, 10, 99, 5, 800, Decimal("1"), Decimal("1"), Decimal("4"), None, True, True, 1, T1, 20240106)],
        FACT_CONSUMPTION.ddl)
    stg = staged(spark, ("M1", datetime(2024, 1, 6, 8, 0), "2"))
    fact = build_fact_consumption(stg, star(spark), build_dim_date(spark), build_dim_time(spark), None).withColumns(
        {"_loaded_at": F.lit(T2).cast("timestamp_ntz"), "consumption_id": F.lit(77)})
    got = upsert_fact(stored, fact).first()
    assert (got.consumption_id, got.customer_key, got.cost_usd, got._loaded_at) == (1, 99, Decimal("0.56"), T2)


# --- quality ---------------------------------------------------------------


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-10**11, 10**11)), min_size=1, max_size=60))
def test_quantiles_equal_numpy(spark, data):
    df = spark.createDataFrame([(k, Decimal(v).scaleb(-4)) for k, v in data], "k string, v decimal(12,4)")
    got = {r.k: r for r in group_quantiles(df, ["k"], "v", {"q1": 0.25, "q2": 0.5, "q3": 0.75}).collect()}
    for key in {k for k, _ in data}:
        values = np.array([v / 10**4 for k, v in data if k == key])
        expected = np.quantile(values, [0.25, 0.5, 0.75])
        assert np.allclose([got[key].q1, got[key].q2, got[key].q3], expected, rtol=1e-12, atol=1e-9)


def test_quantiles_with_one_dominant_value(spark):
    df = spark.range(3000).select(
        F.lit("hot").alias("k"),
        F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id")).cast("decimal(12,4)").alias("v"))
    got = group_quantiles(df, ["k"], "v", {"q2": 0.5, "top": 1.0}).first()
    assert (got.q2, got.top) == (1.0, 2997.0)


def test_quantiles_need_a_narrow_decimal(spark):
    with pytest.raises(TypeError):
        group_quantiles(spark.range(3), [], "id", {"m": 0.5})


def test_outliers_find_a_spike(spark):
    df = spark.createDataFrame([("m", Decimal(v)) for v in ["1.0", "1.1", "0.9", "1.2"] * 10 + ["110"]], "m string, v decimal(12,4)")
    assert rows(quality.flag_outliers(df, ["m"], "v"), "v", "iqr_outlier", "z_outlier") == [(Decimal("110.0000"), True, True)]
    assert quality.flag_outliers(df, ["m"], "v", exact=False).count() == 1


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), (" ", 5), (None, None)], "s string, n int")
    result = quality.run_checks(
        df, [quality.not_blank("s"), quality.in_range("n", 0, 3), quality.max_length("s", 1)], "t", date(2024, 1, 1))
    assert rows(result, "check_name", "passed", "failed_count", "total_count") == [
        ("length_s", True, 0, 3), ("not_blank_s", False, 2, 3), ("range_n", False, 1, 3)]


def test_rollup_levels_and_series(spark):
    fact = spark.createDataFrame(
        [(1, 5, 20240101, Decimal("1"), Decimal("1")), (1, 5, 20240102, Decimal("2"), Decimal("1")),
         (1, 6, 20240104, Decimal("4"), Decimal("1"))],
        "meter_key int, location_key int, date_key int, consumption_kwh decimal(12,4), cost_usd decimal(10,2)")
    loc = spark.createDataFrame([(5, "r", "x"), (6, "r", "y")], "location_key int, region string, city string")
    assert rows(marts.regional_rollup(fact, loc), "level", "total_kwh") == [
        (0, Decimal("3.0000")), (0, Decimal("4.0000")), (1, Decimal("7.0000")), (3, Decimal("7.0000"))]
    assert rows(marts.meter_series(fact, 2), "date_key", "previous_kwh", "rolling_kwh") == [
        (20240101, None, Decimal("1.0000")), (20240102, Decimal("1.0000"), Decimal("3.0000")),
        (20240104, Decimal("2.0000"), Decimal("4.0000"))]
