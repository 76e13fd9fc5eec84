"""Kept totals and states, brought up to date by the days that changed."""

from __future__ import annotations

import shutil
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import quality
from gridloom.operators.quantiles import group_quantiles, merge_states, state_quantiles, value_states
from gridloom.operators.skew import heavy_keys, salted_join
from gridloom.plans.ingest import ingest_files
from gridloom.plans.ledger import loaded_between
from gridloom.plans.standing import day_sums, refresh_totals, standing_daily_summary, stored_days
from gridloom.schemas import FACT_CONSUMPTION, LOAD_LEDGER, MART_TOTALS, RAW_READINGS, STG_READINGS
from gridloom.sources.landing import METER_FILES
from tests.conftest import rows

DAYS = [date(2024, 1, d) for d in range(1, 8)]


def keys(days):
    return [int(d.strftime("%Y%m%d")) for d in days]


def fact(spark, days, price, seed=1, n=40):
    rng = np.random.default_rng(seed)
    made = [
        (k, int(k % 5), int(k % 7), int(k % 3), 0, Decimal(int(rng.integers(0, 900))) / 10, Decimal(price), None, None, bool(k % 2), False, k, None, key)
        for key in keys(days) for k in range(n)
    ]
    return spark.createDataFrame(made, FACT_CONSUMPTION.ddl)


def load(wh, rows_, days):
    wh.overwrite_partitions(FACT_CONSUMPTION, rows_)
    refresh_totals(wh, days)


def rebuilt(wh):
    whole = day_sums(wh.read(FACT_CONSUMPTION)).groupBy("customer_key", "location_key").agg(
        F.sum("readings"), F.sum("consumption_kwh").cast("decimal(38,4)"), F.sum("cost_usd").cast("decimal(38,2)"))
    return rows(whole)


def test_totals_equal_a_rebuild_after_overlapping_loads(spark, wh):
    for price, days in ((1, DAYS[:4]), (2, DAYS[2:6]), (3, DAYS[1:3]), (3, DAYS[1:3])):
        load(wh, fact(spark, days, price, seed=price), days)
        assert rows(wh.read(MART_TOTALS)) == rebuilt(wh)
    daily = wh.read(FACT_CONSUMPTION).groupBy("date_key", "customer_key").agg(F.count(F.lit(1)).alias("n"))
    assert rows(standing_daily_summary(wh), "date_key", "customer_key", "readings") == rows(daily)
    assert rows(stored_days(wh, keys(DAYS[:1])).select("date_key").distinct()) == [(20240101,)]


def test_a_day_that_lost_its_rows(spark, wh):
    load(wh, fact(spark, DAYS[:2], 1), DAYS[:2])
    shutil.rmtree(Path(wh.path(FACT_CONSUMPTION)) / "date_key=20240101")
    refresh_totals(wh, DAYS[:1])
    assert rows(wh.read(MART_TOTALS)) == rebuilt(wh)
    assert {r.date_key for r in standing_daily_summary(wh).collect()} == {20240102}
    load(wh, fact(spark, DAYS[:1], 5), DAYS[:1])
    assert rows(wh.read(MART_TOTALS)) == rebuilt(wh)


def test_untouched_days_are_not_read(spark, wh):
    load(wh, fact(spark, DAYS, 1), DAYS)
    want = rows(wh.read(MART_TOTALS), "customer_key", "location_key", "readings")
    for key in keys(DAYS[1:]):
        for part in (Path(wh.path(FACT_CONSUMPTION)) / f"date_key={key}").glob("*.parquet"):
            part.write_bytes(b"not parquet")
    load(wh, fact(spark, DAYS[:1], 2), DAYS[:1])
    assert rows(wh.read(MART_TOTALS), "customer_key", "location_key", "readings") == want


def test_a_refresh_that_failed_half_way_counts_once(spark, wh):
    load(wh, fact(spark, DAYS[:3], 1), DAYS[:3])
    before = rows(wh.read(MART_TOTALS))
    # The sums of the days are written, the totals are not.
    wh.overwrite_partitions(FACT_CONSUMPTION, fact(spark, DAYS[:1], 9))
    shutil.copytree(f"{wh.path(MART_TOTALS)}_days/v=00000001", f"{wh.path(MART_TOTALS)}_days/v=00000002")
    assert rows(wh.read(MART_TOTALS)) == before and stored_days(wh).agg(F.sum("readings")).first()[0] == 120
    refresh_totals(wh, DAYS[:1])
    assert rows(wh.read(MART_TOTALS)) == rebuilt(wh)


# --- quantiles --------------------------------------------------------------------


@pytest.mark.parametrize(("kind", "scale"), [("decimal(12,4)", 4), ("decimal(5,0)", 0), ("decimal(18,6)", 6), ("decimal(38,10)", 10), ("decimal(38,0)", 0), ("decimal(38,38)", 38)])
def test_exact_quantiles_of_any_precision(spark, kind, scale):
    rng = np.random.default_rng(7)
    precision = int(kind[8:].split(",")[0])
    drawn = []
    for key, n in (("a", 1), ("b", 2), ("c", 400), (None, 333)):
        digits = int(rng.integers(1, precision + 1))
        for _ in range(n):
            text = "".join(str(x) for x in rng.integers(0, 10, digits if rng.random() < 0.5 else precision))
            drawn.append((key, Decimal(f"{'-' if rng.random() < 0.4 else ''}{text}E-{scale}") if rng.random() < 0.95 else None))
    frame = spark.createDataFrame([(k, None if v is None else str(v.__format__("f"))) for k, v in drawn], "k string, v string").selectExpr("k", f"CAST(v AS {kind}) AS v")
    got = {r.k: (r.low, r.mid, r.high) for r in group_quantiles(frame, ["k"], "v", {"low": 0.1, "mid": 0.5, "high": 0.999}).collect()}
    for key in ("a", "b", "c", None):
        values = sorted(v for k, v in drawn if k == key and v is not None)
        if not values:
            assert key not in got
            continue
        for p, have in zip((0.1, 0.5, 0.999), got[key]):
            at = (len(values) - 1) * p
            low, high = values[int(at)], values[min(int(at) + (at > int(at)), len(values) - 1)]
            want = float(low) + (float(high) - float(low)) * (at - int(at))
            assert have == pytest.approx(want, rel=1e-9, abs=1e-30)


def test_exact_quantiles_want_decimals(spark):
    with pytest.raises(TypeError):
        group_quantiles(spark.range(3), [], "id", {"q": 0.5})


def test_sketches_of_days_merge_within_their_error(spark):
    n = 60_000
    frame = spark.range(n).selectExpr("id % 30 AS day", "'m' AS meter", "CAST(pow(id * 7919 % 60000, 1.5) AS DECIMAL(38,6)) AS v")
    days = value_states(frame, ["meter", "day"], "v")
    assert days.count() == 30
    merged = state_quantiles(merge_states(days, ["meter"]), {"q1": 0.25, "q3": 0.75}).first()
    assert merged.n == n
    for p, value in ((0.25, merged.q1), (0.75, merged.q3)):
        rank = frame.filter(F.col("v") <= value).count() / n
        assert abs(rank - p) < 0.01
    half = quality.period_bounds(days.filter("day < 15"), ["meter"]).first()
    exact = frame.filter("day < 15").agg(F.avg("v").cast("double"), F.stddev_samp("v")).first()
    assert half.n == n // 2 and half.mean == pytest.approx(exact[0]) and half.deviation == pytest.approx(exact[1])


def test_states_of_odd_groups(spark):
    frame = spark.createDataFrame([("a", 5.0), ("b", 7.25), ("b", 7.25), ("c", None), (None, 1.0), (None, 3.0)], "k string, v double")
    got = {r.k: r for r in quality.period_bounds(value_states(frame, ["k"], "v"), ["k"]).collect()}
    assert set(got) == {"a", "b", None}
    assert got["a"].deviation is None and got["b"].deviation == 0 and got["b"].q1 == got["b"].q3 == 7.25
    assert got[None].mean == 2 and got[None].q1 == 1 and got[None].q3 == 3


# --- layout, skew, pruning --------------------------------------------------------------


def scanned(spark, make) -> int:
    """Rows that the first scan gave after files and row groups were passed over."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = make()
        df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_meter_reads_few_row_groups(spark, wh):
    n = 400
    readings = spark.range(n * 96).selectExpr(
        "id AS meter_reading_id", f"concat('M', id % {n}) AS meter_id",
        f"timestampadd(MINUTE, CAST(id DIV {n} AS INT) * 15, TIMESTAMP_NTZ'2024-01-15') AS reading_timestamp",
        "CAST(id % 77 AS DECIMAL(12,4)) AS consumption_kwh", f"CAST(id DIV {n} DIV 4 AS SMALLINT) AS reading_hour",
        "id AS _raw_id", "CAST(NULL AS TIMESTAMP_NTZ) AS _loaded_at", "'b' AS _batch_id", "DATE'2024-01-15' AS reading_date")
    spark.conf.set("parquet.block.size", str(16 << 10))
    try:
        wh.upsert(STG_READINGS, readings, [date(2024, 1, 15)], ["consumption_kwh"])
    finally:
        spark.conf.unset("parquet.block.size")
    stored = wh.read(STG_READINGS)
    one = stored.filter("meter_id = 'M123'")
    assert one.count() == 96 and stored.count() == n * 96
    assert scanned(spark, lambda: stored.filter("meter_id = 'M123'").select("consumption_kwh")) < n * 96 / 10


def test_hot_keys_are_dealt_to_several_tasks(spark):
    left = spark.range(40_000).selectExpr("if(id % 2 = 0, 'hot', concat('k', id % 997)) AS k", "id")
    right = spark.range(997).selectExpr("concat('k', id) AS k", "id AS w").union(spark.sql("SELECT 'hot', 5L"))
    hot = heavy_keys(left, ["k"], 0.05)
    assert hot == [spark.sql("SELECT xxhash64('hot')").first()[0]]
    for name, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.enabled", "false"), ("shuffle.partitions", "32")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        joined = salted_join(left, right, ["k"], hot, salts=32)
        plain = left.join(right, "k", "left")
        assert rows(joined.groupBy("k").agg(F.count(F.lit(1)), F.sum("w"))) == rows(plain.groupBy("k").agg(F.count(F.lit(1)), F.sum("w")))
        sizes = [r["count"] for r in joined.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()]
        assert max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], hot, "right")
    assert salted_join(left, right, ["k"], [], "inner").count() == plain.filter("w IS NOT NULL").count()


def test_rows_of_a_load_are_found_through_the_ledger(spark, wh, landing):
    for day in range(1, 7):
        landing(f"meter_readings/readings_2024-01-0{day}.csv", "meter_id,reading_timestamp,consumption_kwh\nM1,2024-01-15,1\n")
        ingest_files(wh, METER_FILES, landing.readings, datetime(2024, 2, day))
    def find():
        return loaded_between(wh.read(RAW_READINGS), wh.read(LOAD_LEDGER), METER_FILES.source_table, datetime(2024, 2, 3), datetime(2024, 2, 5))

    found = find()
    assert rows(found, "_source_file") == [("readings_2024-01-03.csv",), ("readings_2024-01-04.csv",)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert scanned(spark, find) == 2
