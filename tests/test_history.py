"""History merges in one pass, and point-in-time lookup by a sorted union."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridloom.operators import dims, scd2
from gridloom.operators.merge import ConstraintError, merge_upsert, refused_rows, with_copies
from gridloom.operators.surrogate import number_settled
from gridloom.plans.ingest import ingest_files
from gridloom.plans.pipeline import refresh_dimensions
from gridloom.schemas import DIM_CUSTOMER, RAW_CUSTOMERS, RAW_LOCATIONS, RAW_READINGS, STG_READINGS
from gridloom.sources import fixtures as fx
from gridloom.sources.landing import METER_FILES, group_by_header
from gridloom.sources.warehouse import Warehouse
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
VERSION = "key int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
START = datetime(2024, 1, 1)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def planned(df, what: str) -> int:
    return len(re.findall(what, df._jdf.queryExecution().executedPlan().toString()))


def test_history_changes_are_one_join_of_two_reads(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "dim")
    dims.merge_dim_customer(fx.empty_dim_customer(spark), fx.first_snapshot(spark, SF), fx.FIRST_RUN).write.parquet(path)
    dim, source = spark.read.parquet(path), fx.second_snapshot(spark, SF)
    changes = scd2.scd2_changes(dim.filter("is_current"), source, **dims._customer_rules(fx.SECOND_RUN, "contiguous"))
    assert planned(changes, r"\w+Join ") == 1 and planned(changes, r"FileScan parquet") == 2  # the dimension, the source
    assert planned(changes, "Exchange hashpartitioning") == 2
    merged = dims.merge_dim_customer(dim, source, fx.SECOND_RUN)
    assert planned(merged, r"\w+Join ") == 0  # settled; what is left is the untouched past and the numbering
    assert sum("dim" in p for p in re.findall(r"InMemoryFileIndex.*?\]", merged._jdf.queryExecution().executedPlan().toString())) >= 1


def test_type_1_changes_are_one_join(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "dim")
    fx.dim_location(spark, SF).write.parquet(path)
    changes = dims.type1_changes(spark.read.parquet(path), spark.read.parquet(path).drop("location_key"), "location_id", "location_key")
    assert planned(changes, r"\w+Join ") == 1 and planned(changes, "FileScan parquet") == 2


def test_null_keys_do_not_grow(spark):
    snapshot = spark.createDataFrame([(None, "n", "x", None, "a"), ("b", "B", "x", None, "a")],
                                     "customer_id string, customer_name string, tariff_type string, signup_date date, status string")
    once = dims.merge_dim_customer(fx.empty_dim_customer(spark), snapshot, fx.FIRST_RUN)
    again = dims.merge_dim_customer(once, snapshot, fx.SECOND_RUN)
    assert rows(once) == rows(again) and once.count() == 2
    places = spark.createDataFrame([(None, "a"), ("L", "b")], "location_id string, address string")
    dim = spark.createDataFrame([(1, None, "old")], "location_key int, location_id string, address string")
    merged = dims._upsert_dim(dim, places, "location_id", "location_key")
    assert rows(merged) == [(1, None, "a"), (2, "L", "b")]


@pytest.mark.parametrize("per_bucket", [1, 7, 50_000])
def test_settled_rows_are_numbered_densely(spark, per_bucket):
    frame = spark.range(200).selectExpr("concat('n', id) AS name", "id AS value")
    got = number_settled(frame, 40, "k", ["name"], per_bucket).collect()
    assert sorted(r.k for r in got) == list(range(41, 241)) and len({r.name for r in got}) == 200
    assert number_settled(frame.limit(0), None, "k", ["name"]).count() == 0


# --- the history in the warehouse ---------------------------------------------


def customers(spark, tariff):
    return spark.createDataFrame([("a", "A", tariff, None, "x"), ("b", "B", "t", None, "x")],
                                 "customer_id string, customer_name string, tariff_type string, signup_date date, status string")


def run(wh, tariff, day):
    at = START + timedelta(days=day)
    wh.replace(RAW_CUSTOMERS, customers(wh.spark, tariff).withColumn("_loaded_at", F.lit(at).cast("timestamp_ntz")))
    refresh_dimensions(wh, at)


def test_closed_versions_are_appended_and_never_rewritten(spark, wh, tmp_path):
    for day, tariff in enumerate(("one", "two", "three", "three")):
        run(wh, tariff, day)
    got = rows(wh.read(DIM_CUSTOMER), "customer_key", "customer_id", "tariff_type", "is_current")
    assert got == [(1, "a", "one", False), (2, "b", "t", True), (3, "a", "two", False), (4, "a", "three", True)]
    assert rows(wh.read_open(DIM_CUSTOMER), "customer_key") == [(2,), (4,)]
    closed = tmp_path / "warehouse" / "analytics" / "dim_customer_closed"
    assert [spark.read.parquet(str(closed / f"v=0000000{v}")).count() for v in (1, 2, 3, 4)] == [0, 1, 1, 0]


def test_a_failed_merge_of_history_is_not_seen(spark, wh, tmp_path):
    run(wh, "one", 0)
    run(wh, "two", 1)
    before = rows(wh.read(DIM_CUSTOMER))
    # The closed rows of version 3 are written, its open rows are not.
    wh._conform(DIM_CUSTOMER, wh.read_open(DIM_CUSTOMER)).write.parquet(f"{wh.path(DIM_CUSTOMER)}_closed/v=00000003")
    assert rows(wh.read(DIM_CUSTOMER)) == before
    run(wh, "three", 2)
    assert rows(wh.read(DIM_CUSTOMER), "customer_key", "tariff_type") == [(1, "one"), (2, "t"), (3, "two"), (4, "three")]


def test_a_history_written_whole_moves_its_closed_rows(spark, wh):
    old = spark.createDataFrame(
        [(1, "a", "A", "one", "s", "x", START, START + timedelta(days=1), False), (2, "a", "A", "two", "s", "x", START + timedelta(days=1), None, True)],
        DIM_CUSTOMER.ddl)
    wh.replace(DIM_CUSTOMER, old)
    assert wh.read(DIM_CUSTOMER).count() == 2
    run(wh, "three", 3)
    assert rows(wh.read(DIM_CUSTOMER), "customer_key", "tariff_type") == [(1, "one"), (2, "two"), (3, "three"), (4, "t")]


def test_versions_go_by_age(spark, tmp_path):
    place = spark.createDataFrame([("L", "1")], "location_id string, address string")
    filled = place.selectExpr("*", *(f"NULL AS {c}" for c in RAW_LOCATIONS.columns if c not in ("location_id", "address")))
    for keep, left in ((timedelta(days=7), 4), (timedelta(0), 1)):
        wh = Warehouse(spark, str(tmp_path / str(left)), keep)
        for _ in range(4):
            wh.replace(RAW_LOCATIONS, filled)
        assert len(wh._versions(RAW_LOCATIONS)) == left and wh.read(RAW_LOCATIONS).count() == 1


# --- point in time --------------------------------------------------------------


def history(seed: int, overlap: bool):
    rng = random.Random(seed)
    versions, key = [], 0
    for name in ("a", "b", "c", None):
        at = START + timedelta(days=rng.randint(-40, 0))
        for n in range(rng.randint(1, 9)):
            key += 1
            ends = at + timedelta(hours=rng.choice([0, 5, 24 * 45, 24 * 3, 24 * 100]))
            last = rng.random() < 0.2
            versions.append((key, name, at, None if last else ends, last))
            at = ends - timedelta(hours=rng.choice([0, 30]) if overlap else 0) + timedelta(hours=rng.choice([0, 0, 24 * 20]))
            if last and not overlap:
                break
    events = [(k, rng.choice(["a", "b", "c", "d", None]), rng.choice([None, *[START + timedelta(hours=rng.randint(-2000, 9000)) for _ in range(9)]]))
              for k in range(150)]
    events += [(1000 + v[0], v[1], v[2]) for v in versions] + [(2000 + v[0], v[1], v[3]) for v in versions]
    return versions, events


def by_hand(versions, events):
    """The last started version that lasts; it counts only while it is valid."""
    out = []
    for e, name, at in events:
        found = None
        if name is not None and at is not None:
            started = [v for v in versions if v[1] == name and v[2] <= at and (v[3] is None or v[3] > v[2])]
            if started:
                latest = max(started, key=lambda v: (v[2], v[3] or datetime.max))
                found = latest[0] if latest[3] is None or at < latest[3] else None
        out.append((e, found))
    return out


@pytest.mark.parametrize("overlap", [False, True])
@pytest.mark.parametrize("slice_days", [1, 30])
def test_lookup_equals_search_by_hand(spark, overlap, slice_days):
    for seed in (1, 2):
        versions, events = history(seed, overlap)
        dim = spark.createDataFrame(versions, VERSION)
        facts = spark.createDataFrame([(*e, 1) for e in events], "event int, name string, at timestamp_ntz, _ver int")
        left = scd2.as_of(facts, dim, "name", "name", "at", "left", slice_days)
        want = sorted(by_hand(versions, events))
        assert sorted((r.event, r.key) for r in left.collect()) == want
        inner = scd2.as_of(facts, dim, "name", "name", "at", "inner", slice_days)
        assert sorted((r.event, r.key) for r in inner.collect()) == [w for w in want if w[1] is not None]
        assert left.columns == ["event", "name", "at", "_ver", "key", "valid_from", "valid_to", "is_current"]
        if not overlap:
            other = scd2.all_versions_at(facts, dim, "name", "name", "at")
            assert sorted((r.event, r.key) for r in other.select("event", "key").collect()) == [w for w in want if w[1] is not None]


def test_lookup_has_no_join(spark, no_broadcast):
    versions, events = history(3, False)
    facts = spark.createDataFrame(events, "event int, name string, at timestamp_ntz")
    text = scd2.as_of(facts, spark.createDataFrame(versions, VERSION), "name", "name", "at")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text


def test_one_key_with_all_versions_and_events(spark):
    versions = spark.range(100_000).selectExpr(
        "CAST(id AS INT) AS key", "'hot' AS name", "timestampadd(MINUTE, id, TIMESTAMP_NTZ'2024-01-01') AS valid_from",
        "timestampadd(MINUTE, id + 1, TIMESTAMP_NTZ'2024-01-01') AS valid_to", "false AS is_current")
    events = spark.range(1_000_000).selectExpr("id AS event", "'hot' AS name", "timestampadd(SECOND, id * 7 % 6000000, TIMESTAMP_NTZ'2024-01-01') AS at")
    met = scd2.as_of(events, versions, "name", "name", "at", slice_days=3)
    wrong = met.filter("key <> CAST((event * 7 % 6000000) div 60 AS INT)")
    row = met.agg(F.count(F.lit(1)).alias("n")).first()
    assert row.n == 1_000_000 and wrong.isEmpty()


# --- checks on the write, headers ----------------------------------------------------


def reading(spark, *made):
    return spark.createDataFrame(
        [(k, meter, START + timedelta(hours=hour), Decimal(k), hour, k, None, "b", START.date()) for k, meter, hour in made], STG_READINGS.ddl)


def test_repeated_and_null_keys_are_refused_at_the_write(spark, wh):
    update = ("consumption_kwh", "_raw_id", "_batch_id")
    wh.upsert(STG_READINGS, reading(spark, (1, "a", 1), (2, "b", 1)), [START.date()], update)
    before = rows(wh.read(STG_READINGS))
    for bad, said in (([(3, "a", 1), (4, "a", 1), (5, "c", 1)], "'repeated': 2"), ([(3, None, 1), (4, "c", 1)], "'null_meter_id': 1")):
        with pytest.raises(ConstraintError, match=said):
            wh.upsert(STG_READINGS, reading(spark, *bad), [START.date()], update)
        assert rows(wh.read(STG_READINGS)) == before
    wh.upsert(STG_READINGS, reading(spark, (3, "a", 1), (4, "c", 1)), [START.date()], update)
    assert rows(wh.read(STG_READINGS), "meter_id", "_raw_id") == [("a", 3), ("b", 2), ("c", 4)]
    refused = refused_rows(reading(spark, (3, "a", 1), (4, "a", 1), (5, None, 1), (6, "d", 1)), STG_READINGS.keys)
    assert rows(refused, "_raw_id", "refusal") == [(3, "repeated_key"), (4, "repeated_key"), (5, "null_meter_id")]


def test_an_older_row_does_not_replace_a_newer_one(spark, wh):
    update = ("consumption_kwh", "_raw_id")
    wh.upsert(STG_READINGS, reading(spark, (7, "a", 1)), [START.date()], update, newer="_raw_id")
    wh.upsert(STG_READINGS, reading(spark, (5, "a", 1), (6, "b", 1)), [START.date()], update, newer="_raw_id")
    assert rows(wh.read(STG_READINGS), "meter_id", "_raw_id") == [("a", 7), ("b", 6)]


def test_the_check_adds_no_shuffle(spark, no_broadcast):
    updates = spark.range(10).selectExpr("concat('m', id) AS k", "id AS v")
    plain = merge_upsert(updates, updates, ["k"], ["v"])
    counted = merge_upsert(updates, with_copies(updates, ["k"]).observe("seen", F.count_if(F.col("_copies") > 1).alias("n")), ["k"], ["v"])
    assert planned(counted, "Exchange hashpartitioning") == planned(plain, "Exchange hashpartitioning") == 2


def test_many_files_and_headers(spark, wh, landing):
    folder = Path(landing.readings)
    for k in range(800):
        names = ["meter_id", "reading_timestamp", "consumption_kwh", f"extra{k % 3}"]
        line = [f"M{k}", "2024-01-15 08:00:00", str(k), "x"]
        turn = k % 4
        (folder / f"readings_{k:05d}.csv").write_text(",".join(names[turn:] + names[:turn]) + "\n" + ",".join(line[turn:] + line[:turn]) + "\n")
    (folder / "readings_empty.csv").write_text("")
    (folder / "readings_mark.csv").write_text("﻿meter_id,reading_timestamp,consumption_kwh\nMARK,2024-01-15 08:00:00,1\n", encoding="utf-8")
    assert len(group_by_header(spark, [str(p) for p in folder.glob("*.csv")])) == 13
    ingest_files(wh, METER_FILES, landing.readings, START)
    read = wh.read(RAW_READINGS)
    assert read.count() == 801 and read.filter("meter_id <> concat('M', consumption_kwh) AND meter_id <> 'MARK'").isEmpty()
