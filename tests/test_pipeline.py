from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridloom.operators.merge import ConstraintError
from gridloom.plans.ingest import ingest_files, ingest_reference
from gridloom.plans.ledger import batch_with_fallback, load_summary
from gridloom.plans.pipeline import (
    METER_FEED, backfill, day_files, log_checks, log_metrics, resolve, run_day, stage_batches, weather_files,
)
from gridloom.schemas import (
    DIM_CUSTOMER, DIM_METER, DQ_CHECK_RESULTS, DQ_QUARANTINE, FACT_CONSUMPTION, LOAD_LEDGER, RAW_CUSTOMERS,
    RAW_LOCATIONS, RAW_METERS, RAW_READINGS, RAW_TELEMETRY, STG_READINGS, STG_TELEMETRY,
)
from gridloom.sources.landing import METER_FILES, TELEMETRY_FILES, WEATHER_FILES, list_files
from gridloom.sources.warehouse import Warehouse
from gridloom.streaming.incremental import incremental_ingest
from tests.conftest import RUN, rows

HEAD = "meter_id,reading_timestamp,consumption_kwh,unit\n"
READING = ("meter_id", "reading_timestamp", "consumption_kwh", "unit")


def ingest(wh, landing, **extra):
    return ingest_files(wh, METER_FILES, landing.readings, RUN, **extra)


def test_missing_directory(wh):
    with pytest.raises(FileNotFoundError):
        ingest_files(wh, METER_FILES, wh.root + "/nowhere", RUN)


def test_listing_is_flat_and_filtered(spark, landing):
    landing("meter_readings/readings_2024-01-15.csv", HEAD)
    landing("weather.csv", "x\n")
    assert rows(list_files(spark, landing.root, "*.csv"), "source_file") == [("weather.csv",)]


def test_csv_details(wh, landing):
    """Text is stripped, blank lines skipped, quotes honoured, long rows cut, short rows keep NULL."""
    landing(
        "meter_readings/readings_2024-01-15.csv",
        HEAD + ' M1 ,2024-01-15 08:00:00,\t1 ,\n\n"M,2","2024-01-15","say ""2""",kWh\n'
        'M3,2024-01-15,,kWh,surplus,"a,b"\nM4,2024-01-15\n"M,5",2024-01-15,1\n',
    )
    ingest(wh, landing)
    assert rows(wh.read(RAW_READINGS), *READING) == sorted(
        [
            ("M1", "2024-01-15 08:00:00", "1", ""), ("M,2", "2024-01-15", 'say "2"', "kWh"),
            ("M3", "2024-01-15", "", "kWh"), ("M4", "2024-01-15", None, None), ("M,5", "2024-01-15", "1", None),
        ],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_columns_are_matched_by_name(wh, landing):
    landing("meter_readings/readings_1.csv", HEAD + "M1,2024-01-15,1,kWh\n")
    landing("meter_readings/readings_2.csv", "consumption_kwh,extra,meter_id,reading_timestamp\n2,x,M2,2024-01-16\n")
    landing("meter_readings/readings_3.csv", "meter_id,reading_timestamp,consumption_kwh,meter_id\nold,2024-01-17,3,M3\n")
    ingest(wh, landing)
    assert rows(wh.read(RAW_READINGS), *READING, "_source_file") == [
        ("M1", "2024-01-15", "1", "kWh", "readings_1.csv"), ("M2", "2024-01-16", "2", "kWh", "readings_2.csv"),
        ("M3", "2024-01-17", "3", "kWh", "readings_3.csv")]


def test_unusual_file_names(wh, landing):
    names = ["readings_a b.csv", "readings_c+d.csv", "readings_é%20+.csv"]
    for name in names:
        landing(f"meter_readings/{name}", HEAD + "M1,2024-01-15,1,kWh\n")
    assert rows(ingest(wh, landing), "file", "rows_inserted") == [(n, 1) for n in names]
    assert rows(wh.read(RAW_READINGS), "_source_file") == [(n,) for n in names]


def test_header_must_hold_the_needed_columns(wh, landing):
    """A bad file fails alone and is tried again; the others are loaded."""
    landing("meter_readings/readings_1.csv", HEAD + "M1,2024-01-15,1,kWh\n")
    landing("meter_readings/readings_2.csv", "customer_id,name\n1,x\n")
    landing("meter_readings/readings_3.csv", HEAD + "M3,2024-01-15,1,kWh\n")
    assert rows(ingest(wh, landing), "file", "status") == [
        ("readings_1.csv", "success"), ("readings_2.csv", "failed"), ("readings_3.csv", "success")]
    assert rows(wh.read(RAW_READINGS), "meter_id") == [("M1",), ("M3",)]
    landing("meter_readings/readings_2.csv", HEAD + "M2,2024-01-15,1,kWh\n")
    assert rows(ingest(wh, landing), "file", "status")[1] == ("readings_2.csv", "success")


def test_quoted_line_breaks(wh, landing):
    landing("meter_readings/readings_1.csv", HEAD + '"M\n1",2024-01-15,1,kWh\n')
    ingest(wh, landing, multi_line=True)
    assert rows(wh.read(RAW_READINGS), "meter_id") == [("M\n1",)]


def test_loading_is_idempotent(wh, landing):
    landing("meter_readings/readings_1.csv", HEAD + "M1,2024-01-15,1,kWh\nM2,2024-01-15,1,kWh\n")
    landing("meter_readings/readings_2.csv", HEAD)
    first = ingest(wh, landing)
    assert rows(first, "status", "file", "rows_read", "rows_inserted") == [
        ("success", "readings_1.csv", 2, 2), ("success", "readings_2.csv", 0, 0)]
    landing("meter_readings/readings_3.csv", HEAD + "M1,2024-01-16,1,kWh\n")
    second = ingest(wh, landing)
    assert rows(second, "status", "reason", "file", "existing_rows") == sorted(
        [("skipped", "already_ingested", "readings_1.csv", 2), ("skipped", "already_ingested", "readings_2.csv", 0),
         ("success", None, "readings_3.csv", None)],
        key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert tuple(load_summary(second).first()) == (1, 2, 1)
    ids = [r.id for r in wh.read(RAW_READINGS).collect()]
    assert len(ids) == len(set(ids)) == 3


def test_failed_load_is_replaced(wh, landing):
    """Rows left by a load that died before its ledger entry do not survive the next one."""
    landing("meter_readings/readings_1.csv", HEAD + "M1,2024-01-15,1,kWh\n")
    ingest(wh, landing)
    again = Warehouse(wh.spark, wh.root + "2")
    again.overwrite_partitions(RAW_READINGS, wh.read(RAW_READINGS).union(wh.read(RAW_READINGS)))
    ingest(again, landing)
    assert again.read(RAW_READINGS).count() == 1


def test_json_lines(wh, landing):
    landing("telemetry_2024-01-15.json",
            '{"equipment_id":"E1","sensor_type":"t","reading_timestamp":"2024-01-15","sensor_value":1.5}\n'
            '{"equipment_id":"E1","sensor_type":"u","reading_timestamp":"2024-01-15","sensor_value":"x","unit":"C"}\n')
    ingest_files(wh, TELEMETRY_FILES, landing.root, RUN)
    assert rows(wh.read(RAW_TELEMETRY), "sensor_value", "unit") == [("1.5", None), ("x", "C")]


def test_weather_patterns_and_fallback(wh, landing):
    text = "location_id,observation_time\nL1,2024-01-15 08:00\n"
    landing("weather.csv", text)
    landing("weather_2024-01-15.csv", text)
    ingest_files(wh, WEATHER_FILES, landing.root, RUN, "weather.csv")
    ledger = wh.read(LOAD_LEDGER)
    source = WEATHER_FILES.source_table
    assert rows(ledger, "source_file") == [("weather.csv",)]
    shared = batch_with_fallback(ledger, source, "weather_2024-01-15.csv", "weather.csv")
    ingest_files(wh, WEATHER_FILES, landing.root, RUN)
    own = batch_with_fallback(wh.read(LOAD_LEDGER), source, "weather_2024-01-15.csv", "weather.csv")
    assert shared and own and own != shared
    assert batch_with_fallback(ledger, source, "nope", "never") is None


def test_file_picks():
    listed = ["readings_2024-01-15.csv", "readings_2024-01-15.part000001.csv", "readings_2024-01-15_old.csv",
              "weather.csv", "weather_2024-01-16.csv"]
    assert day_files("readings", "2024-01-15", "csv", listed) == listed[:2]
    assert day_files("readings", "2024-01-16", "csv", listed) == []
    assert weather_files(["2024-01-15", "2024-01-16", "2024-01-17"], listed) == ["weather.csv", "weather_2024-01-16.csv"]
    assert weather_files(["2024-01-15"], []) == []


def reference(landing, tariff="residential"):
    landing("customers.csv", "customer_id,customer_name,tariff_type,signup_date,status\n"
            f"C1,Ann,{tariff},2020-01-01,active\nC2,Bob,commercial,,active\nC3,Zed,x,notadate,active\n")
    landing("locations.csv", "location_id,address,city,region,latitude,longitude\nL1,a,London,SE,51.5,\n")
    landing("meters.csv", "meter_id,customer_id,meter_type,install_date,location_id,status\n"
            "M1,C1,smart,2020-01-01,L1,active\nM2,C2,smart,,L1,active\nM3,C9,smart,,L1,active\nM2,C2,analog,,L1,active\n")


def test_reference_files(wh, landing):
    reference(landing)
    for _ in range(2):
        ingest_reference(wh, landing.root, RUN)
    assert rows(wh.read(RAW_CUSTOMERS), "customer_id", "signup_date") == [("C1", date(2020, 1, 1)), ("C2", None)]
    assert rows(wh.read(RAW_LOCATIONS), "country", "timezone", "latitude", "longitude") == [
        ("UK", "Europe/London", Decimal("51.5000000"), None)]
    assert rows(wh.read(RAW_METERS), "meter_id", "meter_type") == [("M1", "smart"), ("M2", "analog")]
    assert rows(wh.read(DQ_QUARANTINE), "reason") == [("orphan_customer_id: C9",), ("uncastable_signup_date: notadate",)]
    with pytest.raises(ConstraintError):
        ingest_reference(wh, landing.root, RUN, strict=True)


def readings(landing):
    landing("weather.csv", "location_id,observation_time,temperature_c,humidity_pct,wind_speed_ms,cloud_cover_pct,"
            "precipitation_mm\nL1,2024-01-15 08:00:00,7.5,80.0,1.0,50.0,0.00\n")
    landing("meter_readings/readings_2024-01-15.csv", HEAD + "M1,2024-01-15 08:00:00,1.5,kWh\nM1,2024-01-15 08:15:00,-5,kWh\n"
            "M2,2024-01-15 09:15:00,3.5,kWh\nM2,2024-01-15 09:15:00,4.5,kWh\n,2024-01-15 09:15:00,4.5,kWh\n")
    landing("meter_readings/readings_2024-01-16.csv", HEAD + "M1,2024-01-15 08:00:00,9.0,kWh\nM2,2024-01-16 00:00:00,1,kWh\n")
    landing("telemetry_2024-01-16.json",
            '{"equipment_id":"E1","sensor_type":"t","reading_timestamp":"2024-01-16 01:00:00","sensor_value":"1"}\n')


def final_fact(wh):
    return rows(wh.read(FACT_CONSUMPTION).join(wh.read(DIM_METER), "meter_key"),
                "meter_id", "date_key", "time_key", "consumption_kwh", "cost_usd", "temperature_c")


def test_days_and_backfill_agree(spark, wh, landing):
    reference(landing)
    readings(landing)
    status = run_day(wh, landing.root, date(2024, 1, 15), datetime(2024, 1, 16))
    got = {r.step: (r.status, r.rows) for r in status.collect()}
    assert got["ingest_meter_readings"] == ("success", 5) and got["stg_meter_readings"] == ("success", 3)
    assert got["stg_equipment_telemetry"] == ("skipped", 0) and got["fact_consumption"] == ("success", 2)
    run_day(wh, landing.root, date(2024, 1, 16), datetime(2024, 1, 17))
    expected = [
        ("M1", 20240115, 800, Decimal("9.0000"), Decimal("2.52"), Decimal("7.5")),
        ("M2", 20240115, 915, Decimal("4.5000"), Decimal("0.99"), None),
        ("M2", 20240116, 0, Decimal("1.0000"), Decimal("0.10"), None),
    ]
    order = lambda r: tuple((v is not None, str(v)) for v in r)
    assert final_fact(wh) == sorted(expected, key=order)
    assert wh.read(STG_TELEMETRY).count() == 1

    # Repeating a day changes nothing, not even the quarantine.
    rejected = wh.read(DQ_QUARANTINE).count()
    run_day(wh, landing.root, date(2024, 1, 16), datetime(2024, 1, 18))
    assert final_fact(wh) == sorted(expected, key=order) and wh.read(DQ_QUARANTINE).count() == rejected

    other = Warehouse(spark, wh.root + "-backfill")
    backfill(other, landing.root, date(2024, 1, 14), date(2024, 1, 17), datetime(2024, 1, 18))
    assert final_fact(other) == final_fact(wh)
    keys = ("meter_id", "reading_timestamp", "consumption_kwh", "_batch_id")
    assert rows(other.read(STG_READINGS), *keys) == rows(wh.read(STG_READINGS), *keys)

    # A missing day skips the fact; a tariff change opens a version and leaves old facts alone.
    reference(landing, tariff="industrial")
    skipped = run_day(wh, landing.root, date(2024, 1, 25), datetime(2024, 1, 26))
    assert {r.step: r.status for r in skipped.collect()}["fact_consumption"] == "skipped"
    assert wh.read(DIM_CUSTOMER).filter("customer_id = 'C1'").count() == 2

    checks = log_checks(wh, date(2024, 1, 26), RUN)
    assert checks.filter("check_name LIKE 'unique%' AND passed").count() == 4
    assert checks.filter("check_name LIKE 'not_null%' AND NOT passed").isEmpty()
    assert checks.filter("check_name = 'not_blank_meter_id'").first().failed_count == 1
    logged = checks.count()
    log_checks(wh, date(2024, 1, 26), RUN)  # a repeated run replaces its day
    assert wh.read(DQ_CHECK_RESULTS).count() == logged
    metrics = {r.metric_name: r.metric_value for r in log_metrics(wh, date(2024, 1, 15), RUN).collect()}
    assert metrics["fact_rows"] == 2 and metrics["total_kwh"] == Decimal("13.5000")

    bad = wh.read(DQ_QUARANTINE).filter("reason LIKE 'negative%'").first()
    resolve(wh, bad.source_table, [bad._batch_id], F.col("reason").startswith("negative"), "fixed", RUN)
    assert wh.read(DQ_QUARANTINE).count() == rejected
    assert rows(wh.read(DQ_QUARANTINE).filter("resolved"), "resolution_note", "resolved_at") == [("fixed", RUN)]


def test_upsert_rewrites_only_touched_partitions(wh, landing):
    readings(landing)
    ingest(wh, landing, names=["readings_2024-01-15.csv"])
    batch = wh.read(LOAD_LEDGER).first().batch_id
    assert stage_batches(wh, METER_FEED, [batch], RUN) == [date(2024, 1, 15)]
    late = wh.read(STG_READINGS).limit(1).withColumns({
        "reading_timestamp": F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz"), "reading_date": F.lit(date(2024, 1, 20))})
    files = set(wh.read(STG_READINGS).inputFiles())
    wh.upsert(STG_READINGS, late, [date(2024, 1, 20)], ["consumption_kwh"])
    assert files < set(wh.read(STG_READINGS).inputFiles())
    assert wh.read(STG_READINGS).count() == 4


def test_interrupted_swap_is_finished_by_the_next_merge(wh, landing, monkeypatch):
    """A driver lost between writing the new partitions and moving them loses no rows."""
    readings(landing)
    ingest(wh, landing)
    first, second = (r.batch_id for r in wh.read(LOAD_LEDGER).orderBy("source_file").collect())
    stage_batches(wh, METER_FEED, [first], RUN)
    monkeypatch.setattr(Warehouse, "_finish_swap", lambda self, table: None)
    stage_batches(wh, METER_FEED, [second], RUN)
    monkeypatch.undo()
    fs, folder = wh._fs(f"{wh.path(STG_READINGS)}/reading_date=2024-01-15")
    fs.delete(folder, True)  # the worst moment: old partition gone, new one not yet moved
    found = rows(wh.read(STG_READINGS))  # reading finishes the swap
    assert not wh._exists(wh._pending(STG_READINGS))
    stage_batches(wh, METER_FEED, [second], RUN)
    assert rows(wh.read(STG_READINGS)) == found and len(found) == 4


def test_interrupted_swap_survives_append_and_resolve(wh, landing, monkeypatch):
    readings(landing)
    ingest(wh, landing)
    batches = [r.batch_id for r in wh.read(LOAD_LEDGER).orderBy("source_file").collect()]
    stage_batches(wh, METER_FEED, batches, RUN)
    before = wh.read(DQ_QUARANTINE).count()
    bad = wh.read(DQ_QUARANTINE).first()
    monkeypatch.setattr(Warehouse, "_finish_swap", lambda self, table: None)
    resolve(wh, bad.source_table, [bad._batch_id], F.lit(True), "fixed", RUN)
    monkeypatch.undo()
    fs, folder = wh._fs(f"{wh.path(DQ_QUARANTINE)}/source_table={bad.source_table}/_batch_id={bad._batch_id}")
    fs.delete(folder, True)
    other = next((b for b in batches if b != bad._batch_id), batches[0])
    resolve(wh, bad.source_table, [other], F.lit(True), "fixed", RUN)
    assert wh.read(DQ_QUARANTINE).count() == before


def test_null_keys_are_quarantined_once(wh, landing):
    landing("meter_readings/readings_2024-01-15.csv", "meter_id,reading_timestamp,consumption_kwh\nM1,2024-01-15 00:00,1\n")
    landing("telemetry_2024-01-15.json", '{"sensor_type":"t","reading_timestamp":"2024-01-15 00:00","sensor_value":"1"}\n')
    for _ in range(3):
        run_day(wh, landing.root, date(2024, 1, 15), RUN)
    assert wh.read(STG_TELEMETRY).isEmpty()
    assert rows(wh.read(DQ_QUARANTINE), "reason") == [("null_equipment_id: null",)]


def test_required_columns_are_checked_on_write(wh):
    row = wh.spark.createDataFrame([(1, None, datetime(2024, 1, 15), 1.0)], "id int, meter_id string, reading_timestamp timestamp_ntz, consumption_kwh double")
    late = row.withColumn("reading_date", F.lit(date(2024, 1, 15)))
    with pytest.raises(Exception, match="null_meter_id"):
        wh.upsert(STG_READINGS, late, [date(2024, 1, 15)], ["consumption_kwh"])


def test_reference_pieces_and_quoted_breaks(wh, landing):
    head = "customer_id,customer_name,tariff_type,signup_date,status\n"
    landing("customers.csv", head + 'C1,"Smith\nJones",residential,2020-01-01,active\nC2,b,residential,2020-01-01,active\n')
    landing("customers.part000001.csv", head + "C2,later,commercial,2020-01-01,active\nC3,c,residential,2020-01-01,active\n")
    landing("customers_old.csv", head + "C9,x,residential,2020-01-01,active\n")
    ingest_reference(wh, landing.root, RUN)
    assert rows(wh.read(RAW_CUSTOMERS), "customer_id", "customer_name", "tariff_type") == [
        ("C1", "Smith\nJones", "residential"), ("C2", "later", "commercial"), ("C3", "c", "residential")]


def test_demand_beyond_its_column_is_quarantined(wh, landing):
    landing("meter_readings/readings_2024-01-15.csv", HEAD + "M1,2024-01-15 00:00,30000000,kWh\nM2,2024-01-15 00:00,24999999,kWh\n")
    ingest(wh, landing)
    stage_batches(wh, METER_FEED, [wh.read(LOAD_LEDGER).first().batch_id], RUN)
    assert rows(wh.read(STG_READINGS), "meter_id") == [("M2",)]
    assert rows(wh.read(DQ_QUARANTINE), "reason") == [("demand_out_of_range: 30000000",)]


def test_versions_are_kept_until_replaced(wh):
    one = wh.spark.createDataFrame([("L1", "a", "c", "r", "UK", None, None, "z", RUN)], RAW_LOCATIONS.ddl)
    for n in range(4):
        wh.replace(RAW_LOCATIONS, one.withColumn("address", F.lit(str(n))))
    assert rows(wh.read(RAW_LOCATIONS), "address") == [("3",)] and len(wh._versions(RAW_LOCATIONS)) == 4  # for a week


def test_stream_loads_each_file_once(wh, landing, tmp_path):
    readings(landing)
    checkpoint = str(tmp_path / "checkpoint")
    call = lambda: incremental_ingest(wh, METER_FEED, landing.readings, checkpoint, lambda: RUN)
    call()
    before = rows(wh.read(STG_READINGS))
    call()
    assert rows(wh.read(STG_READINGS)) == before and wh.read(LOAD_LEDGER).count() == 2
    landing("meter_readings/readings_2024-01-17.csv", "consumption_kwh,meter_id,reading_timestamp\n7,M1,2024-01-17 08:00\n")
    call()
    assert wh.read(STG_READINGS).count() == len(before) + 1
    assert rows(wh.read(RAW_READINGS).filter("_source_file LIKE '%17%'"), "meter_id", "unit") == [("M1", "kWh")]
