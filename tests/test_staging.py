from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridloom.functions.text import is_negative_number, looks_like_date, looks_like_number, strip
from gridloom.functions.keys import batch_id, date_key, time_key
from gridloom.operators.quality import row_conservation
from gridloom.operators.staging import READINGS, TELEMETRY, WEATHER, reading_rules, stage_meter_readings
from tests.conftest import rows

T = datetime(2024, 1, 16)
RAW = "id long, meter_id string, reading_timestamp string, consumption_kwh string, _loaded_at timestamp_ntz, _batch_id string"


def raw(spark, *readings, loaded=T, batch="b"):
    return spark.createDataFrame([(i, *r, loaded, batch) for i, r in enumerate(readings, 1)], RAW)


@pytest.mark.parametrize(
    "text, number, negative",
    [
        ("5", True, False), ("5.", True, False), ("-5", True, True), ("-0", True, False), ("-0.00", True, False),
        ("-0.001", True, True), (".5", False, None), ("1e3", False, None), ("+5", False, None), ("", False, None),
        ("1 2", False, None), ("5\n", False, None), ("N/A", False, None), ("-" + "9" * 40, True, True), ("٣", False, None),
    ],
)
def test_number_shape(spark, text, number, negative):
    df = spark.createDataFrame([(text,)], "v string")
    got = df.select(looks_like_number(F.col("v")), is_negative_number(F.col("v"))).first()
    assert got[0] is number
    if negative is not None:
        assert got[1] is negative


def test_date_shape_is_a_prefix_test(spark):
    df = spark.createDataFrame([("2024-13-45 junk",), ("24-01-01",), (" 2024-01-01",), (None,)], "v string")
    assert [r[0] for r in df.select(looks_like_date(F.col("v"))).collect()] == [True, False, False, None]


def test_strip_matches_python(spark):
    samples = ["\t a b \n", " x　", "\x1cy\x1f", " z ", "", "   ", "a"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    assert [r[0] for r in df.select(strip(F.col("v"))).collect()] == [s.strip() for s in samples]


def test_keys(spark):
    df = spark.sql("SELECT DATE'2024-02-03' d, TIMESTAMP_NTZ'2024-02-03 00:07:59' t")
    assert tuple(df.select(date_key(F.col("d")), time_key(F.col("t"))).first()) == (20240203, 7)


def test_batch_id_depends_on_table_and_file(spark):
    df = spark.createDataFrame([("a.csv",), ("a.csv",), ("b.csv",)], "f string")
    ids = [r[0] for r in df.select(batch_id("t", F.col("f"))).collect()]
    assert ids[0] == ids[1] != ids[2] and [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]
    assert df.select(batch_id("u", F.col("f"))).first()[0] != ids[0]


#: For each rule of the readings, in order: what a sound row must become to break it, and no earlier rule.
BREAKS = {
    "null_meter_id": {0: None},
    "invalid_timestamp": {1: "morning"},
    "null_consumption": {2: None},
    "invalid_consumption_format": {2: "7,5"},
    "negative_consumption": {2: "-0.25"},
    "uncastable_reading_timestamp": {1: "2024-02-30 10:00"},
    "uncastable_consumption_kwh": {2: "987654321012"},
    "demand_out_of_range": {2: "26000000"},
}


def test_each_rule_rejects_its_own_row(spark):
    assert [r.code for r in reading_rules()] == list(BREAKS)
    sound = ["G7", "2024-02-20 10:45", "0.5"]
    broken = [[changes.get(k, v) for k, v in enumerate(sound)] for changes in BREAKS.values()]
    data = raw(spark, sound, *broken)
    _, rejected = READINGS.split(data, "b", T)
    want = [
        (n, f"{code}: {'null' if (shown := next(iter(changes.values()))) is None else shown}", T, False)
        for n, (code, changes) in enumerate(BREAKS.items(), 2)
    ]
    assert rows(rejected, "source_id", "reason", "quarantined_at", "resolved") == sorted(want)
    staged = stage_meter_readings(data, "b").collect()
    assert [(r.meter_id, r.consumption_kwh, r.reading_date, r.reading_hour) for r in staged] == [
        ("G7", Decimal("0.5"), date(2024, 2, 20), 10)]


def test_default_mode_quarantines_what_reference_mode_loses(spark):
    data = raw(
        spark,
        ("M1", "2024-01-15 08:00", None),
        ("M1", None, "1"),
        ("M1", "2024-13-45", "1"),
        ("M1", "2024-01-15 09:00", "123456789"),
    )
    reasons = [r.reason for r in READINGS.split(data)[1].orderBy("source_id").collect()]
    assert reasons == [
        "null_consumption: null", "invalid_timestamp: null",
        "uncastable_reading_timestamp: 2024-13-45", "uncastable_consumption_kwh: 123456789",
    ]
    valid, rejected = READINGS.split(data.filter("id < 3"), mode="reference")
    assert valid.isEmpty() and rejected.isEmpty()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        READINGS.stage(data.filter("id = 3"), mode="reference").collect()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        READINGS.stage(raw(spark), mode="loose")


def test_latest_row_wins_on_the_parsed_timestamp(spark):
    data = raw(spark, ("M1", "2024-01-15 08:00", "1"), ("M1", "2024-01-15 08:00:00", "2"), ("M1", "2024-01-15T08:00", "3"))
    later = raw(spark, ("M1", "2024-01-15 08:00", "9"), loaded=datetime(2024, 1, 17), batch="c")
    assert rows(stage_meter_readings(data), "consumption_kwh") == [(Decimal("3.0000"),)]
    assert rows(stage_meter_readings(later.union(data)), "consumption_kwh", "_batch_id") == [(Decimal("9.0000"), "c")]
    assert rows(stage_meter_readings(later.union(data), ["b"]), "consumption_kwh") == [(Decimal("3.0000"),)]


def test_staging_ignores_the_order_of_rows(spark):
    data = raw(spark, *[(f"M{i % 3}", "2024-01-15 08:00", str(i)) for i in range(60)])
    expected = rows(stage_meter_readings(data.coalesce(1)))
    assert rows(stage_meter_readings(data.orderBy(F.rand(7)).repartition(5))) == expected


def test_weather_checks_optional_measures_by_cast(spark):
    ddl = ("id long, location_id string, observation_time string, temperature_c string, humidity_pct string, "
           "wind_speed_ms string, cloud_cover_pct string, precipitation_mm string, _loaded_at timestamp_ntz, _batch_id string")
    line = ("L1", "2024-01-15 08:00:00", "7.55", None, "1", "2", "0.125", T, "b")
    bad = ("L1", "2024-01-15 09:00:00", "7", "80", "", "2", "0", T, "b")
    df = spark.createDataFrame([(1, *line), (2, *bad)], ddl)
    staged = WEATHER.stage(df).first()
    assert (staged.temperature_c, staged.humidity_pct, staged.precipitation_mm) == (
        Decimal("7.6"), None, Decimal("0.13"))
    assert WEATHER.split(df)[1].first().reason == "uncastable_wind_speed_ms: "


def test_telemetry_defaults(spark):
    ddl = ("id long, equipment_id string, sensor_type string, reading_timestamp string, sensor_value string, "
           "unit string, _loaded_at timestamp_ntz, _batch_id string")
    df = spark.createDataFrame(
        [(1, "E", "t", "2024-01-15", "1", None, T, "b"), (2, "E", "u", "2024-01-15", None, "C", T, "b")], ddl
    )
    assert rows(TELEMETRY.stage(df), "sensor_type", "unit") == [("t", "N/A")]
    assert rows(TELEMETRY.stage(df, mode="reference"), "sensor_type") == [("t",), ("u",)]
    assert TELEMETRY.split(df)[1].first().reason == "null_sensor_value: null"


def test_conservation(spark):
    data = raw(spark, ("M1", "2024-01-15", "1"), ("M1", "2024-01-15", "2"), ("M1", "x", "1"), ("M1", "2024-01-15", None))
    assert tuple(row_conservation(data, READINGS).first()) == (4, 1, 2, 1, 0, True)
    assert tuple(row_conservation(data, READINGS, "reference").first()) == (4, 1, 1, 1, 1, True)
