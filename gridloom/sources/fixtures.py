"""Metering inputs as projections of the supplied parquet tables.

The rules are the ones of FIXTURES.md part C; defects hang on ``event_id`` so
that every rule has rows at every scale.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.keys import instant
from gridloom.functions.tariff import customer_segment
from gridloom.schemas import DIM_CUSTOMER

FIRST_RUN = datetime(2024, 1, 1)
SECOND_RUN = datetime(2024, 2, 1)


# The plan (not the data) of an input is built once per session and folder.
remembered = lru_cache(maxsize=256)

# Declared, so that reading a table starts no schema-inference job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


@remembered
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def landed(rows: DataFrame) -> DataFrame:
    """Let each derived text column be computed once per row.

    Real raw tables hold these columns; here they are expressions, which the optimizer
    would copy into every predicate and cast that reads them. It does not look through
    a generator, so a one-element ``inline`` keeps them apart.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def padded(number: Column, width: int) -> Column:
    """Zero-padded text that never cuts a longer number."""
    text = number.cast("string")
    return F.concat(F.substring(F.lit("0" * width), F.length(text) + 1, F.lit(width)), text)


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


# --- reference tables -----------------------------------------------------


@remembered
def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("CUST-"), padded(key, 5)).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(segment == "AUTOMOBILE", "residential")
        .when(segment == "BUILDING", "commercial")
        .when(segment == "FURNITURE", "industrial")
        .when(segment == "HOUSEHOLD", "Residential")
        .when(segment == "MACHINERY", "light_commercial")
        .alias("tariff_type"),
        F.when(key % 17 != 0, _days_after("2018-01-01", key * 37 % 1800)).alias("signup_date"),
        F.when(F.col("c_acctbal") < 0, "inactive").otherwise("active").alias("status"),
    )


def _custkey() -> Column:
    return F.substring("customer_id", 6, 20).cast("bigint")


@remembered
def first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_customers(spark, sf_dir).filter(_custkey() % 10 != 6)


@remembered
def second_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = _custkey() % 10
    return (
        raw_customers(spark, sf_dir)
        .filter(digit != 4)
        .select(
            "customer_id",
            F.when(digit == 2, F.concat("customer_name", F.lit("-x")))
            .otherwise(F.col("customer_name")).alias("customer_name"),
            F.when(digit == 1, "commercial").otherwise(F.col("tariff_type")).alias("tariff_type"),
            F.when(digit == 5, F.lit("2020-02-02").cast("date"))
            .otherwise(F.col("signup_date")).alias("signup_date"),
            F.when(digit != 3, F.col("status")).alias("status"),
        )
    )


@remembered
def raw_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("MTR-"), padded(key, 5)).alias("meter_id"),
        F.when(key % 29 != 0, F.concat(F.lit("CUST-"), padded(key, 5))).alias("customer_id"),
        F.when(key % 4 == 3, "analog").otherwise("smart").alias("meter_type"),
        _days_after("2018-01-01", key * 37 % 1800).alias("install_date"),
        F.when(key % 23 != 0, F.concat(F.lit("LOC-"), padded(F.col("c_nationkey"), 3))).alias("location_id"),
        F.when(F.col("c_acctbal") < 0, "decommissioned").otherwise("active").alias("status"),
    )


@remembered
def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")

    def degrees(start: str, step: str) -> Column:
        return (F.lit(Decimal(start)) + key * F.lit(Decimal(step))).cast("decimal(10,7)")

    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("LOC-"), padded(key, 3)).alias("location_id"),
        F.concat(key.cast("string"), F.lit(" Grid Road")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.lit("UK").alias("country"),
        degrees("50.0000000", "0.1234567").alias("latitude"),
        degrees("-3.0000000", "0.0765432").alias("longitude"),
        F.lit("Europe/London").alias("timezone"),
    )


# --- landed files ---------------------------------------------------------


@remembered
def _events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Events (of some kinds) with the two conversions that most columns below start from."""
    events = table(spark, sf_dir, "events")
    if kinds:
        events = events.filter(F.col("event_type").isin(*kinds))
    return landed(
        events.select(
            "event_id",
            "user_id",
            "event_type",
            F.col("ts").cast("string").alias("ts_text"),
            F.col("value").cast("decimal(12,4)").alias("amount"),
        )
    )


def _day_text() -> Column:
    return F.substring("ts_text", 1, 10)


def _quarter_hour_text(skip: Column) -> Column:
    minute = F.substring("ts_text", 15, 2)
    floored = F.when(minute < "15", "00").when(minute < "30", "15").when(minute < "45", "30").otherwise("45")
    slot = F.when(F.col("event_id") % 50 == 7, "07").otherwise(floored)
    return F.when(skip, "").otherwise(F.concat(F.substring("ts_text", 1, 14), slot, F.lit(":00")))


def _lineage(prefix: str, suffix: str) -> list[Column]:
    name = F.concat(F.lit(prefix), _day_text(), F.lit(suffix))
    loaded = F.date_add(_day_text().cast("date"), 1).cast("timestamp_ntz")
    return [name.alias("_source_file"), loaded.alias("_loaded_at"), F.md5(name).alias("_batch_id")]


@remembered
def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    defect, value = F.col("event_id") % 200, F.col("amount")
    text = value.cast("string")
    rows = _events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.when(defect == 0, "").otherwise(F.concat(F.lit("MTR-"), padded(F.col("user_id"), 5))).alias("meter_id"),
        _quarter_hour_text(defect == 1).alias("reading_timestamp"),
        F.when(defect == 2, F.concat(F.lit("-"), text))
        .when(defect == 3, "N/A")
        .when(defect == 4, "")
        .when(defect == 5, _text(None))
        .when(defect == 6, "5.")
        .when(defect == 8, ".5")
        .when(defect == 9, (value * F.lit(100)).cast("decimal(14,4)").cast("string"))
        .otherwise(text)
        .alias("consumption_kwh"),
        F.lit("kWh").alias("unit"),
        *_lineage("readings_", ".csv"),
    )
    return landed(rows)


@remembered
def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, value = F.col("event_id"), F.col("amount")
    hour = F.concat(F.substring("ts_text", 1, 13), F.lit(":00:00"))

    def one_place(number: Column, to_type: str = "decimal(5,1)") -> Column:
        return number.cast(to_type).cast("string")

    celsius = value * F.lit(Decimal("0.05")) - F.lit(Decimal("3.0"))
    rows = (
        _events(spark, sf_dir)
        .select(
            event.alias("id"),
            F.concat(F.lit("LOC-"), padded(F.col("user_id") % 25, 3)).alias("location_id"),
            F.when(event % 151 == 0, "").otherwise(hour).alias("observation_time"),
            F.when(event % 97 == 0, "bad").otherwise(one_place(celsius)).alias("temperature_c"),
            F.when(event % 101 == 0, "n/a")
            .when(event % 13 == 0, _text(None))
            .otherwise(one_place(value * F.lit(Decimal("0.2"))))
            .alias("humidity_pct"),
            F.when(event % 211 == 0, "")
            .otherwise(one_place(event % 300 * F.lit(Decimal("0.1")))).alias("wind_speed_ms"),
            one_place(event % 101 * F.lit(Decimal("1.0"))).alias("cloud_cover_pct"),
            one_place(event % 1000 * F.lit(Decimal("0.01")), "decimal(6,2)").alias("precipitation_mm"),
            *_lineage("weather_", ".csv"),
        )
    )
    return landed(rows)


@remembered
def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    rows = _events(spark, sf_dir).select(
        event.alias("id"),
        F.concat(F.lit("EQ-"), (F.col("user_id") % 40).cast("string")).alias("equipment_id"),
        F.col("event_type").alias("sensor_type"),
        _quarter_hour_text(event % 200 == 1).alias("reading_timestamp"),
        F.when(event % 150 == 0, "err")
        .when(event % 150 == 1, _text(None))
        .otherwise(F.col("amount").cast("string"))
        .alias("sensor_value"),
        F.when(event % 5 != 0, "kW").alias("unit"),
        *_lineage("telemetry_", ".json"),
    )
    return landed(rows)


# --- dimension tables as a finished load would have left them -------------


@remembered
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = F.coalesce(F.col("signup_date").cast("timestamp_ntz"), instant(FIRST_RUN))
    return raw_customers(spark, sf_dir).select(
        (_custkey() + 1).cast("int").alias("customer_key"),
        "customer_id",
        "customer_name",
        "tariff_type",
        customer_segment(F.col("tariff_type")).alias("segment"),
        "status",
        opened.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def empty_dim_customer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_CUSTOMER.ddl)


@remembered
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring("location_id", 5, 20).cast("int")
    return raw_locations(spark, sf_dir).select((number + 1).alias("location_key"), "*")


@remembered
def dim_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring("meter_id", 5, 20).cast("int")
    return raw_meters(spark, sf_dir).select(
        (number + 1).alias("meter_key"),
        "meter_id",
        "meter_type",
        "install_date",
        "status",
        (F.substring("customer_id", 6, 20).cast("int") + 1).alias("customer_key"),
        (F.substring("location_id", 5, 20).cast("int") + 1).alias("location_key"),
    )


# --- the same inputs as landed files ---------------------------------------

def write_landed(rows: DataFrame, directory: str, file_format: str = "csv") -> None:
    """Write ``rows`` as one file per ``_source_file``, in ``id`` order.

    Tasks hold contiguous ranges, so a large day becomes several files whose names
    sort in row order: ``x.csv``, ``x.part000001.csv`` and so on. Adaptive execution
    joins small ranges; no row count is asked for.
    """
    spark = rows.sparkSession
    payload = [c for c in rows.columns if c not in ("id", "_loaded_at", "_batch_id")]
    staging = f"{directory}.parts-{uuid.uuid4().hex}"
    (
        rows.repartitionByRange("_source_file", "id")
        .sortWithinPartitions("_source_file", "id")
        .select(*payload)
        .write.partitionBy("_source_file")
        .options(header=True, emptyValue="")
        .format(file_format)
        .save(staging)
    )
    jvm = spark._jvm
    make = jvm.org.apache.hadoop.fs.Path
    fs = make(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(make(directory))
    written = sorted(
        (status.getPath().getParent().getName().split("=", 1)[1], status.getPath().toString())
        for status in fs.globStatus(make(f"{staging}/_source_file=*/part-*"))
    )
    seen: dict[str, int] = {}
    for name, path in written:
        stem, suffix = name.rsplit(".", 1)
        number = seen[name] = seen.get(name, -1) + 1
        target = name if number == 0 else f"{stem}.part{number:06d}.{suffix}"
        fs.rename(make(path), make(f"{directory}/{target}"))


def write_reference(rows: DataFrame, directory: str, name: str, key: str) -> None:
    """A reference file; these tables hold one row per customer, meter or place."""
    write_landed(rows.withColumns({"id": F.col(key), "_source_file": F.lit(name)}), directory)
