"""Registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.keys import date_key, time_key
from gridloom.functions.tariff import customer_segment, energy_cost, peak_demand, tariff_rate
from gridloom.functions.text import blank_to_null, is_negative_number, looks_like_date, looks_like_number, strip
from gridloom.operators import marts, quality, scd2
from gridloom.operators.calendar import build_dim_date, build_dim_time
from gridloom.operators.dims import TRACKED, build_dim_meter, merge_dim_customer, upsert_dim_location
from gridloom.operators.fact import build_fact_consumption, hot_hours_of, hourly_weather, meter_profile, upsert_fact
from gridloom.operators.merge import (
    ConstraintError, duplicate_keys, insert_if_absent, merge_upsert, null_violations, orphan_rows, refused_rows,
)
from gridloom.operators.staging import READINGS, TELEMETRY, WEATHER
from gridloom.operators.surrogate import assign_keys
from gridloom.plans import oracle_parts as o
from gridloom.plans import standing
from gridloom.plans.ingest import ingest_files, ingest_reference
from gridloom.plans.ledger import batches_with_fallback, load_summary, loaded_between, split_candidates
from gridloom.plans.pipeline import (
    METER_FEED, TELEMETRY_FEED, WEATHER_FEED, backfill, log_checks, log_metrics, period_states, refresh_states, run_day,
    stage_batches,
)
from gridloom.schemas import (
    DIM_CUSTOMER, DIM_LOCATION, DIM_METER, DQ_QUARANTINE, FACT_CONSUMPTION, LOAD_LEDGER, RAW_CUSTOMERS, RAW_LOCATIONS, RAW_METERS,
    RAW_READINGS, RAW_TELEMETRY, RAW_WEATHER, STG_READINGS,
)
from gridloom.session import scratch_dir
from gridloom.sources import fixtures as fx
from gridloom.sources.landing import METER_FILES, TELEMETRY_FILES, WEATHER_FILES, list_files
from gridloom.sources.warehouse import Warehouse
from gridloom.streaming.corrections import stream_corrections
from gridloom.streaming.incremental import incremental_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


# --- sources, shapes, scalar functions ------------------------------------

_PADDED = "chr(9) || ' ' || chr(160) || event_type || ' ' || chr(10)"


@register(
    "src_strip_defaults",
    f"""SELECT event_id, trim({_PADDED}, ' ' || chr(9) || chr(10) || chr(160)) AS stripped,
    nullif(CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END, '') AS blank_as_null,
    coalesce(CASE WHEN event_id % 5 <> 0 THEN event_type END, 'kWh') AS with_default FROM events""",
)
def src_strip_defaults(spark, sf):
    padded = F.concat(F.lit("\t  "), F.col("event_type"), F.lit(" \n"))
    kind = F.col("event_type")
    return fx.table(spark, sf, "events").select(
        "event_id",
        strip(padded).alias("stripped"),
        blank_to_null(F.when(F.col("event_id") % 3 == 0, "").otherwise(kind)).alias("blank_as_null"),
        F.coalesce(F.when(F.col("event_id") % 5 != 0, kind), F.lit("kWh")).alias("with_default"),
    )


@register(
    "flt_timestamp_shape",
    o.sql(
        f"""SELECT id, reading_timestamp FROM raw_readings
        WHERE regexp_matches(reading_timestamp, {o.DATE_SHAPE})""",
        o.RAW_READINGS,
    ),
)
def flt_timestamp_shape(spark, sf):
    return fx.raw_readings(spark, sf).filter(looks_like_date(F.col("reading_timestamp"))).select(
        "id", "reading_timestamp"
    )


@register(
    "flt_number_shape",
    o.sql(
        f"""SELECT id, consumption_kwh, regexp_matches(consumption_kwh, {o.NUMBER_SHAPE}) AS is_number
        FROM raw_readings""",
        o.RAW_READINGS,
    ),
)
def flt_number_shape(spark, sf):
    text = F.col("consumption_kwh")
    return fx.raw_readings(spark, sf).select("id", text, looks_like_number(text).alias("is_number"))


@register(
    "flt_nullable_number",
    o.sql(
        f"""SELECT id, humidity_pct FROM raw_weather
        WHERE humidity_pct IS NULL OR regexp_matches(humidity_pct, {o.NUMBER_SHAPE})""",
        o.RAW_WEATHER,
    ),
)
def flt_nullable_number(spark, sf):
    text = F.col("humidity_pct")
    return fx.raw_weather(spark, sf).filter(text.isNull() | looks_like_number(text)).select("id", text)


@register(
    "flt_negative",
    o.sql(
        f"""SELECT id, consumption_kwh FROM raw_readings
        WHERE regexp_matches(consumption_kwh, {o.NUMBER_SHAPE})
          AND TRY_CAST(consumption_kwh AS DECIMAL(38,10)) < 0""",
        o.RAW_READINGS,
    ),
)
def flt_negative(spark, sf):
    text = F.col("consumption_kwh")
    return fx.raw_readings(spark, sf).filter(looks_like_number(text) & is_negative_number(text)).select("id", text)


@register(
    "null_drop_audit",
    o.sql(
        f"""SELECT CASE WHEN reason IS NOT NULL THEN 'quarantined'
          WHEN consumption_kwh IS NULL OR reading_timestamp IS NULL THEN 'dropped' ELSE 'passed' END AS outcome,
          count(*) AS row_count
        FROM (SELECT *, {o.READING_REASON} AS reason FROM raw_readings) GROUP BY 1""",
        o.RAW_READINGS,
    ),
)
def null_drop_audit(spark, sf):
    raw = fx.raw_readings(spark, sf)
    valid, rejected = READINGS.split(raw, mode="reference")
    outcome = (
        valid.select(F.lit("passed").alias("outcome"))
        .unionByName(rejected.select(F.lit("quarantined").alias("outcome")))
        .unionByName(raw.filter(READINGS.dropped()).filter(
            ~F.coalesce(~looks_like_date(F.col("reading_timestamp")), F.lit(False))
        ).select(F.lit("dropped").alias("outcome")))
    )
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"))


# --- quarantine -----------------------------------------------------------

_REJECTED = ("source_table", "source_id", "reason", "raw_data", "resolved", "_batch_id")


def _rejected_sql(raw: str, part: str, reason: str, table: str, cols: tuple[str, ...]) -> str:
    pairs = ", ".join(f"'{c}', {c}" for c in cols)
    return o.sql(
        f"""SELECT '{table}' AS source_table, id AS source_id, reason,
          CAST(json_object({pairs}) AS VARCHAR) AS raw_data, FALSE AS resolved, _batch_id
        FROM (SELECT *, {reason} AS reason FROM {raw}) WHERE reason IS NOT NULL""",
        part,
    )


def _register_rejects(name, stage, rows, raw, part, reason, mode):
    @register(name, _rejected_sql(raw, part, reason, stage.source_table, stage.snapshot))
    def run(spark, sf):
        return stage.split(rows(spark, sf), mode=mode)[1].select(*_REJECTED)


_register_rejects("quarantine_readings", READINGS, fx.raw_readings, "raw_readings", o.RAW_READINGS,
                  o.READING_REASON, "reference")
_register_rejects("quarantine_readings_default", READINGS, fx.raw_readings, "raw_readings", o.RAW_READINGS,
                  o.READING_REASON_DEFAULT, "default")
_register_rejects("quarantine_weather", WEATHER, fx.raw_weather, "raw_weather", o.RAW_WEATHER,
                  o.WEATHER_REASON, "default")
_register_rejects("quarantine_telemetry", TELEMETRY, fx.raw_telemetry, "raw_telemetry", o.RAW_TELEMETRY,
                  o.TELEMETRY_REASON, "reference")


# --- staging --------------------------------------------------------------


def staged(spark, sf) -> DataFrame:
    return READINGS.stage(fx.raw_readings(spark, sf))


def staged_weather(spark, sf) -> DataFrame:
    return WEATHER.stage(fx.raw_weather(spark, sf))


@register("stage_readings", o.sql("SELECT * FROM staged", o.RAW_READINGS, o.STAGED))
def stage_readings(spark, sf):
    return staged(spark, sf)


@register("stage_weather", o.sql("SELECT * FROM staged_weather", o.RAW_WEATHER, o.STAGED_WEATHER))
def stage_weather_query(spark, sf):
    return staged_weather(spark, sf)


@register("stage_telemetry", o.sql("SELECT * FROM staged_telemetry", o.RAW_TELEMETRY, o.STAGED_TELEMETRY))
def stage_telemetry_query(spark, sf):
    return TELEMETRY.stage(fx.raw_telemetry(spark, sf), mode="reference")


_BATCH = "readings_2024-01-15.csv"


@register(
    "stage_one_batch",
    o.sql(f"SELECT * FROM staged WHERE _batch_id = md5('{_BATCH}')", o.RAW_READINGS, o.STAGED),
)
def stage_one_batch(spark, sf):
    """One day's batch, the unit in which the daily run stages."""
    batch = hashlib.md5(_BATCH.encode()).hexdigest()
    return READINGS.stage(fx.raw_readings(spark, sf), batch)


# --- calendar, joined to the readings that use it --------------------------


@register(
    "dim_date",
    o.sql(
        """SELECT d.*, coalesce(n, 0) AS readings FROM dim_date d
        LEFT JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1) ON day = full_date""",
        o.DIM_DATE,
    ),
)
def dim_date_query(spark, sf):
    used = fx.table(spark, sf, "events").groupBy(F.to_date("ts").alias("full_date")).agg(
        F.count(F.lit(1)).alias("readings")
    )
    return build_dim_date(spark).join(used, "full_date", "left").fillna(0, ["readings"])


@register(
    "dim_time",
    o.sql(
        """SELECT t.*, coalesce(n, 0) AS readings FROM dim_time t
        LEFT JOIN (SELECT CAST(extract('hour' FROM ts) * 100 + (extract('minute' FROM ts) // 15) * 15 AS INTEGER)
            AS slot, count(*) AS n FROM events GROUP BY 1) ON slot = time_key""",
        o.DIM_TIME,
    ),
)
def dim_time_query(spark, sf):
    slot = (F.hour("ts") * 100 + F.floor(F.minute("ts") / 15) * 15).cast("int")
    used = fx.table(spark, sf, "events").groupBy(slot.alias("time_key")).agg(F.count(F.lit(1)).alias("readings"))
    return build_dim_time(spark).join(used, "time_key", "left").fillna(0, ["readings"])


@register(
    "date_time_keys",
    o.sql(
        """SELECT _raw_id, CAST(strftime(reading_date, '%Y%m%d') AS INTEGER) AS date_key,
          CAST(extract('hour' FROM reading_timestamp) * 100 + extract('minute' FROM reading_timestamp) AS INTEGER)
            AS time_key FROM staged""",
        o.RAW_READINGS, o.STAGED,
    ),
)
def date_time_keys(spark, sf):
    return staged(spark, sf).select(
        "_raw_id",
        date_key(F.col("reading_date")).alias("date_key"),
        time_key(F.col("reading_timestamp")).alias("time_key"),
    )


# --- tariff ---------------------------------------------------------------


@register(
    "segment_derivation",
    o.sql(f"SELECT customer_id, tariff_type, {o.SEGMENT} AS segment FROM raw_customers", o.RAW_CUSTOMERS),
)
def segment_derivation(spark, sf):
    return fx.raw_customers(spark, sf).select(
        "customer_id", "tariff_type", customer_segment(F.col("tariff_type")).alias("segment")
    )


_PRICED = """SELECT s._raw_id, c.tariff_type, s.consumption_kwh,
  extract('hour' FROM s.reading_timestamp) BETWEEN 7 AND 20 AS is_peak
  FROM staged s JOIN raw_meters m ON s.meter_id = m.meter_id
  JOIN raw_customers c ON m.customer_id = c.customer_id"""
_PRICED_PARTS = (o.RAW_READINGS, o.STAGED, o.RAW_METERS, o.RAW_CUSTOMERS)


def _priced(spark, sf) -> DataFrame:
    owners = fx.raw_meters(spark, sf).select("meter_id", "customer_id").join(
        fx.raw_customers(spark, sf).select("customer_id", "tariff_type"), "customer_id"
    )
    return staged(spark, sf).join(owners, "meter_id").select(
        "_raw_id", "tariff_type", "consumption_kwh",
        F.hour("reading_timestamp").between(7, 20).alias("is_peak"),
    )


@register(
    "tariff_cost",
    o.sql(f"SELECT _raw_id, is_peak, CAST({o.COST} AS DECIMAL(10,2)) AS cost_usd FROM ({_PRICED})", *_PRICED_PARTS),
)
def tariff_cost(spark, sf):
    rate = tariff_rate(F.col("tariff_type"), F.col("is_peak"))
    return _priced(spark, sf).select(
        "_raw_id", "is_peak", energy_cost(F.col("consumption_kwh"), rate).alias("cost_usd")
    )


@register(
    "tariff_cost_custom_rates",
    o.sql(
        f"""SELECT _raw_id, CAST(consumption_kwh * CASE WHEN tariff_type = 'industrial' AND is_peak THEN 0.31
          WHEN tariff_type = 'industrial' THEN 0.07 ELSE 0.10 END AS DECIMAL(10,2)) AS cost_usd FROM ({_PRICED})""",
        *_PRICED_PARTS,
    ),
)
def tariff_cost_custom_rates(spark, sf):
    rates = {("industrial", True): Decimal("0.31"), ("industrial", False): Decimal("0.07")}
    rate = tariff_rate(F.col("tariff_type"), F.col("is_peak"), rates)
    return _priced(spark, sf).select("_raw_id", energy_cost(F.col("consumption_kwh"), rate).alias("cost_usd"))


@register(
    "peak_demand",
    o.sql(
        "SELECT _raw_id, CAST(consumption_kwh * 4.0 AS DECIMAL(10,2)) AS peak_demand_kw FROM staged",
        o.RAW_READINGS, o.STAGED,
    ),
)
def peak_demand_query(spark, sf):
    return staged(spark, sf).select("_raw_id", peak_demand(F.col("consumption_kwh")).alias("peak_demand_kw"))


# --- merges ---------------------------------------------------------------

# Stored readings: every third one, older values; the update covers the second half of the month.
_TARGET = """target AS (SELECT meter_id, reading_timestamp, CAST(1.5 AS DECIMAL(12,4)) AS consumption_kwh,
  reading_date, reading_hour, _raw_id + 1000000000 AS _raw_id, 'old' AS _batch_id
  FROM staged WHERE _raw_id % 3 = 0)"""


def _stored_readings(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_raw_id") % 3 == 0).withColumns(
        {
            "consumption_kwh": F.lit(Decimal("1.5")).cast("decimal(12,4)"),
            "_raw_id": F.col("_raw_id") + 1000000000,
            "_batch_id": F.lit("old"),
        }
    )


@register(
    "upsert_readings",
    o.sql(
        """SELECT coalesce(t.meter_id, u.meter_id) AS meter_id,
          coalesce(t.reading_timestamp, u.reading_timestamp) AS reading_timestamp,
          coalesce(u.consumption_kwh, t.consumption_kwh) AS consumption_kwh,
          coalesce(t.reading_date, u.reading_date) AS reading_date,
          coalesce(t.reading_hour, u.reading_hour) AS reading_hour,
          coalesce(u._raw_id, t._raw_id) AS _raw_id, coalesce(u._batch_id, t._batch_id) AS _batch_id
        FROM target t FULL JOIN (SELECT * FROM staged WHERE reading_date >= DATE '2024-01-15') u
          ON t.meter_id = u.meter_id AND t.reading_timestamp = u.reading_timestamp""",
        o.RAW_READINGS, o.STAGED, _TARGET,
    ),
)
def upsert_readings(spark, sf):
    rows = staged(spark, sf)
    updates = rows.filter(F.col("reading_date") >= date(2024, 1, 15))
    return merge_upsert(
        _stored_readings(rows), updates, ["meter_id", "reading_timestamp"],
        update_cols=["consumption_kwh", "_raw_id", "_batch_id"],
    )


def _register_upsert(name, feed, part, cte, table, rows, mode, stale):
    """Half of the staged rows is stored with ``stale`` values (column: Spark, SQL); the update holds two
    thirds of them. Stored rows that it lacks stay as they are, and so do columns that are not updated."""
    keys = feed.stage.keys
    refreshed = [c for c in feed.update_cols if c != "_loaded_at"]
    stored, updated = "_raw_id % 2 = 0", "_raw_id % 3 <> 0"

    def shown(c: str) -> str:
        if c not in stale:
            return f"u.{c}"
        old = stored if c not in refreshed else f"{stored} AND NOT {updated}"
        return f"CASE WHEN {old} THEN {stale[c]} ELSE u.{c} END AS {c}"

    columns = ", ".join(shown(c) for c in (*feed.stage.columns, "_raw_id", "_batch_id"))

    @register(name, o.sql(f"SELECT {columns} FROM {table} u WHERE {stored} OR {updated}", part, cte))
    def run(spark, sf):
        fresh = feed.stage.stage(rows(spark, sf), mode=mode)
        old = fresh.filter(stored).withColumns({c: F.expr(v).cast(fresh.schema[c].dataType) for c, v in stale.items()})
        return merge_upsert(old, fresh.filter(updated), keys, refreshed)


_register_upsert("upsert_weather", WEATHER_FEED, o.RAW_WEATHER, o.STAGED_WEATHER, "staged_weather", fx.raw_weather,
                 "default", {"temperature_c": "-99.9", "observation_hour": "-1", "_batch_id": "'old'"})
_register_upsert("upsert_telemetry", TELEMETRY_FEED, o.RAW_TELEMETRY, o.STAGED_TELEMETRY, "staged_telemetry",
                 fx.raw_telemetry, "reference", {"sensor_value": "-1.0", "unit": "'old'", "_batch_id": "'old'"})


@register(
    "insert_if_absent",
    o.sql(
        """SELECT * FROM target UNION ALL SELECT * FROM staged s WHERE NOT EXISTS (
          SELECT 1 FROM target t WHERE t.meter_id = s.meter_id AND t.reading_timestamp = s.reading_timestamp)""",
        o.RAW_READINGS, o.STAGED, _TARGET,
    ),
)
def insert_if_absent_query(spark, sf):
    rows = staged(spark, sf)
    return insert_if_absent(_stored_readings(rows), rows, ["meter_id", "reading_timestamp"])


@register(
    "upsert_location",
    o.sql(
        """SELECT location_id, address, city, region, country, latitude, longitude, timezone,
          location_id IN (SELECT location_id FROM raw_locations WHERE right(location_id, 1) IN ('0', '4', '7'))
            AS kept_key FROM raw_locations""",
        o.RAW_LOCATIONS,
    ),
)
def upsert_location(spark, sf):
    """A stale third of the dimension is refreshed in place, the others are added with new keys."""
    known = F.substring("location_id", -1, 1).isin("0", "4", "7")
    stored = fx.dim_location(spark, sf).filter(known).withColumn("city", F.lit("stale"))
    merged = upsert_dim_location(stored, fx.raw_locations(spark, sf))
    before = stored.select("location_id", F.col("location_key").alias("_key"))
    return merged.join(before, "location_id", "left").select(
        "location_id", "address", "city", "region", "country", "latitude", "longitude", "timezone",
        F.coalesce(F.col("_key") == F.col("location_key"), F.lit(False)).alias("kept_key"),
    )


@register(
    "surrogate_keys",
    o.sql(
        """SELECT count(*) AS rows_numbered, count(*) AS distinct_keys, CAST(41 AS INTEGER) AS first_key,
          CAST(40 + count(*) AS INTEGER) AS last_key FROM raw_customers""",
        o.RAW_CUSTOMERS,
    ),
)
def surrogate_keys(spark, sf):
    """Keys continue after the stored maximum and leave no gap."""
    new = fx.raw_customers(spark, sf)
    stored = fx.table(spark, sf, "region").select((F.col("r_regionkey") * 10).cast("int").alias("customer_key"))
    return assign_keys(new, stored, "customer_key", ["customer_id"]).agg(
        F.count(F.lit(1)).alias("rows_numbered"),
        F.countDistinct("customer_key").alias("distinct_keys"),
        F.min("customer_key").alias("first_key"),
        F.max("customer_key").alias("last_key"),
    )


# --- dimensions -----------------------------------------------------------

_CHANGED = """(d.customer_name IS DISTINCT FROM s.customer_name OR d.tariff_type IS DISTINCT FROM s.tariff_type
  OR d.status IS DISTINCT FROM s.status)"""
_DIM1 = f"""dim1 AS (SELECT customer_id, customer_name, tariff_type, {o.SEGMENT} AS segment, status,
  coalesce(CAST(signup_date AS TIMESTAMP), TIMESTAMP '2024-01-01') AS valid_from FROM first_snapshot)"""
_EXPIRED = f"""expired AS (SELECT d.customer_id, d.customer_name, d.tariff_type, d.segment, d.status, d.valid_from,
  CASE WHEN s.customer_id IS NOT NULL AND {_CHANGED} THEN TIMESTAMP '2024-02-01' END AS valid_to,
  NOT (s.customer_id IS NOT NULL AND {_CHANGED}) AS is_current
  FROM dim1 d LEFT JOIN second_snapshot s ON d.customer_id = s.customer_id)"""


def _opened(name: str, starts: str) -> str:
    return f"""{name} AS (SELECT customer_id, customer_name, tariff_type, {o.SEGMENT} AS segment, status,
  {starts} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM second_snapshot s
  WHERE NOT EXISTS (SELECT 1 FROM expired e WHERE e.customer_id = s.customer_id AND e.is_current))"""


_SIGNUP = "coalesce(CAST(signup_date AS TIMESTAMP), TIMESTAMP '2024-02-01')"
_OPENED = _opened(
    "opened",
    f"""CASE WHEN EXISTS (SELECT 1 FROM dim1 d WHERE d.customer_id = s.customer_id)
    THEN TIMESTAMP '2024-02-01' ELSE {_SIGNUP} END""",
)
_OPENED_REF = _opened("opened", _SIGNUP)
_SCD2 = (o.RAW_CUSTOMERS, o.SNAPSHOTS, _DIM1, _EXPIRED)
_VERSION = ("customer_id", "customer_name", "tariff_type", "segment", "status", "valid_from", "valid_to", "is_current")


def first_dim_customer(spark, sf) -> DataFrame:
    return merge_dim_customer(fx.empty_dim_customer(spark), fx.first_snapshot(spark, sf), fx.FIRST_RUN)


def history(spark, sf, policy: str = "contiguous") -> DataFrame:
    return merge_dim_customer(first_dim_customer(spark, sf), fx.second_snapshot(spark, sf), fx.SECOND_RUN, policy)


@register("scd2_expire", o.sql("SELECT * FROM expired", *_SCD2))
def scd2_expire_query(spark, sf):
    return scd2.scd2_expire(
        first_dim_customer(spark, sf), fx.second_snapshot(spark, sf), "customer_id", TRACKED, fx.SECOND_RUN
    ).select(*_VERSION)


@register("scd2_new_versions", o.sql("SELECT * FROM opened", *_SCD2, _OPENED))
def scd2_new_versions(spark, sf):
    """The versions opened by the second run; first-run versions all have smaller keys."""
    before = first_dim_customer(spark, sf).select("customer_key")
    return history(spark, sf).join(before, "customer_key", "left_anti").select(*_VERSION)


_UNION = "SELECT * FROM expired UNION ALL SELECT * FROM opened"


@register("scd2_merge", o.sql(_UNION, *_SCD2, _OPENED))
def scd2_merge_query(spark, sf):
    return history(spark, sf).select(*_VERSION)


@register("scd2_merge_reference_policy", o.sql(_UNION, *_SCD2, _OPENED_REF))
def scd2_merge_reference(spark, sf):
    return history(spark, sf, "reference").select(*_VERSION)


@register(
    "scd2_point_in_time",
    o.sql(
        f"""SELECT e.event_id, v.customer_id, v.tariff_type, v.status, v.is_current
        FROM (SELECT event_id, ts + INTERVAL 15 DAY AS at, 'CUST-' || {o.padded('user_id', 5)} AS customer_id
              FROM events) e
        JOIN ({_UNION}) v ON e.customer_id = v.customer_id AND e.at >= v.valid_from
          AND (v.valid_to IS NULL OR e.at < v.valid_to)""",
        *_SCD2, _OPENED,
    ),
)
def scd2_point_in_time(spark, sf):
    """Events moved half a month on, so that they fall on both sides of the second run."""
    events = fx.table(spark, sf, "events").select(
        "event_id",
        (F.col("ts") + F.expr("INTERVAL 15 DAYS")).alias("at"),
        F.concat(F.lit("CUST-"), fx.padded(F.col("user_id"), 5)).alias("customer_id"),
    )
    return scd2.as_of(events, history(spark, sf), "customer_id", "customer_id", "at").select(
        "event_id", "customer_id", "tariff_type", "status", "is_current"
    )


@register(
    "scd2_as_at",
    o.sql(
        f"""SELECT * FROM ({_UNION}) WHERE TIMESTAMP '2024-01-20' >= valid_from
        AND (valid_to IS NULL OR TIMESTAMP '2024-01-20' < valid_to)""",
        *_SCD2, _OPENED,
    ),
)
def scd2_as_at(spark, sf):
    return marts.customer_at(history(spark, sf), datetime(2024, 1, 20)).select(*_VERSION)


@register(
    "dim_meter_fk",
    o.sql(
        """SELECT m.meter_id, m.meter_type, m.install_date, m.status, c.customer_id, l.location_id
        FROM raw_meters m LEFT JOIN raw_customers c ON m.customer_id = c.customer_id
        LEFT JOIN raw_locations l ON m.location_id = l.location_id""",
        o.RAW_CUSTOMERS, o.RAW_METERS, o.RAW_LOCATIONS,
    ),
)
def dim_meter_fk(spark, sf):
    """Half of the dimension is stored with stale attributes; keys are shown as the ids they point to."""
    customers, locations = fx.dim_customer(spark, sf), fx.dim_location(spark, sf)
    stored = fx.dim_meter(spark, sf).filter(F.col("meter_key") % 2 == 0).withColumns(
        {"status": F.lit("stale"), "customer_key": F.lit(None).cast("int")}
    )
    dim = build_dim_meter(stored, fx.raw_meters(spark, sf), customers, locations)
    return (
        dim.join(customers.select("customer_key", "customer_id"), "customer_key", "left")
        .join(locations.select("location_key", "location_id"), "location_key", "left")
        .select("meter_id", "meter_type", "install_date", "status", "customer_id", "location_id")
    )


@register(
    "fk_orphans",
    o.sql(
        """SELECT meter_id, customer_id FROM raw_meters m WHERE customer_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM first_snapshot c WHERE c.customer_id = m.customer_id)""",
        o.RAW_CUSTOMERS, o.SNAPSHOTS, o.RAW_METERS,
    ),
)
def fk_orphans(spark, sf):
    return orphan_rows(
        fx.raw_meters(spark, sf), fx.first_snapshot(spark, sf), "customer_id", "customer_id"
    ).select("meter_id", "customer_id")


# --- fact -----------------------------------------------------------------


def star(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx.dim_meter(spark, sf), fx.dim_customer(spark, sf), fx.dim_location(spark, sf)


def fact(spark, sf) -> DataFrame:
    return build_fact_consumption(
        staged(spark, sf),
        meter_profile(*star(spark, sf)),
        build_dim_date(spark),
        build_dim_time(spark),
        staged_weather(spark, sf),
    )


def with_ids(rows: DataFrame, meters: DataFrame, customers: DataFrame, locations: DataFrame) -> DataFrame:
    """Replace surrogate keys by the natural ids they stand for."""
    ids = {
        "meter_key": meters.select("meter_key", "meter_id"),
        "customer_key": customers.select("customer_key", "customer_id"),
        "location_key": locations.select("location_key", "location_id"),
    }
    for key, names in ids.items():
        if key in rows.columns:
            rows = rows.join(names, key).drop(key)
    return rows


_FACT_COLS = """meter_id, customer_id, location_id, date_key, time_key, consumption_kwh, cost_usd,
  peak_demand_kw, temperature_c, is_peak_hour, is_weekend, _stg_id"""


@register("fact_consumption", o.sql(f"SELECT {_FACT_COLS} FROM fact", *o.FACT_CHAIN))
def fact_consumption(spark, sf):
    return with_ids(fact(spark, sf), *star(spark, sf))


@register(
    "weather_enrich",
    o.sql(
        """SELECT s._raw_id, l.location_id, w.temperature_c FROM staged s
        JOIN raw_meters m ON s.meter_id = m.meter_id JOIN raw_locations l ON m.location_id = l.location_id
        LEFT JOIN hourly w ON l.location_id = w.location_id AND s.reading_date = w.observation_date
          AND s.reading_hour = w.observation_hour""",
        o.RAW_METERS, o.RAW_LOCATIONS, o.RAW_READINGS, o.RAW_WEATHER, o.STAGED, o.STAGED_WEATHER, o.HOURLY,
    ),
)
def weather_enrich(spark, sf):
    places = fx.raw_meters(spark, sf).select("meter_id", "location_id").filter("location_id IS NOT NULL")
    hourly = hourly_weather(staged_weather(spark, sf)).withColumnsRenamed(
        {"observation_date": "reading_date", "observation_hour": "reading_hour"}
    )
    return (
        staged(spark, sf)
        .join(places, "meter_id")
        .join(hourly, ["location_id", "reading_date", "reading_hour"], "left")
        .select("_raw_id", "location_id", "temperature_c")
    )


@register("fact_consumption_hot", ORACLES["fact_consumption"])
def fact_consumption_hot(spark, sf):
    """The fact with the busiest places and hours dealt to several tasks each."""
    profile = meter_profile(*star(spark, sf))
    hot = hot_hours_of(staged(spark, sf), profile, 0.0005)
    rows = build_fact_consumption(
        staged(spark, sf), profile, build_dim_date(spark), build_dim_time(spark), staged_weather(spark, sf), hot_hours=hot
    )
    return with_ids(rows, *star(spark, sf))


@register(
    "fact_upsert",
    o.sql(
        """SELECT meter_id, CASE WHEN _stg_id % 4 = 0 THEN 'CUST-00000' ELSE customer_id END AS customer_id,
          location_id, date_key, time_key, consumption_kwh, cost_usd, peak_demand_kw, temperature_c,
          is_peak_hour, is_weekend, _stg_id FROM fact""",
        *o.FACT_CHAIN,
    ),
)
def fact_upsert(spark, sf):
    """A quarter of the rows is stored under another customer with stale measures.

    The merge refreshes the measures and leaves the stored customer alone.
    """
    rows = fact(spark, sf)
    stored = rows.filter(F.col("_stg_id") % 4 == 0).withColumns(
        {"customer_key": F.lit(1), "cost_usd": F.lit(None).cast("decimal(10,2)"), "is_weekend": F.lit(False)}
    )
    return with_ids(upsert_fact(stored, rows), *star(spark, sf))


# --- batch bookkeeping ----------------------------------------------------


def _uuid(text: str) -> str:
    """SQL of the library's batch id: the digest of table and file in the shape of a UUID."""
    cuts = ", ".join(f"substring(md5({text}), {at}, {size})" for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat_ws('-', {cuts})"


_DAY_OF_FILE = "CAST(substring(_source_file, 18, 2) AS INTEGER)"
_FILES = "files AS (SELECT _source_file, count(*) AS row_count FROM raw_readings GROUP BY _source_file)"


@register(
    "batch_lookup_fallback",
    o.sql(
        f"""SELECT day, {_uuid("'raw.raw_weather_data:' || CASE WHEN CAST(right(day, 2) AS INTEGER) % 2 = 0 "
                               "THEN 'weather_' || day || '.csv' ELSE 'weather.csv' END")} AS weather_batch
        FROM (SELECT DISTINCT substring(CAST(ts AS VARCHAR), 1, 10) AS day FROM events)"""
    ),
)
def batch_lookup_fallback(spark, sf):
    """Even days bring a weather file of their own; the others take the batch of the shared one."""
    wh, landing = _new_warehouse(spark), scratch_dir(spark, "landing")
    rows = fx.raw_weather(spark, sf)
    even = F.substring("_source_file", 17, 2).cast("int") % 2 == 0
    fx.write_landed(rows.withColumn("_source_file", F.when(even, F.col("_source_file")).otherwise("weather.csv")), landing)
    ingest_files(wh, WEATHER_FILES, landing, fx.FIRST_RUN)
    days = fx.table(spark, sf, "events").select(F.substring(F.col("ts").cast("string"), 1, 10).alias("day")).distinct()
    wanted = days.select(
        "day", F.concat(F.lit("weather_"), "day", F.lit(".csv")).alias("preferred"), F.lit("weather.csv").alias("fallback")
    )
    found = batches_with_fallback(wh.read(LOAD_LEDGER), WEATHER_FILES.source_table, wanted)
    return found.select("day", F.col("batch_id").alias("weather_batch"))


def _half_loaded(spark, sf) -> tuple[Warehouse, str]:
    """Readings of which the first nine days are loaded."""
    wh, folder = _new_warehouse(spark), f"{_landing(spark, sf, 'readings')}/meter_readings"
    ingest_files(wh, METER_FILES, folder, fx.FIRST_RUN, "readings_????-??-0*.csv")
    return wh, folder


@register("ledger_pending", o.sql(f"SELECT _source_file FROM files WHERE {_DAY_OF_FILE} >= 10", o.RAW_READINGS, _FILES))
def ledger_pending(spark, sf):
    wh, folder = _half_loaded(spark, sf)
    files = list_files(spark, folder, METER_FILES.pattern)
    candidates = split_candidates(files, wh.read(LOAD_LEDGER), METER_FILES.source_table)
    return candidates.filter("existing_rows IS NULL").select(
        F.regexp_replace("source_file", r"\.part\d+", "").alias("_source_file")
    ).distinct()


@register(
    "load_metrics",
    o.sql(
        f"""SELECT CASE WHEN {_DAY_OF_FILE} < 10 THEN 'skipped' ELSE 'success' END AS status, _source_file AS file,
          CAST(CASE WHEN {_DAY_OF_FILE} < 10 THEN 0 ELSE row_count END AS BIGINT) AS rows_read,
          CAST(CASE WHEN {_DAY_OF_FILE} < 10 THEN 0 ELSE row_count END AS BIGINT) AS rows_inserted FROM files""",
        o.RAW_READINGS, _FILES,
    ),
)
def load_metrics(spark, sf):
    wh, folder = _half_loaded(spark, sf)
    metrics = ingest_files(wh, METER_FILES, folder, fx.SECOND_RUN)
    return metrics.groupBy("status", F.regexp_replace("file", r"\.part\d+", "").alias("file")).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_inserted").alias("rows_inserted")
    )


@register(
    "load_summary",
    o.sql(
        f"""SELECT CAST(count(*) FILTER (WHERE {_DAY_OF_FILE} >= 10) AS BIGINT) AS loaded,
          CAST(count(*) FILTER (WHERE {_DAY_OF_FILE} < 10) AS BIGINT) AS skipped,
          CAST(sum(CASE WHEN {_DAY_OF_FILE} < 10 THEN 0 ELSE row_count END) AS BIGINT) AS total_rows FROM files""",
        o.RAW_READINGS, _FILES,
    ),
)
def load_summary_query(spark, sf):
    return load_summary(load_metrics(spark, sf))


@register(
    "refused_at_write",
    o.sql(
        """SELECT _raw_id, CASE WHEN copies > 1 THEN 'repeated_key' ELSE 'null_meter_id' END AS refusal, 0 AS published
        FROM (SELECT id AS _raw_id, meter_id, count(*) OVER (PARTITION BY meter_id, moment) AS copies
          FROM (SELECT id, nullif(meter_id, '') AS meter_id, TRY_CAST(reading_timestamp AS TIMESTAMP) AS moment
            FROM raw_readings WHERE reason IS NULL))
        WHERE copies > 1 OR meter_id IS NULL""".replace("FROM raw_readings WHERE reason IS NULL", f"""FROM (SELECT *,
              {o.READING_REASON_DEFAULT} AS reason FROM raw_readings) WHERE reason IS NULL"""),
        o.RAW_READINGS,
    ).replace("CASE WHEN copies > 1 THEN 'repeated_key' ELSE 'null_meter_id' END", "CASE WHEN meter_id IS NULL THEN 'null_meter_id' ELSE 'repeated_key' END"),
)
def refused_at_write(spark, sf):
    """Typed readings that nobody has reduced to one a key, some without a meter: the write is refused as a
    whole, nothing is published, and these rows are why."""
    valid, _ = READINGS.split(fx.raw_readings(spark, sf))
    rows = READINGS.typed_rows(valid).withColumn("meter_id", blank_to_null(F.col("meter_id")))
    wh = _new_warehouse(spark)
    updates = rows.withColumns({"meter_reading_id": F.col("_raw_id"), "_loaded_at": F.lit(None).cast("timestamp_ntz")})
    days = [r.reading_date for r in rows.select("reading_date").distinct().collect()]
    try:
        wh.upsert(STG_READINGS, updates, days, METER_FEED.update_cols)
    except ConstraintError:
        pass
    published = wh.read(STG_READINGS).count()
    return refused_rows(rows, STG_READINGS.keys).select("_raw_id", "refusal", F.lit(published).cast("int").alias("published"))


# --- data quality ---------------------------------------------------------

_RUN_DAY = date(2024, 2, 1)


@register(
    "dq_nulls",
    o.sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS failed_count, "
            "count(*) AS total_count FROM raw_readings"
            for c in ("meter_id", "reading_timestamp", "consumption_kwh", "unit")
        ),
        o.RAW_READINGS,
    ),
)
def dq_nulls(spark, sf):
    return quality.count_blanks(
        fx.raw_readings(spark, sf), ["meter_id", "reading_timestamp", "consumption_kwh", "unit"]
    )


@register(
    "dq_duplicates",
    o.sql(
        """SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
        FROM (SELECT count(*) AS n FROM raw_readings GROUP BY meter_id, reading_timestamp HAVING count(*) > 1)""",
        o.RAW_READINGS,
    ),
)
def dq_duplicates(spark, sf):
    return quality.surplus_rows(fx.raw_readings(spark, sf), ["meter_id", "reading_timestamp"])


@register(
    "constraint_nulls",
    o.sql(
        """SELECT count(*) FILTER (WHERE meter_id IS NULL) AS meter_id,
        count(*) FILTER (WHERE reading_timestamp IS NULL) AS reading_timestamp,
        count(*) FILTER (WHERE consumption_kwh IS NULL) AS consumption_kwh FROM raw_readings""",
        o.RAW_READINGS,
    ),
)
def constraint_nulls(spark, sf):
    return null_violations(fx.raw_readings(spark, sf), ["meter_id", "reading_timestamp", "consumption_kwh"])


@register(
    "constraint_duplicates",
    o.sql(
        """SELECT meter_id, reading_timestamp, count(*) AS copies FROM raw_readings
        GROUP BY meter_id, reading_timestamp HAVING count(*) > 1""",
        o.RAW_READINGS,
    ),
)
def constraint_duplicates(spark, sf):
    return duplicate_keys(fx.raw_readings(spark, sf), ["meter_id", "reading_timestamp"])


@register(
    "dq_range",
    o.sql(
        """SELECT count(*) FILTER (WHERE consumption_kwh NOT BETWEEN 0 AND 400) AS failed_count,
        count(*) AS total_count FROM staged""",
        o.RAW_READINGS, o.STAGED,
    ),
)
def dq_range(spark, sf):
    check = quality.in_range("consumption_kwh", Decimal("0"), Decimal("400"))
    return quality.run_checks(staged(spark, sf), [check], "staging.stg_meter_readings", _RUN_DAY).select(
        "failed_count", "total_count"
    )


# What log_checks asks of each table: (check, failing rows, severity, rows that may fail, details).
_NO_LIMIT = 1 << 62


def _not_null(columns: str) -> list[tuple]:
    return [(f"not_null_{c}", f"{c} IS NULL", "error", 0, f"{c} is NULL") for c in columns.split()]


def _not_blank(column: str) -> tuple:
    return (f"not_blank_{column}", f"{column} IS NULL OR trim({column}) = ''", "error", 0, f"{column} is NULL or blank")


def _range(column: str, low: int, high: int) -> tuple:
    return (f"range_{column}", f"{column} NOT BETWEEN {low} AND {high}", "warning", 0, f"{column} outside [{low}, {high}]")


def _length(column: str) -> tuple:
    return (f"length_{column}", f"length({column}) > 50", "error", 0, f"{column} longer than 50")


_LOGGED = (
    ("staging.stg_meter_readings", "staged", "meter_id, reading_timestamp",
     [*_not_null("meter_id reading_timestamp consumption_kwh reading_date reading_hour"), _not_blank("meter_id"),
      _length("meter_id"), _range("consumption_kwh", 0, 10000)]),
    ("staging.stg_weather_data", "staged_weather", "location_id, observation_time",
     [*_not_null("location_id observation_time observation_date observation_hour"), _not_blank("location_id"),
      _range("temperature_c", -60, 60), _range("humidity_pct", 0, 100)]),
    ("analytics.fact_consumption", "fact", "meter_id, date_key, time_key",
     [*((f"not_null_{c}", "FALSE", "error", 0, f"{c} is NULL") for c in
        ("meter_key", "customer_key", "location_key", "date_key", "time_key", "consumption_kwh")),
      _range("cost_usd", 0, 10000),
      ("has_temperature", "temperature_c IS NULL", "info", _NO_LIMIT, None)]),
)


def _logged_sql(table: str, source: str, keys: str, checks: list[tuple]) -> str:
    shown = keys.replace("meter_id, date_key", "meter_key, date_key")
    rows = [
        f"""SELECT '{name}' AS check_name, '{table}' AS table_name, count(*) FILTER (WHERE {bad}) <= {allowed} AS passed,
          count(*) FILTER (WHERE {bad}) AS failed_count, count(*) AS total_count, '{severity}' AS severity,
          {'CAST(NULL AS VARCHAR)' if details is None else f"'{details}'"} AS details FROM {source}"""
        for name, bad, severity, allowed, details in checks
    ]
    rows.append(
        f"""SELECT 'unique_{shown.replace(", ", "_")}', '{table}', coalesce(sum(n - 1), 0) = 0, CAST(coalesce(sum(n - 1), 0) AS BIGINT),
          CAST(coalesce(sum(n), 0) AS BIGINT), 'error', 'key {shown}' FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"""
    )
    return " UNION ALL ".join(rows)


def _stored(spark, sf) -> Warehouse:
    """A warehouse as a finished load leaves it: staged readings and weather, and the fact."""
    wh = _new_warehouse(spark)
    loaded = {"_loaded_at": F.lit(None).cast("timestamp_ntz")}
    for feed, rows in ((METER_FEED, staged(spark, sf)), (WEATHER_FEED, staged_weather(spark, sf))):
        wh.overwrite_partitions(feed.target, rows.withColumns({feed.surrogate: F.col("_raw_id"), **loaded}))
    wh.overwrite_partitions(FACT_CONSUMPTION, fact(spark, sf).withColumns({"consumption_id": F.col("_stg_id"), **loaded}))
    return wh


@register(
    "dq_results",
    o.sql(
        f"""SELECT *, DATE '2024-02-01' AS execution_date FROM ({" UNION ALL ".join(_logged_sql(*t) for t in _LOGGED)})
        ORDER BY ALL""",
        *o.FACT_CHAIN,
    ),
)
def dq_results(spark, sf):
    """The log of a run's checks, written twice: the repetition replaces it. Telemetry has no rows."""
    wh = _stored(spark, sf)
    for _ in range(2):
        log = log_checks(wh, _RUN_DAY, fx.SECOND_RUN)
    return log.filter("table_name <> 'staging.stg_equipment_telemetry'").drop("execution_time_ms", "created_at")


_BOUNDS = """bounds AS (SELECT meter_id, q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high,
    mean, deviation
  FROM (SELECT meter_id, quantile_cont(CAST(consumption_kwh AS DOUBLE), 0.25) AS q1,
      quantile_cont(CAST(consumption_kwh AS DOUBLE), 0.75) AS q3,
      avg(CAST(consumption_kwh AS DOUBLE)) AS mean, stddev_samp(CAST(consumption_kwh AS DOUBLE)) AS deviation
    FROM staged GROUP BY meter_id))"""


@register(
    "dq_outlier_bounds",
    o.sql(
        """SELECT meter_id, round(q1, 6) AS q1, round(q3, 6) AS q3, round(low, 6) AS low, round(high, 6) AS high,
        round(mean, 6) AS mean, round(deviation, 6) AS deviation FROM bounds""",
        o.RAW_READINGS, o.STAGED, _BOUNDS,
    ),
)
def dq_outlier_bounds(spark, sf):
    bounds = quality.outlier_bounds(staged(spark, sf), ["meter_id"], "consumption_kwh")
    return bounds.select(
        "meter_id", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "low", "high", "mean", "deviation")]
    )


@register(
    "dq_outliers",
    o.sql(
        """SELECT * FROM (SELECT s._raw_id, s.meter_id, s.consumption_kwh,
          CAST(s.consumption_kwh AS DOUBLE) < low OR CAST(s.consumption_kwh AS DOUBLE) > high AS iqr_outlier,
          coalesce(abs((CAST(s.consumption_kwh AS DOUBLE) - mean) / nullif(deviation, 0)) > 3, FALSE) AS z_outlier
        FROM staged s JOIN bounds b ON s.meter_id = b.meter_id) WHERE iqr_outlier OR z_outlier""",
        o.RAW_READINGS, o.STAGED, _BOUNDS,
    ),
)
def dq_outliers(spark, sf):
    rows = staged(spark, sf).select("_raw_id", "meter_id", "consumption_kwh")
    return quality.flag_outliers(rows, ["meter_id"], "consumption_kwh")


_PERIOD = (date(2024, 1, 6), date(2024, 1, 25))


@register(
    "dq_period_bounds",
    o.sql(
        """SELECT meter_id, n, q1, q3, round(low, 6) AS low, round(high, 6) AS high, round(mean, 6) AS mean,
          round(deviation, 6) AS deviation
        FROM (SELECT meter_id, n, q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high, mean, deviation
          FROM (SELECT meter_id, count(*) AS n, quantile_disc(CAST(consumption_kwh AS DOUBLE), 0.25) AS q1,
              quantile_disc(CAST(consumption_kwh AS DOUBLE), 0.75) AS q3, avg(CAST(consumption_kwh AS DOUBLE)) AS mean,
              stddev_samp(CAST(consumption_kwh AS DOUBLE)) AS deviation
            FROM staged WHERE reading_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25' AND meter_id <> '' GROUP BY meter_id))""",
        o.RAW_READINGS, o.STAGED,
    ),
)
def dq_period_bounds(spark, sf):
    """States of each meter and day are kept, those of some days twice; the period's bounds need no reading.

    Rows without a meter stand in no period: their group outgrows what a sketch holds exactly.
    """
    wh = _new_warehouse(spark)
    rows = staged(spark, sf).filter("meter_id <> ''").withColumns(
        {"meter_reading_id": F.col("_raw_id"), "_loaded_at": F.lit(None).cast("timestamp_ntz")}
    )
    wh.overwrite_partitions(STG_READINGS, rows)
    days = [r.reading_date for r in wh.read(STG_READINGS).select("reading_date").distinct().collect()]
    refresh_states(wh, days)
    refresh_states(wh, [d for d in days if d.day > 20])
    bounds = quality.period_bounds(period_states(wh, *_PERIOD), ["meter_id"])
    return bounds.select(
        "meter_id", "n", "q1", "q3", *[F.round(c, 6).alias(c) for c in ("low", "high", "mean", "deviation")]
    )


@register(
    "dq_pipeline_metrics",
    o.sql(
        """SELECT 'fact_consumption' AS pipeline_name, DATE '2024-01-15' AS execution_date, metric_name,
          CAST(metric_value AS DECIMAL(15,4)) AS metric_value FROM (
          SELECT 'fact_rows' AS metric_name, CAST(count(*) AS DECIMAL(15,4)) AS metric_value FROM fact WHERE date_key = 20240115
          UNION ALL SELECT 'total_kwh', CAST(coalesce(sum(consumption_kwh), 0) AS DECIMAL(15,4)) FROM fact WHERE date_key = 20240115
          UNION ALL SELECT 'total_cost_usd', CAST(coalesce(sum(cost_usd), 0) AS DECIMAL(15,4)) FROM fact WHERE date_key = 20240115)""",
        *o.FACT_CHAIN,
    ),
)
def dq_pipeline_metrics(spark, sf):
    wh = _stored(spark, sf)
    for _ in range(2):
        log = log_metrics(wh, date(2024, 1, 15), fx.SECOND_RUN)
    return log.drop("details", "created_at")


@register(
    "row_conservation",
    o.sql(
        f"""SELECT (SELECT count(*) FROM raw_readings) AS raw_rows, (SELECT count(*) FROM staged) AS staged_rows,
          (SELECT count(*) FROM tagged WHERE reason IS NOT NULL) AS quarantined_rows,
          (SELECT count(*) FROM tagged WHERE reason IS NULL AND consumption_kwh IS NOT NULL)
            - (SELECT count(*) FROM staged) AS duplicate_rows,
          (SELECT count(*) FROM tagged WHERE reason IS NULL AND consumption_kwh IS NULL) AS dropped_rows,
          TRUE AS balanced""",
        o.RAW_READINGS, o.STAGED,
        f"tagged AS (SELECT consumption_kwh, {o.READING_REASON} AS reason FROM raw_readings)",
    ),
)
def row_conservation(spark, sf):
    return quality.row_conservation(fx.raw_readings(spark, sf), READINGS, mode="reference")


def _all_rejects(spark, sf) -> DataFrame:
    return (
        READINGS.split(fx.raw_readings(spark, sf))[1]
        .unionByName(WEATHER.split(fx.raw_weather(spark, sf))[1])
    )


_REJECT_PARTS = (
    o.RAW_READINGS, o.RAW_WEATHER,
    f"""rejects AS (SELECT * FROM (SELECT 'raw.raw_meter_readings' AS source_table, id,
      {o.READING_REASON_DEFAULT} AS reason FROM raw_readings
      UNION ALL SELECT 'raw.raw_weather_data', id, {o.WEATHER_REASON} FROM raw_weather) WHERE reason IS NOT NULL)""",
)


@register(
    "quarantine_open",
    o.sql(
        """SELECT source_table, split_part(reason, ':', 1) AS reason_code, count(*) AS open_rows
        FROM rejects GROUP BY 1, 2""",
        *_REJECT_PARTS,
    ),
)
def quarantine_open(spark, sf):
    return quality.unresolved_quarantine(_all_rejects(spark, sf))


@register(
    "quarantine_resolve",
    o.sql(
        """SELECT source_table, id AS source_id, reason, starts_with(reason, 'negative') AS resolved,
          CASE WHEN starts_with(reason, 'negative') THEN TIMESTAMP '2024-02-01' END AS resolved_at,
          CASE WHEN starts_with(reason, 'negative') THEN 'meter swapped' END AS resolution_note FROM rejects""",
        *_REJECT_PARTS,
    ),
)
def quarantine_resolve(spark, sf):
    done = quality.resolve_quarantine(
        _all_rejects(spark, sf), F.col("reason").startswith("negative"), "meter swapped", fx.SECOND_RUN
    )
    return done.select("source_table", "source_id", "reason", "resolved", "resolved_at", "resolution_note")


@register(
    "loaded_on_day",
    o.sql(
        "SELECT id, meter_id, _source_file FROM raw_readings WHERE CAST(_loaded_at AS DATE) = DATE '2024-01-10'",
        o.RAW_READINGS,
    ),
)
def loaded_on_day(spark, sf):
    return quality.loaded_on(fx.raw_readings(spark, sf), date(2024, 1, 10)).select("id", "meter_id", "_source_file")


@register(
    "loaded_between",
    o.sql("SELECT meter_id, _source_file FROM raw_readings WHERE " + _DAY_OF_FILE + " >= 10", o.RAW_READINGS),
)
def loaded_between_query(spark, sf):
    """Two loads on two days; the rows of the second are found through the ledger."""
    wh, folder = _half_loaded(spark, sf)
    ingest_files(wh, METER_FILES, folder, fx.SECOND_RUN)
    rows = loaded_between(wh.read(RAW_READINGS), wh.read(LOAD_LEDGER), METER_FILES.source_table, fx.SECOND_RUN, datetime(2024, 2, 2))
    return rows.select("meter_id", _base_name())


# --- marts ----------------------------------------------------------------

_SUMS = "CAST(sum(consumption_kwh) AS DECIMAL(24,4)) AS total_kwh, CAST(sum(cost_usd) AS DECIMAL(24,2)) AS total_cost"


@register(
    "daily_customer_summary",
    o.sql(
        f"""SELECT date_key, customer_id, count(*) AS readings, {_SUMS},
          CAST(coalesce(sum(consumption_kwh) FILTER (WHERE is_peak_hour), 0) AS DECIMAL(24,4)) AS peak_kwh,
          CAST(coalesce(sum(consumption_kwh) FILTER (WHERE NOT is_peak_hour), 0) AS DECIMAL(24,4)) AS offpeak_kwh
        FROM fact GROUP BY date_key, customer_id""",
        *o.FACT_CHAIN,
    ),
)
def daily_customer_summary(spark, sf):
    return with_ids(marts.daily_customer_summary(fact(spark, sf)), *star(spark, sf))


@register(
    "date_range_totals",
    o.sql(
        f"""SELECT date_key, count(*) AS readings, {_SUMS}, max(peak_demand_kw) AS max_demand_kw
        FROM fact WHERE date_key BETWEEN 20240105 AND 20240120 GROUP BY date_key""",
        *o.FACT_CHAIN,
    ),
)
def date_range_totals(spark, sf):
    return marts.date_range_totals(fact(spark, sf), date(2024, 1, 5), date(2024, 1, 20))


@register(
    "customer_analysis",
    o.sql(
        f"""SELECT segment, tariff_type, count(DISTINCT customer_id) AS customers, count(*) AS readings, {_SUMS}
        FROM fact GROUP BY segment, tariff_type""",
        *o.FACT_CHAIN,
    ),
)
def customer_analysis(spark, sf):
    return marts.customer_analysis(fact(spark, sf), fx.dim_customer(spark, sf))


@register(
    "regional_rollup",
    o.sql(
        f"""SELECT region, city, count(*) AS readings, {_SUMS},
          CAST(grouping(region) * 2 + grouping(city) AS INTEGER) AS level FROM fact GROUP BY ROLLUP (region, city)""",
        *o.FACT_CHAIN,
    ),
)
def regional_rollup(spark, sf):
    return marts.regional_rollup(fact(spark, sf), fx.dim_location(spark, sf))


def _loaded_in_pieces(spark, sf) -> Warehouse:
    """Three overlapping loads of the fact; the first holds half of the rows, at stale prices."""
    wh = _new_warehouse(spark)
    every = fact(spark, sf).withColumns(
        {"consumption_id": F.col("_stg_id").cast("bigint"), "_loaded_at": F.lit(None).cast("timestamp_ntz")}
    )
    stale = every.filter(F.col("_stg_id") % 2 == 0).withColumn("cost_usd", F.lit(1).cast("decimal(10,2)"))
    days = sorted(r[0] for r in every.select("date_key").distinct().collect())
    for rows, some in ((stale, days[:20]), (every, days[10:]), (every, days[:12])):
        wh.overwrite_partitions(FACT_CONSUMPTION, rows.filter(F.col("date_key").isin(some)))
        standing.refresh_totals(wh, [datetime.strptime(str(d), "%Y%m%d").date() for d in some])
    return wh


@register("standing_daily_summary", ORACLES["daily_customer_summary"])
def standing_daily_summary(spark, sf):
    return with_ids(standing.standing_daily_summary(_loaded_in_pieces(spark, sf)), *star(spark, sf))


@register("standing_customer_analysis", ORACLES["customer_analysis"])
def standing_customer_analysis(spark, sf):
    return standing.standing_customer_analysis(_loaded_in_pieces(spark, sf), fx.dim_customer(spark, sf))


@register("standing_regional_rollup", ORACLES["regional_rollup"])
def standing_regional_rollup(spark, sf):
    return standing.standing_regional_rollup(_loaded_in_pieces(spark, sf), fx.dim_location(spark, sf))


@register(
    "meter_series",
    o.sql(
        """SELECT meter_id, date_key, total_kwh,
          lag(total_kwh) OVER (PARTITION BY meter_id ORDER BY date_key) AS previous_kwh,
          CAST(sum(total_kwh) OVER (PARTITION BY meter_id ORDER BY strptime(CAST(date_key AS VARCHAR), '%Y%m%d')
            RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS DECIMAL(24,4)) AS rolling_kwh
        FROM (SELECT meter_id, date_key, CAST(sum(consumption_kwh) AS DECIMAL(24,4)) AS total_kwh
              FROM fact GROUP BY meter_id, date_key)""",
        *o.FACT_CHAIN,
    ),
)
def meter_series(spark, sf):
    return with_ids(marts.meter_series(fact(spark, sf)), *star(spark, sf))


@register(
    "readings_range",
    o.sql(
        "SELECT * FROM staged WHERE reading_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
        o.RAW_READINGS, o.STAGED,
    ),
)
def readings_range(spark, sf):
    return marts.readings_range(staged(spark, sf), date(2024, 1, 10), date(2024, 1, 12))


@register(
    "meter_range",
    o.sql(
        """SELECT meter_id, reading_timestamp, consumption_kwh FROM staged
        WHERE meter_id IN ('MTR-00001', 'MTR-00042') AND reading_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
        o.RAW_READINGS, o.STAGED,
    ),
)
def meter_range(spark, sf):
    """Two meters of some days from the warehouse, where rows lie by meter and time inside a day."""
    wh = _new_warehouse(spark)
    rows = staged(spark, sf).withColumns({"meter_reading_id": F.col("_raw_id"), "_loaded_at": F.lit(None).cast("timestamp_ntz")})
    days = [r.reading_date for r in rows.select("reading_date").distinct().collect()]
    wh.upsert(STG_READINGS, rows, days, METER_FEED.update_cols)
    stored = marts.readings_range(wh.read(STG_READINGS), date(2024, 1, 10), date(2024, 1, 20), ["MTR-00001", "MTR-00042"])
    return stored.select("meter_id", "reading_timestamp", "consumption_kwh")


@register(
    "weather_bands",
    o.sql(
        f"""SELECT CAST(floor(temperature_c / 5) * 5 AS INTEGER) AS band_from_c, count(*) AS readings, {_SUMS}
        FROM fact WHERE temperature_c IS NOT NULL GROUP BY 1""",
        *o.FACT_CHAIN,
    ),
)
def weather_bands(spark, sf):
    return marts.weather_bands(fact(spark, sf))


@register(
    "weather_correlation",
    o.sql(
        """SELECT count(*) AS readings, round(corr(CAST(temperature_c AS DOUBLE), CAST(consumption_kwh AS DOUBLE)), 6)
          AS correlation FROM fact WHERE temperature_c IS NOT NULL""",
        *o.FACT_CHAIN,
    ),
)
def weather_correlation(spark, sf):
    return marts.weather_correlation(fact(spark, sf))


# --- files, warehouse and stream -------------------------------------------

# A blank CSV field is read as '', so NULLs of the projections arrive blank.
_CSV_READINGS = o.RAW_READINGS.replace("raw_readings AS (", "readings_src AS (") + """,
raw_readings AS (SELECT * REPLACE (coalesce(consumption_kwh, '') AS consumption_kwh) FROM readings_src)"""
_CSV_WEATHER = o.RAW_WEATHER.replace("raw_weather AS (", "weather_src AS (") + """,
raw_weather AS (SELECT * REPLACE (coalesce(humidity_pct, '') AS humidity_pct) FROM weather_src)"""
_LANDED_FACT = tuple(
    {o.RAW_READINGS: _CSV_READINGS, o.RAW_WEATHER: _CSV_WEATHER}.get(part, part) for part in o.FACT_CHAIN
)
_NATURAL_FACT = """SELECT meter_id, customer_id, location_id, date_key, time_key, consumption_kwh, cost_usd,
  peak_demand_kw, temperature_c, is_peak_hour, is_weekend FROM fact"""


def _landing(spark, sf, *kinds: str) -> str:
    """A new landing folder with the wanted kinds of files, derived from the given tables."""
    root = scratch_dir(spark, "landing")
    if "reference" in kinds:
        fx.write_reference(fx.raw_customers(spark, sf), root, "customers.csv", "customer_id")
        fx.write_reference(fx.raw_locations(spark, sf), root, "locations.csv", "location_id")
        fx.write_reference(fx.raw_meters(spark, sf), root, "meters.csv", "meter_id")
    if "readings" in kinds:
        fx.write_landed(fx.raw_readings(spark, sf), f"{root}/meter_readings")
    if "weather" in kinds:
        fx.write_landed(fx.raw_weather(spark, sf), root)
    if "telemetry" in kinds:
        fx.write_landed(fx.raw_telemetry(spark, sf), root, "json")
    return root


def _new_warehouse(spark) -> Warehouse:
    return Warehouse(spark, scratch_dir(spark, "warehouse"))


def _base_name() -> Column:
    """The file's name without the piece number a large day would have."""
    return F.regexp_replace("_source_file", r"\.part\d+", "").alias("_source_file")


@register(
    "csv_ingest",
    o.sql(
        "SELECT meter_id, reading_timestamp, consumption_kwh, unit, _source_file FROM raw_readings", _CSV_READINGS
    ),
)
def csv_ingest(spark, sf):
    wh, landing = _new_warehouse(spark), _landing(spark, sf, "readings")
    ingest_files(wh, METER_FILES, f"{landing}/meter_readings", fx.SECOND_RUN)
    return wh.read(RAW_READINGS).select(
        "meter_id", "reading_timestamp", "consumption_kwh", "unit", _base_name()
    )


@register(
    "weather_ingest",
    o.sql(
        """SELECT location_id, observation_time, temperature_c, humidity_pct, wind_speed_ms, cloud_cover_pct,
        precipitation_mm, _source_file FROM raw_weather""",
        _CSV_WEATHER,
    ),
)
def weather_ingest(spark, sf):
    wh, landing = _new_warehouse(spark), _landing(spark, sf, "weather")
    ingest_files(wh, WEATHER_FILES, landing, fx.SECOND_RUN)
    return wh.read(RAW_WEATHER).select(*WEATHER_FILES.fields, _base_name())


@register(
    "json_ingest",
    o.sql(
        """SELECT equipment_id, sensor_type, reading_timestamp, sensor_value, unit, _source_file
        FROM raw_telemetry""",
        o.RAW_TELEMETRY,
    ),
)
def json_ingest(spark, sf):
    wh, landing = _new_warehouse(spark), _landing(spark, sf, "telemetry")
    ingest_files(wh, TELEMETRY_FILES, landing, fx.SECOND_RUN)
    return wh.read(RAW_TELEMETRY).select(*TELEMETRY_FILES.fields, _base_name())


@register(
    "directory_ingest",
    o.sql(
        """SELECT CASE WHEN CAST(substring(_source_file, 18, 2) AS INTEGER) < 10 THEN 'skipped' ELSE 'success' END
          AS status, _source_file AS file,
          CAST(sum(CASE WHEN CAST(substring(_source_file, 18, 2) AS INTEGER) < 10 THEN 0 ELSE 1 END) AS BIGINT)
            AS rows_inserted,
          CAST(sum(CASE WHEN CAST(substring(_source_file, 18, 2) AS INTEGER) < 10 THEN 1 END) AS BIGINT)
            AS existing_rows
        FROM raw_readings GROUP BY _source_file""",
        o.RAW_READINGS,
    ),
)
def directory_ingest(spark, sf):
    """The first days are loaded before; loading the whole folder then skips them."""
    wh, folder = _new_warehouse(spark), f"{_landing(spark, sf, 'readings')}/meter_readings"
    ingest_files(wh, METER_FILES, folder, fx.FIRST_RUN, "readings_????-??-0*.csv")
    metrics = ingest_files(wh, METER_FILES, folder, fx.SECOND_RUN)
    name = F.regexp_replace("file", r"\.part\d+", "").alias("file")
    return metrics.groupBy("status", name).agg(
        F.sum("rows_inserted").alias("rows_inserted"), F.sum("existing_rows").alias("existing_rows")
    )


@register(
    "reference_ingest",
    o.sql(
        """SELECT coalesce(b.customer_id, a.customer_id) AS customer_id,
          CASE WHEN b.customer_id IS NULL THEN a.customer_name ELSE b.customer_name END AS customer_name,
          CASE WHEN b.customer_id IS NULL THEN a.tariff_type ELSE b.tariff_type END AS tariff_type,
          CASE WHEN b.customer_id IS NULL THEN a.signup_date ELSE b.signup_date END AS signup_date,
          CASE WHEN b.customer_id IS NULL THEN a.status ELSE coalesce(b.status, '') END AS status
        FROM first_snapshot a FULL JOIN second_snapshot b ON a.customer_id = b.customer_id""",
        o.RAW_CUSTOMERS, o.SNAPSHOTS,
    ),
)
def reference_ingest(spark, sf):
    """Two deliveries of customers.csv; the second updates, adds, and removes nothing."""
    wh = _new_warehouse(spark)
    for rows, run_ts in ((fx.first_snapshot, fx.FIRST_RUN), (fx.second_snapshot, fx.SECOND_RUN)):
        landing = scratch_dir(spark, "landing")
        fx.write_reference(rows(spark, sf), landing, "customers.csv", "customer_id")
        ingest_reference(wh, landing, run_ts)
    return wh.read(RAW_CUSTOMERS).drop("_loaded_at")


@register(
    "reference_meters",
    o.sql(
        """SELECT meter_id, customer_id, meter_type, install_date, coalesce(location_id, '') AS location_id, status
        FROM raw_meters WHERE customer_id IS NOT NULL""",
        o.RAW_METERS,
    ),
)
def reference_meters(spark, sf):
    """All three files; meters with a blank customer refer to nobody and are quarantined."""
    wh = _new_warehouse(spark)
    ingest_reference(wh, _landing(spark, sf, "reference"), fx.FIRST_RUN)
    return wh.read(RAW_METERS).drop("_loaded_at")


@register("reference_locations", o.sql("SELECT * FROM raw_locations", o.RAW_LOCATIONS))
def reference_locations(spark, sf):
    wh = _new_warehouse(spark)
    ingest_reference(wh, _landing(spark, sf, "reference"), fx.FIRST_RUN)
    return wh.read(RAW_LOCATIONS).drop("_loaded_at")


def _warehouse_fact(wh: Warehouse) -> DataFrame:
    rows = wh.read(FACT_CONSUMPTION).drop("consumption_id", "_stg_id", "_loaded_at")
    return with_ids(rows, wh.read(DIM_METER), wh.read(DIM_CUSTOMER), wh.read(DIM_LOCATION))


@register("run_day", o.sql(f"{_NATURAL_FACT} WHERE date_key = 20240115", *_LANDED_FACT))
def run_day_query(spark, sf):
    """One daily run, from files to fact, run twice: the repetition changes nothing."""
    wh, landing = _new_warehouse(spark), _landing(spark, sf, "reference", "readings", "weather", "telemetry")
    for run_ts in (datetime(2024, 1, 16), datetime(2024, 1, 17)):
        run_day(wh, landing, date(2024, 1, 15), run_ts)
    return _warehouse_fact(wh)


@register("run_day_shared_weather", o.sql(f"{_NATURAL_FACT} WHERE date_key = 20240115", *_LANDED_FACT))
def run_day_shared_weather(spark, sf):
    """A day without a weather file of its own takes the shared one."""
    wh, landing = _new_warehouse(spark), _landing(spark, sf, "reference", "readings")
    fx.write_landed(fx.raw_weather(spark, sf).withColumn("_source_file", F.lit("weather.csv")), landing)
    run_day(wh, landing, date(2024, 1, 15), datetime(2024, 1, 16))
    return _warehouse_fact(wh)


@register(
    "quarantined_once",
    o.sql(
        f"""SELECT 'raw.raw_meter_readings' AS source_table, split_part(reason, ':', 1) AS reason_code, count(*) AS open_rows
        FROM (SELECT {o.READING_REASON_DEFAULT} AS reason FROM raw_readings WHERE _source_file LIKE 'readings_2024-01-1%')
        WHERE reason IS NOT NULL GROUP BY 2""",
        _CSV_READINGS,
    ),
)
def quarantined_once(spark, sf):
    """Rejected rows of ten days' files, staged twice, stand in the quarantine once."""
    wh, folder = _new_warehouse(spark), f"{_landing(spark, sf, 'readings')}/meter_readings"
    ingest_files(wh, METER_FILES, folder, fx.FIRST_RUN, "readings_2024-01-1*.csv")
    batches = [r.batch_id for r in wh.read(LOAD_LEDGER).collect()]
    for run_ts in (fx.FIRST_RUN, fx.SECOND_RUN):
        stage_batches(wh, METER_FEED, batches, run_ts)
    return quality.unresolved_quarantine(wh.read(DQ_QUARANTINE))


@register("backfill", o.sql(_NATURAL_FACT, *_LANDED_FACT))
def backfill_query(spark, sf):
    wh, landing = _new_warehouse(spark), _landing(spark, sf, "reference", "readings", "weather")
    span = fx.table(spark, sf, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    backfill(wh, landing, span.lo.date(), span.hi.date(), fx.SECOND_RUN)
    return _warehouse_fact(wh)


@register(
    "stream_ingest",
    o.sql(
        "SELECT meter_id, reading_timestamp, consumption_kwh, reading_date, reading_hour FROM staged",
        _CSV_READINGS, o.STAGED,
    ),
)
def stream_ingest(spark, sf):
    """Two calls on the same folder: the second finds nothing new."""
    wh, landing = _new_warehouse(spark), _landing(spark, sf, "readings")
    checkpoint = scratch_dir(spark, "stream")
    for _ in range(2):
        incremental_ingest(wh, METER_FEED, f"{landing}/meter_readings", checkpoint, lambda: fx.SECOND_RUN)
    return wh.read(STG_READINGS).select(*READINGS.columns)


# Corrections delivered later, in files of their own: every third reading again, one kWh higher.
_LATE_READINGS = _CSV_READINGS.replace("raw_readings AS (", "first_readings AS (") + """,
raw_readings AS (SELECT * FROM first_readings UNION ALL
  SELECT id + 1000000000 AS id, meter_id, reading_timestamp,
    CAST(CAST(consumption_kwh AS DECIMAL(12,4)) + 1 AS VARCHAR) AS consumption_kwh, unit,
    replace(_source_file, '.csv', '_late.csv') AS _source_file, _loaded_at + INTERVAL 100 DAY AS _loaded_at, _batch_id
  FROM first_readings WHERE id % 3 = 0 AND TRY_CAST(consumption_kwh AS DECIMAL(12,4)) >= 0)"""


@register(
    "stream_corrections",
    o.sql(
        "SELECT meter_id, reading_timestamp, consumption_kwh, reading_date, reading_hour FROM staged",
        _LATE_READINGS, o.STAGED,
    ),
)
def stream_corrections_query(spark, sf):
    """Readings, then late corrections of a third of them, then those again under other names; each
    call starts the stream anew."""
    wh, checkpoint = _new_warehouse(spark), scratch_dir(spark, "stream")
    first = fx.raw_readings(spark, sf)
    number = F.col("consumption_kwh").try_cast("decimal(12,4)")
    late = first.filter((F.col("id") % 3 == 0) & (number >= 0)).withColumn(
        "consumption_kwh", (number + 1).cast("decimal(12,4)").cast("string")
    )
    for rows, suffix, run_ts in (
        (first, ".csv", fx.FIRST_RUN), (late, "_late.csv", fx.SECOND_RUN), (late, "_late_again.csv", datetime(2024, 3, 1))
    ):
        landing = scratch_dir(spark, "landing")
        fx.write_landed(rows.withColumn("_source_file", F.replace("_source_file", F.lit(".csv"), F.lit(suffix))), landing)
        ingest_files(wh, METER_FILES, landing, run_ts)
        stream_corrections(wh, METER_FEED, checkpoint, lambda at=run_ts: at)
    return wh.read(STG_READINGS).select(*READINGS.columns)
