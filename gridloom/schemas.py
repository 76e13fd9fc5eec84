"""Table schemas (DDL), natural keys and partition columns of the four layers."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    versioned: bool = False  # rewritten whole into a new folder, see sources.warehouse
    cluster: tuple[str, str] | None = None  # (id, moment) by which rows lie inside a partition
    open_flag: str | None = None  # of a versioned history: only rows with this flag are rewritten

    @property
    def columns(self) -> list[str]:
        return [part.strip().split(" ")[0] for part in _split_ddl(self.ddl)]


def _split_ddl(ddl: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for ch in ddl:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    return parts + [current]


_LINEAGE = "_source_file string, _file_pos bigint, _loaded_at timestamp_ntz, _batch_id string"

RAW_READINGS = Table(
    "raw/raw_meter_readings",
    f"id bigint, meter_id string, reading_timestamp string, consumption_kwh string, unit string, {_LINEAGE}",
    partition_by=("_batch_id",),
    required=("meter_id", "reading_timestamp"),
)
RAW_TELEMETRY = Table(
    "raw/raw_equipment_telemetry",
    "id bigint, equipment_id string, sensor_type string, reading_timestamp string, "
    f"sensor_value string, unit string, {_LINEAGE}",
    partition_by=("_batch_id",),
    required=("equipment_id", "reading_timestamp"),
)
RAW_WEATHER = Table(
    "raw/raw_weather_data",
    "id bigint, location_id string, observation_time string, temperature_c string, humidity_pct string, "
    f"wind_speed_ms string, cloud_cover_pct string, precipitation_mm string, {_LINEAGE}",
    partition_by=("_batch_id",),
    required=("location_id", "observation_time"),
)
RAW_CUSTOMERS = Table(
    "raw/raw_customers",
    "customer_id string, customer_name string, tariff_type string, signup_date date, status string, "
    "_loaded_at timestamp_ntz",
    keys=("customer_id",),
    required=("customer_id",),
    versioned=True,
)
RAW_METERS = Table(
    "raw/raw_meters",
    "meter_id string, customer_id string, meter_type string, install_date date, location_id string, "
    "status string, _loaded_at timestamp_ntz",
    keys=("meter_id",),
    required=("meter_id",),
    versioned=True,
)
RAW_LOCATIONS = Table(
    "raw/raw_locations",
    "location_id string, address string, city string, region string, country string, "
    "latitude decimal(10,7), longitude decimal(10,7), timezone string, _loaded_at timestamp_ntz",
    keys=("location_id",),
    required=("location_id",),
    versioned=True,
)

STG_READINGS = Table(
    "staging/stg_meter_readings",
    "meter_reading_id bigint, meter_id string, reading_timestamp timestamp_ntz, "
    "consumption_kwh decimal(12,4), reading_hour smallint, _raw_id bigint, "
    "_loaded_at timestamp_ntz, _batch_id string, reading_date date",
    keys=("meter_id", "reading_timestamp"),
    partition_by=("reading_date",),
    required=("meter_id", "reading_timestamp", "consumption_kwh", "reading_date", "reading_hour"),
    cluster=("meter_id", "reading_timestamp"),
)
STG_WEATHER = Table(
    "staging/stg_weather_data",
    "weather_id bigint, location_id string, observation_time timestamp_ntz, observation_hour smallint, "
    "temperature_c decimal(5,1), humidity_pct decimal(5,1), wind_speed_ms decimal(5,1), "
    "cloud_cover_pct decimal(5,1), precipitation_mm decimal(6,2), _raw_id bigint, "
    "_loaded_at timestamp_ntz, _batch_id string, observation_date date",
    keys=("location_id", "observation_time"),
    partition_by=("observation_date",),
    required=("location_id", "observation_time", "observation_date", "observation_hour"),
)
STG_TELEMETRY = Table(
    "staging/stg_equipment_telemetry",
    "telemetry_id bigint, equipment_id string, sensor_type string, reading_timestamp timestamp_ntz, "
    "sensor_value decimal(12,4), unit string, _raw_id bigint, _loaded_at timestamp_ntz, "
    "_batch_id string, reading_date date",
    keys=("equipment_id", "sensor_type", "reading_timestamp"),
    partition_by=("reading_date",),
    required=("equipment_id", "sensor_type", "reading_timestamp", "sensor_value", "unit"),
)

READING_STATES = Table(
    "dq/reading_states",
    "meter_id string, sketch binary, n bigint, total double, squares double, least double, greatest double, "
    "reading_date date",
    keys=("meter_id", "reading_date"),
    partition_by=("reading_date",),
)

DIM_DATE = Table(
    "analytics/dim_date",
    "date_key int, full_date date, year smallint, quarter smallint, month smallint, month_name string, "
    "week_of_year smallint, day_of_month smallint, day_of_week smallint, day_name string, "
    "is_weekend boolean, is_holiday boolean, fiscal_year smallint, fiscal_quarter smallint",
    keys=("date_key",),
    versioned=True,
)
DIM_TIME = Table(
    "analytics/dim_time",
    "time_key int, hour smallint, minute smallint, time_of_day string, period_name string, "
    "is_peak boolean, is_business_hr boolean",
    keys=("time_key",),
    versioned=True,
)
DIM_CUSTOMER = Table(
    "analytics/dim_customer",
    "customer_key int, customer_id string, customer_name string, tariff_type string, segment string, "
    "status string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean",
    keys=("customer_key",),
    versioned=True,
    open_flag="is_current",
)
DIM_LOCATION = Table(
    "analytics/dim_location",
    "location_key int, location_id string, address string, city string, region string, country string, "
    "latitude decimal(10,7), longitude decimal(10,7), timezone string",
    keys=("location_id",),
    versioned=True,
)
DIM_METER = Table(
    "analytics/dim_meter",
    "meter_key int, meter_id string, meter_type string, install_date date, status string, "
    "customer_key int, location_key int",
    keys=("meter_id",),
    versioned=True,
)
FACT_CONSUMPTION = Table(
    "analytics/fact_consumption",
    "consumption_id bigint, meter_key int, customer_key int, location_key int, time_key int, "
    "consumption_kwh decimal(12,4), cost_usd decimal(10,2), peak_demand_kw decimal(10,2), "
    "temperature_c decimal(5,1), is_peak_hour boolean, is_weekend boolean, _stg_id bigint, "
    "_loaded_at timestamp_ntz, date_key int",
    keys=("meter_key", "date_key", "time_key"),
    partition_by=("date_key",),
    required=("meter_key", "customer_key", "location_key", "date_key", "time_key", "consumption_kwh"),
)

MART_TOTALS = Table(
    "analytics/mart_totals",
    "customer_key int, location_key int, readings bigint, consumption_kwh decimal(38,4), cost_usd decimal(38,2)",
    keys=("customer_key", "location_key"),
    versioned=True,
)
MART_DAYS = Table(
    "analytics/mart_days",
    "date_key int, customer_key int, location_key int, readings bigint, consumption_kwh decimal(38,4), "
    "cost_usd decimal(38,2), peak_kwh decimal(38,4)",
    keys=("date_key", "customer_key", "location_key"),
    partition_by=("date_key",),
)

DQ_CHECK_RESULTS = Table(
    "dq/dq_check_results",
    "check_name string, table_name string, passed boolean, failed_count bigint, total_count bigint, "
    "severity string, details string, execution_time_ms int, created_at timestamp_ntz, execution_date date",
    partition_by=("execution_date",),
)
DQ_QUARANTINE = Table(
    "dq/dq_quarantine",
    "source_id bigint, reason string, raw_data string, quarantined_at timestamp_ntz, resolved boolean, "
    "resolved_at timestamp_ntz, resolution_note string, source_table string, _batch_id string",
    keys=("source_table", "_batch_id", "source_id"),
    partition_by=("source_table", "_batch_id"),
)
DQ_PIPELINE_METRICS = Table(
    "dq/dq_pipeline_metrics",
    "pipeline_name string, metric_name string, metric_value decimal(15,4), details string, "
    "created_at timestamp_ntz, execution_date date",
    partition_by=("execution_date",),
)
LOAD_LEDGER = Table(
    "dq/load_ledger",
    "source_table string, source_file string, batch_id string, status string, rows_read bigint, "
    "rows_inserted bigint, max_id bigint, duration_seconds decimal(12,2), loaded_at timestamp_ntz",
    keys=("source_table", "source_file"),
)
