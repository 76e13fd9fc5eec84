"""Raw text rows to typed, de-duplicated staging rows.

``mode="default"`` quarantines every row that cannot be staged. ``mode="reference"``
keeps the looser contract: NULL readings vanish, and text that has the right shape
but cannot be cast fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.tariff import demand_fits
from gridloom.functions.text import is_negative_number, looks_like_date, looks_like_number
from gridloom.operators.latest import keep_latest
from gridloom.operators.quarantine import Rule, validate_and_quarantine

MODES = ("default", "reference")


def only_batches(raw: DataFrame, batch_ids: str | Sequence[str] | None) -> DataFrame:
    """Raw tables are partitioned by batch, so this filter prunes directories."""
    if batch_ids is None:
        return raw
    wanted = [batch_ids] if isinstance(batch_ids, str) else list(batch_ids)
    return raw.filter(F.col("_batch_id").isin(wanted))


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def _caster(mode: str) -> Callable[[Column, str], Column]:
    return Column.try_cast if mode == "default" else Column.cast


def _uncastable(name: str, to_type: str) -> Rule:
    failing = F.col(name).isNotNull() & F.col(name).try_cast(to_type).isNull()
    return Rule(f"uncastable_{name}", failing, name)


def _null_key(name: str) -> Rule:
    return Rule(f"null_{name}", F.col(name).isNull(), name)


def _raw_order(raw: DataFrame) -> list[str]:
    """Last loaded wins; inside one load the later file, then the later row."""
    return [c for c in ("_loaded_at", "_source_file", "_file_pos", "_raw_id") if c in raw.columns or c == "_raw_id"]


def _carried(raw: DataFrame) -> list[str]:
    return [c for c in ("_loaded_at", "_source_file", "_file_pos", "_batch_id") if c in raw.columns]


@dataclass(frozen=True)
class Stage:
    """How one raw table is staged; the three tables differ only in these parts."""

    source_table: str
    keys: tuple[str, ...]
    snapshot: tuple[str, ...]
    rules: Callable[[str], list[Rule]]
    dropped: Callable[[], Column]
    typed: Callable[[Callable[[Column, str], Column]], list[Column]]
    columns: tuple[str, ...]

    def split(self, raw: DataFrame, batch_ids=None, run_ts: datetime | None = None, mode: str = "default"):
        _check(mode)
        return validate_and_quarantine(
            only_batches(raw, batch_ids),
            self.rules(mode),
            self.source_table,
            "id",
            self.snapshot,
            run_ts,
            self.dropped() if mode == "reference" else None,
        )

    def typed_rows(self, valid: DataFrame, mode: str = "default") -> DataFrame:
        return valid.select(
            *self.typed(_caster(mode)), F.col("id").cast("bigint").alias("_raw_id"), *_carried(valid)
        )

    def stage(self, raw: DataFrame, batch_ids=None, mode: str = "default") -> DataFrame:
        valid, _ = self.split(raw, batch_ids, None, mode)
        latest = keep_latest(self.typed_rows(valid, mode), self.keys, _raw_order(valid))
        return latest.select(*self.columns, "_raw_id", "_batch_id")


# Table names, columns, types and reason codes below are fixed values.

# --- meter readings -------------------------------------------------------


def reading_rules(mode: str = "default") -> list[Rule]:
    ts, kwh = F.col("reading_timestamp"), F.col("consumption_kwh")
    bad_time = ~looks_like_date(ts)
    rules = [
        Rule("invalid_consumption_format", ~looks_like_number(kwh), "consumption_kwh"),
        Rule("negative_consumption", is_negative_number(kwh), "consumption_kwh"),
    ]
    if mode == "reference":
        return [Rule("invalid_timestamp", bad_time, "reading_timestamp"), *rules]
    number = kwh.try_cast("decimal(12,4)")
    return [
        _null_key("meter_id"),
        Rule("invalid_timestamp", ts.isNull() | bad_time, "reading_timestamp"),
        Rule("null_consumption", kwh.isNull(), "consumption_kwh"),
        *rules,
        _uncastable("reading_timestamp", "timestamp_ntz"),
        _uncastable("consumption_kwh", "decimal(12,4)"),
        Rule("demand_out_of_range", number.isNotNull() & ~demand_fits(number), "consumption_kwh"),
    ]


def _typed_readings(cast) -> list[Column]:
    moment = cast(F.col("reading_timestamp"), "timestamp_ntz")
    return [
        F.col("meter_id"),
        moment.alias("reading_timestamp"),
        cast(F.col("consumption_kwh"), "decimal(12,4)").alias("consumption_kwh"),
        F.to_date(moment).alias("reading_date"),
        F.hour(moment).cast("smallint").alias("reading_hour"),
    ]


READINGS = Stage(
    source_table="raw.raw_meter_readings",
    keys=("meter_id", "reading_timestamp"),
    snapshot=("meter_id", "reading_timestamp", "consumption_kwh"),
    rules=reading_rules,
    dropped=lambda: F.col("reading_timestamp").isNull() | F.col("consumption_kwh").isNull(),
    typed=_typed_readings,
    columns=("meter_id", "reading_timestamp", "consumption_kwh", "reading_date", "reading_hour"),
)


# --- weather --------------------------------------------------------------

_WEATHER_TYPES = {
    "temperature_c": "decimal(5,1)",
    "humidity_pct": "decimal(5,1)",
    "wind_speed_ms": "decimal(5,1)",
    "cloud_cover_pct": "decimal(5,1)",
    "precipitation_mm": "decimal(6,2)",
}


def weather_rules(mode: str = "default") -> list[Rule]:
    """Only time, temperature and humidity have shape tests."""
    seen = F.col("observation_time")
    rules = [
        Rule("invalid_temperature_format", ~looks_like_number(F.col("temperature_c")), "temperature_c"),
        Rule("invalid_humidity_format", ~looks_like_number(F.col("humidity_pct")), "humidity_pct"),
    ]
    if mode == "reference":
        return [Rule("invalid_observation_time", ~looks_like_date(seen), "observation_time"), *rules]
    return [
        _null_key("location_id"),
        Rule("invalid_observation_time", seen.isNull() | ~looks_like_date(seen), "observation_time"),
        *rules,
        _uncastable("observation_time", "timestamp_ntz"),
        *[_uncastable(name, to_type) for name, to_type in _WEATHER_TYPES.items()],
    ]


def _typed_weather(cast) -> list[Column]:
    moment = cast(F.col("observation_time"), "timestamp_ntz")
    return [
        F.col("location_id"),
        moment.alias("observation_time"),
        F.to_date(moment).alias("observation_date"),
        F.hour(moment).cast("smallint").alias("observation_hour"),
        *[cast(F.col(name), to_type).alias(name) for name, to_type in _WEATHER_TYPES.items()],
    ]


WEATHER = Stage(
    source_table="raw.raw_weather_data",
    keys=("location_id", "observation_time"),
    snapshot=("location_id", "observation_time", "temperature_c", "humidity_pct"),
    rules=weather_rules,
    dropped=lambda: F.col("observation_time").isNull(),
    typed=_typed_weather,
    columns=("location_id", "observation_time", "observation_date", "observation_hour", *_WEATHER_TYPES),
)


# --- equipment telemetry --------------------------------------------------


def telemetry_rules(mode: str = "default") -> list[Rule]:
    ts, value = F.col("reading_timestamp"), F.col("sensor_value")
    bad_value = Rule("invalid_sensor_value_format", ~looks_like_number(value), "sensor_value")
    if mode == "reference":
        return [Rule("invalid_timestamp", ~looks_like_date(ts), "reading_timestamp"), bad_value]
    return [
        _null_key("equipment_id"),
        Rule("invalid_timestamp", ts.isNull() | ~looks_like_date(ts), "reading_timestamp"),
        _null_key("sensor_type"),
        Rule("null_sensor_value", value.isNull(), "sensor_value"),
        bad_value,
        _uncastable("reading_timestamp", "timestamp_ntz"),
        _uncastable("sensor_value", "decimal(12,4)"),
    ]


def _typed_telemetry(cast) -> list[Column]:
    return [
        F.col("equipment_id"),
        F.col("sensor_type"),
        cast(F.col("reading_timestamp"), "timestamp_ntz").alias("reading_timestamp"),
        cast(F.col("sensor_value"), "decimal(12,4)").alias("sensor_value"),
        F.coalesce(F.col("unit"), F.lit("N/A")).alias("unit"),
    ]


TELEMETRY = Stage(
    source_table="raw.raw_equipment_telemetry",
    keys=("equipment_id", "sensor_type", "reading_timestamp"),
    snapshot=("equipment_id", "sensor_type", "reading_timestamp", "sensor_value"),
    rules=telemetry_rules,
    dropped=lambda: F.col("reading_timestamp").isNull(),
    typed=_typed_telemetry,
    columns=("equipment_id", "sensor_type", "reading_timestamp", "sensor_value", "unit"),
)


def stage_meter_readings(raw: DataFrame, batch_ids=None, mode: str = "default") -> DataFrame:
    return READINGS.stage(raw, batch_ids, mode)


def stage_weather(raw: DataFrame, batch_ids=None, mode: str = "default") -> DataFrame:
    return WEATHER.stage(raw, batch_ids, mode)


def stage_telemetry(raw: DataFrame, batch_ids=None, mode: str = "default") -> DataFrame:
    return TELEMETRY.stage(raw, batch_ids, mode)
