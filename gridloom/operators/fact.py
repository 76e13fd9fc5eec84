"""Star-join build of the consumption fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.keys import date_key, time_key
from gridloom.functions.tariff import TARIFF_RATES, energy_cost, peak_demand, tariff_rate
from gridloom.operators.merge import merge_upsert
from gridloom.operators.skew import heavy_keys, salted_join
from gridloom.operators.staging import only_batches

GRAIN = ("meter_key", "date_key", "time_key")
# On a conflict the stored customer_key and location_key stay.
FACT_UPDATE_COLS = (
    "consumption_kwh", "cost_usd", "peak_demand_kw", "temperature_c",
    "is_peak_hour", "is_weekend", "_stg_id",
)


WEATHER_KEYS = ("location_id", "reading_date", "reading_hour")


def hot_hours_of(stg: DataFrame, profile: DataFrame, share: float = 0.05) -> list[int]:
    """Places and hours with at least ``share`` of the readings, by one pass with a sketch."""
    return heavy_keys(stg.join(profile.select("meter_id", "location_id"), "meter_id"), WEATHER_KEYS, share)


def hourly_weather(weather: DataFrame) -> DataFrame:
    """The latest observation of each location and hour, as a hash aggregate with map-side partials."""
    return weather.groupBy("location_id", "observation_date", "observation_hour").agg(
        F.max_by("temperature_c", "observation_time").alias("temperature_c")
    )


def meter_profile(dim_meter: DataFrame, dim_customer: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Meters with a current customer and a location, joined once among the dimensions.

    The readings then need one join on ``meter_id`` instead of three.
    """
    customers = dim_customer.filter("is_current").select("customer_key", "tariff_type")
    locations = dim_location.select("location_key", "location_id")
    return (
        dim_meter.select("meter_id", "meter_key", "customer_key", "location_key")
        .join(customers, "customer_key")
        .join(locations, "location_key")
        .select("meter_id", "meter_key", "customer_key", "location_key", "location_id", "tariff_type")
    )


def build_fact_consumption(
    stg: DataFrame,
    profile: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
    weather: DataFrame | None,
    batch_ids=None,
    rates: Mapping[tuple[str, bool], Decimal] = TARIFF_RATES,
    stg_id: str = "_raw_id",
    hot_hours: Sequence[int] = (),
) -> DataFrame:
    """One row per (meter, day, quarter-hour slot).

    ``hot_hours`` are the places and hours that hold much of all readings, as found by
    :func:`hot_hours_of`; their readings meet the weather in several tasks.

    Only the calendar carries broadcast hints: it holds one row per day and one per slot
    of a day, and its few keys would make a hopeless shuffle. Every other side is
    broadcast when Spark finds it under the session's threshold and shuffled with skew
    splitting when not.
    The closing aggregate keeps the last reading of a slot. Its output is already
    partitioned on the fact's grain, so a following merge does not shuffle it again.
    """
    moment = F.col("reading_timestamp")
    readings = only_batches(stg, batch_ids).select(
        "meter_id",
        moment,
        "reading_date",
        "reading_hour",
        date_key(F.col("reading_date")).alias("date_key"),
        time_key(moment).alias("time_key"),
        "consumption_kwh",
        F.col(stg_id).alias("_stg_id"),
    )
    days = dim_date.select("date_key", "is_weekend")
    slots = dim_time.select("time_key", F.col("is_peak").alias("is_peak_hour"))
    # The calendar first: it drops rows off the grid before any side can be shuffled.
    placed = readings.join(F.broadcast(days), "date_key").join(F.broadcast(slots), "time_key")
    joined = placed.join(profile, "meter_id")
    if weather is None:
        joined = joined.withColumn("temperature_c", F.lit(None).cast("decimal(5,1)"))
    else:
        hourly = hourly_weather(weather).select(
            "location_id",
            F.col("observation_date").alias("reading_date"),
            F.col("observation_hour").alias("reading_hour"),
            "temperature_c",
        )
        joined = salted_join(joined, hourly, WEATHER_KEYS, hot_hours)
    priced = joined.withColumn("_rate", tariff_rate(F.col("tariff_type"), F.col("is_peak_hour"), rates))
    # Everything but the reading itself depends on the grain alone.
    fixed = ("customer_key", "location_key", "temperature_c", "is_peak_hour", "is_weekend", "_rate")
    per_slot = priced.groupBy(*GRAIN).agg(
        *[F.first(c).alias(c) for c in fixed],
        F.max_by("consumption_kwh", "reading_timestamp").alias("consumption_kwh"),
        F.max_by("_stg_id", "reading_timestamp").alias("_stg_id"),
    )
    kwh = F.col("consumption_kwh")
    return per_slot.select(
        "meter_key", "customer_key", "location_key", "date_key", "time_key", "consumption_kwh",
        energy_cost(kwh, F.col("_rate")).alias("cost_usd"),
        peak_demand(kwh).alias("peak_demand_kw"),
        "temperature_c", "is_peak_hour", "is_weekend", "_stg_id",
    )


def upsert_fact(target: DataFrame, rows: DataFrame, update_cols=FACT_UPDATE_COLS) -> DataFrame:
    touched = [c for c in ("_loaded_at",) if c in target.columns]
    return merge_upsert(target, rows, GRAIN, update_cols, touch_cols=touched)
