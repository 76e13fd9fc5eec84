"""Dashboard aggregates over the star schema."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.keys import instant

KWH_SUM, USD_SUM = "decimal(24,4)", "decimal(24,2)"


def _kwh(condition=None):
    value = F.col("consumption_kwh") if condition is None else F.when(condition, F.col("consumption_kwh"))
    return F.coalesce(F.sum(value), F.lit(0)).cast(KWH_SUM)


def _usd():
    return F.coalesce(F.sum("cost_usd"), F.lit(0)).cast(USD_SUM)


def between_days(fact: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Literal bounds on the partition column, so other days are never listed or read."""
    if start is not None:
        fact = fact.filter(F.col("date_key") >= int(start.strftime("%Y%m%d")))
    if end is not None:
        fact = fact.filter(F.col("date_key") <= int(end.strftime("%Y%m%d")))
    return fact


def daily_customer_summary(fact: DataFrame) -> DataFrame:
    peak = F.col("is_peak_hour")
    return fact.groupBy("date_key", "customer_key").agg(
        F.count(F.lit(1)).alias("readings"),
        _kwh().alias("total_kwh"),
        _usd().alias("total_cost"),
        _kwh(peak).alias("peak_kwh"),
        _kwh(~peak).alias("offpeak_kwh"),
    )


def date_range_totals(fact: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    return between_days(fact, start, end).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("readings"),
        _kwh().alias("total_kwh"),
        _usd().alias("total_cost"),
        F.max("peak_demand_kw").alias("max_demand_kw"),
    )


def _by_dimension(fact: DataFrame, key: str) -> DataFrame:
    """Sums per surrogate key. Joining a dimension after this moves one row per key, not per reading."""
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum("consumption_kwh").alias("consumption_kwh"),
        F.sum("cost_usd").alias("cost_usd"),
    )


def customer_analysis(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Totals by segment and tariff; all versions of the dimension may be referred to."""
    customers = dim_customer.select("customer_key", "customer_id", "segment", "tariff_type")
    return (
        _by_dimension(fact, "customer_key")
        .join(customers, "customer_key")
        .groupBy("segment", "tariff_type")
        .agg(
            F.countDistinct("customer_id").alias("customers"),
            F.sum("readings").alias("readings"),
            _kwh().alias("total_kwh"),
            _usd().alias("total_cost"),
        )
    )


def regional_rollup(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Region and city totals with subtotals; ``level`` 0 city, 1 region, 3 grand total."""
    places = dim_location.select("location_key", "region", "city")
    return (
        _by_dimension(fact, "location_key")
        .join(places, "location_key")
        .rollup("region", "city")
        .agg(
            F.sum("readings").alias("readings"),
            _kwh().alias("total_kwh"),
            _usd().alias("total_cost"),
            F.grouping_id().cast("int").alias("level"),
        )
    )


def meter_series(fact: DataFrame, days: int = 7) -> DataFrame:
    """Daily series per meter with the previous stored day and a rolling sum over ``days`` calendar
    days, whether or not each has readings."""
    daily = fact.groupBy("meter_key", "date_key").agg(_kwh().alias("total_kwh"))
    series = Window.partitionBy("meter_key").orderBy("date_key")
    day_number = F.unix_date(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    rolling = Window.partitionBy("meter_key").orderBy(day_number).rangeBetween(-(days - 1), 0)
    return daily.select(
        "meter_key",
        "date_key",
        "total_kwh",
        F.lag("total_kwh").over(series).alias("previous_kwh"),
        F.sum("total_kwh").over(rolling).cast(KWH_SUM).alias("rolling_kwh"),
    )


def readings_range(stg: DataFrame, start: date, end: date, meter_ids=None) -> DataFrame:
    chosen = stg.filter(F.col("reading_date").between(F.lit(start), F.lit(end)))
    return chosen if meter_ids is None else chosen.filter(F.col("meter_id").isin(list(meter_ids)))


def weather_bands(fact: DataFrame, width: int = 5) -> DataFrame:
    """Consumption by temperature band of ``width`` degrees."""
    band = (F.floor(F.col("temperature_c") / width) * width).cast("int")
    return (
        fact.filter(F.col("temperature_c").isNotNull())
        .groupBy(band.alias("band_from_c"))
        .agg(F.count(F.lit(1)).alias("readings"), _kwh().alias("total_kwh"), _usd().alias("total_cost"))
    )


def weather_correlation(fact: DataFrame) -> DataFrame:
    pairs = fact.filter(F.col("temperature_c").isNotNull())
    return pairs.agg(
        F.count(F.lit(1)).alias("readings"),
        F.round(
            F.corr(F.col("temperature_c").cast("double"), F.col("consumption_kwh").cast("double")), 6
        ).alias("correlation"),
    )


def customer_at(dim_customer: DataFrame, moment: datetime) -> DataFrame:
    """The dimension as it stood at ``moment``."""
    at = instant(moment)
    return dim_customer.filter(
        (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    )
