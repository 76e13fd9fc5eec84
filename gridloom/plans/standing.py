"""Dashboard totals that are kept, and brought up to date by the days that changed.

``MART_DAYS`` holds the sums of each day by customer and location, ``MART_TOTALS`` their totals.
A refresh sums the touched days anew, adds the sums and takes the old ones of those days away.
Nothing else of the fact is read, whatever its size. The days' sums are appended under the
number of the version of the totals that counts them, so both become visible in one step and a
refresh that fails or is repeated changes nothing twice. Of a day that was summed more than once
the last sums hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.marts import KWH_SUM, USD_SUM
from gridloom.schemas import FACT_CONSUMPTION, MART_DAYS, MART_TOTALS
from gridloom.sources.warehouse import Warehouse

SUMS = ("readings", "consumption_kwh", "cost_usd")
GROUP = ("customer_key", "location_key")


def day_sums(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key", *GROUP).agg(
        F.count(F.lit(1)).alias("readings"),
        F.coalesce(F.sum("consumption_kwh"), F.lit(0)).cast("decimal(38,4)").alias("consumption_kwh"),
        F.coalesce(F.sum("cost_usd"), F.lit(0)).cast("decimal(38,2)").alias("cost_usd"),
        F.coalesce(F.sum(F.when(F.col("is_peak_hour"), F.col("consumption_kwh"))), F.lit(0)).cast("decimal(38,4)").alias("peak_kwh"),
    )


def added_totals(totals: DataFrame, new: DataFrame, old: DataFrame) -> DataFrame:
    """``totals`` with the sums of ``new`` days added and those of ``old`` ones taken away; groups of
    which nothing is left go."""
    signed = [totals.select(*GROUP, *SUMS), new.select(*GROUP, *SUMS)]
    signed.append(old.select(*GROUP, *[(-F.col(c)).alias(c) for c in SUMS]))
    rows = signed[0].unionByName(signed[1]).unionByName(signed[2])
    kinds = {f.name: f.dataType for f in totals.schema}
    return rows.groupBy(*GROUP).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in SUMS]).filter("readings <> 0")


def stored_days(wh: Warehouse, keys: Sequence[int] | None = None) -> DataFrame:
    """The sums in force of the given days, or of all."""
    rows = wh.read_beside(MART_TOTALS, "days", MART_DAYS)
    if keys is not None:
        rows = rows.filter(F.col("date_key").isin(list(keys)))
    # A day's rows of one refresh hold or fall together; a day without rows left one that says so.
    last = F.broadcast(rows.groupBy("date_key").agg(F.max("v").alias("v")))  # a row a day
    return rows.join(last, ["date_key", "v"], "left_semi").filter("readings > 0").select(*MART_DAYS.columns)


def refresh_totals(wh: Warehouse, days: Sequence[date]) -> None:
    """Bring the standing totals up to date with the touched days of the fact."""
    if not days:
        return
    keys = sorted({int(d.strftime("%Y%m%d")) for d in days})
    new = day_sums(wh.read(FACT_CONSUMPTION).filter(F.col("date_key").isin(keys)))
    # One empty row a day: it outdates older sums of a day that has lost all its rows.
    marks = wh.spark.createDataFrame([(k,) for k in keys], "date_key int").select(
        "date_key", *[F.lit(None).cast("int").alias(c) for c in GROUP], F.lit(0).cast("bigint").alias("readings"),
        *[F.lit(0).alias(c) for c in ("consumption_kwh", "cost_usd", "peak_kwh")],
    )
    totals = added_totals(wh.read(MART_TOTALS), new, stored_days(wh, keys))
    wh.replace_beside(MART_TOTALS, totals, "days", MART_DAYS, new.unionByName(marks))


# --- the marts from what is kept ---------------------------------------------------


def _kwh(column: str = "consumption_kwh"):
    return F.sum(column).cast(KWH_SUM)


def _usd():
    return F.sum("cost_usd").cast(USD_SUM)


def standing_daily_summary(wh: Warehouse) -> DataFrame:
    """:func:`marts.daily_customer_summary` from the kept sums of the days."""
    return stored_days(wh).groupBy("date_key", "customer_key").agg(
        F.sum("readings").alias("readings"), _kwh().alias("total_kwh"), _usd().alias("total_cost"),
        _kwh("peak_kwh").alias("peak_kwh"), (_kwh() - _kwh("peak_kwh")).cast(KWH_SUM).alias("offpeak_kwh"),
    )


def standing_customer_analysis(wh: Warehouse, dim_customer: DataFrame) -> DataFrame:
    customers = dim_customer.select("customer_key", "customer_id", "segment", "tariff_type")
    return wh.read(MART_TOTALS).join(customers, "customer_key").groupBy("segment", "tariff_type").agg(
        F.countDistinct("customer_id").alias("customers"), F.sum("readings").alias("readings"),
        _kwh().alias("total_kwh"), _usd().alias("total_cost"),
    )


def standing_regional_rollup(wh: Warehouse, dim_location: DataFrame) -> DataFrame:
    places = dim_location.select("location_key", "region", "city")
    return wh.read(MART_TOTALS).join(places, "location_key").rollup("region", "city").agg(
        F.sum("readings").alias("readings"), _kwh().alias("total_kwh"), _usd().alias("total_cost"),
        F.grouping_id().cast("int").alias("level"),
    )
