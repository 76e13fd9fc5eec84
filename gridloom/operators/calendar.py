"""Calendar dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.keys import date_key

FIRST_DAY = date(2010, 1, 1)
LAST_DAY = date(2030, 12, 31)
NAME_WIDTH = 9


def build_dim_date(
    spark: SparkSession, start: date = FIRST_DAY, end: date = LAST_DAY, pad: bool = False
) -> DataFrame:
    """One row per day; ``day_of_week`` 0 is Monday, weeks are ISO weeks.

    ``pad`` fills month and day names with blanks to nine characters.
    """
    day = F.col("full_date")
    month_name, day_name = F.date_format(day, "MMMM"), F.date_format(day, "EEEE")
    if pad:
        month_name, day_name = F.rpad(month_name, NAME_WIDTH, " "), F.rpad(day_name, NAME_WIDTH, " ")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        month_name.alias("month_name"),
        F.weekofyear(day).cast("smallint").alias("week_of_year"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        F.weekday(day).cast("smallint").alias("day_of_week"),
        day_name.alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.year(day).cast("smallint").alias("fiscal_year"),
        F.quarter(day).cast("smallint").alias("fiscal_quarter"),
    )


def build_dim_time(spark: SparkSession, step_minutes: int = 15) -> DataFrame:
    """One row per slot of the day: every hour paired with every step inside it."""
    if 60 % step_minutes:
        raise ValueError("step_minutes must divide 60")
    hour, minute = F.col("hour"), F.col("minute")
    slots = spark.range(24).select(
        F.col("id").cast("smallint").alias("hour"),
        F.explode(F.sequence(F.lit(0), F.lit(60 - step_minutes), F.lit(step_minutes))).alias("minute"),
    )
    return slots.select(
        (hour * 100 + minute).cast("int").alias("time_key"),
        hour,
        minute.cast("smallint").alias("minute"),
        F.format_string("%02d:%02d:00", hour, minute).alias("time_of_day"),
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 16), "afternoon")
        .when(hour.between(17, 21), "evening")
        .otherwise("night")
        .alias("period_name"),
        hour.between(7, 20).alias("is_peak"),
        hour.between(9, 16).alias("is_business_hr"),
    )
