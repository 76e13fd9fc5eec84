"""Data-quality checks, metrics and quarantine upkeep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.keys import instant
from gridloom.functions.text import strip
from gridloom.operators.merge import duplicate_keys
from gridloom.operators.quantiles import group_quantiles, join_groups, merge_states, state_moments, state_quantiles


@dataclass(frozen=True)
class Check:
    """``failing`` is true for a bad row; the check passes while at most ``allowed`` rows fail."""

    name: str
    failing: Column
    severity: str = "error"
    allowed: int = 0
    details: str | None = None


def blank(column: str) -> Column:
    return F.col(column).isNull() | (strip(F.col(column).cast("string")) == "")


def not_blank(column: str, severity: str = "error") -> Check:
    return Check(f"not_blank_{column}", blank(column), severity, details=f"{column} is NULL or blank")


def not_null(column: str, severity: str = "error") -> Check:
    return Check(f"not_null_{column}", F.col(column).isNull(), severity, details=f"{column} is NULL")


def in_range(column: str, low, high, severity: str = "warning") -> Check:
    outside = F.col(column).isNotNull() & ~F.col(column).between(low, high)
    return Check(f"range_{column}", outside, severity, details=f"{column} outside [{low}, {high}]")


def max_length(column: str, length: int, severity: str = "error") -> Check:
    return Check(f"length_{column}", F.length(column) > length, severity, details=f"{column} longer than {length}")


def count_blanks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failed_count, total_count), one scan for all columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_count"), *[F.count_if(blank(c)).alias(c) for c in columns]
    )
    return counts.unpivot(["total_count"], list(columns), "column_name", "failed_count").select(
        "column_name", "failed_count", "total_count"
    )


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeated keys and the rows beyond the first; grouping combines copies before the shuffle."""
    return duplicate_keys(df, keys).agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def run_checks(
    df: DataFrame, checks: Sequence[Check], table_name: str, execution_date: date
) -> DataFrame:
    """Check-result rows from one aggregate pass over ``df``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(c.failing).alias(f"_failed_{i}") for i, c in enumerate(checks)],
    )
    results = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check_name"),
                (F.col(f"_failed_{i}") <= c.allowed).alias("passed"),
                F.col(f"_failed_{i}").alias("failed_count"),
                F.col("_total").alias("total_count"),
                F.lit(c.severity).alias("severity"),
                F.lit(c.details).cast("string").alias("details"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(results)).select(
        "check_name",
        F.lit(table_name).alias("table_name"),
        F.lit(execution_date).cast("date").alias("execution_date"),
        "passed", "failed_count", "total_count", "severity", "details",
    )


def duplicate_check(df: DataFrame, keys: Sequence[str], table_name: str, execution_date: date) -> DataFrame:
    """The uniqueness check in the same shape as :func:`run_checks`."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("failed_count"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_count"),
    ).select(
        F.lit("unique_" + "_".join(keys)).alias("check_name"),
        F.lit(table_name).alias("table_name"),
        F.lit(execution_date).cast("date").alias("execution_date"),
        (F.col("failed_count") == 0).alias("passed"),
        "failed_count", "total_count",
        F.lit("error").alias("severity"),
        F.lit("key " + ", ".join(keys)).alias("details"),
    )


def metric_rows(
    df: DataFrame, metrics: Mapping[str, Column], pipeline_name: str, execution_date: date
) -> DataFrame:
    """(pipeline_name, execution_date, metric_name, metric_value) from one aggregate pass."""
    values = df.agg(*[m.cast("decimal(15,4)").alias(name) for name, m in metrics.items()])
    return values.unpivot([], list(metrics), "metric_name", "metric_value").select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(execution_date).cast("date").alias("execution_date"),
        "metric_name", "metric_value",
    )


def outlier_bounds(
    df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.5, exact: bool = True
) -> DataFrame:
    """Quartiles, fences, mean and deviation per group.

    ``exact`` uses the bounded selection of :mod:`gridloom.operators.quantiles`;
    otherwise ``percentile_approx`` is enough. :func:`period_bounds` works from kept states.
    """
    number = F.col(value).cast("double")
    moments = [F.avg(number).alias("mean"), F.stddev_samp(number).alias("deviation")]
    if exact:
        quartiles = group_quantiles(df, keys, value, {"q1": 0.25, "q3": 0.75})
        bounds = join_groups(df.groupBy(*keys).agg(*moments), quartiles, keys)
    else:
        both = F.percentile_approx(number, [0.25, 0.75], 10000)
        bounds = df.groupBy(*keys).agg(*moments, both.alias("_q")).withColumns(
            {"q1": F.col("_q")[0], "q3": F.col("_q")[1]}
        ).drop("_q")
    return _with_fences(bounds, factor)


def _with_fences(bounds: DataFrame, factor: float) -> DataFrame:
    spread = F.col("q3") - F.col("q1")
    return bounds.withColumns(
        {"low": F.col("q1") - factor * spread, "high": F.col("q3") + factor * spread}
    )


def period_bounds(states: DataFrame, keys: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Quartiles, fences, mean and deviation per group from its kept states; no reading is read.

    ``states`` are those of the period, for instance of its days.
    """
    merged = state_moments(state_quantiles(merge_states(states, keys), {"q1": 0.25, "q3": 0.75}))
    return _with_fences(merged, factor).select(*keys, "n", "q1", "q3", "low", "high", "mean", "deviation")


def flag_outliers(
    df: DataFrame, keys: Sequence[str], value: str, factor: float = 1.5, z_limit: float = 3.0,
    exact: bool = True,
) -> DataFrame:
    """Rows outside the IQR fences or beyond ``z_limit`` deviations, with both verdicts."""
    bounds = outlier_bounds(df, keys, value, factor, exact)
    number = F.col(value).cast("double")
    z = (number - F.col("mean")) / F.nullif(F.col("deviation"), F.lit(0.0))
    judged = join_groups(df, bounds, keys).withColumns(
        {
            "iqr_outlier": (number < F.col("low")) | (number > F.col("high")),
            "z_outlier": F.coalesce(F.abs(z) > z_limit, F.lit(False)),
        }
    )
    return judged.filter("iqr_outlier OR z_outlier").select(*df.columns, "iqr_outlier", "z_outlier")


def reason_code() -> Column:
    return F.substring_index("reason", ":", 1)


def unresolved_quarantine(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.filter(~F.col("resolved"))
        .groupBy("source_table", reason_code().alias("reason_code"))
        .agg(F.count(F.lit(1)).alias("open_rows"))
    )


def resolve_quarantine(
    quarantine: DataFrame, condition: Column, note: str, resolved_at: datetime
) -> DataFrame:
    """Mark the open rows that meet ``condition`` as resolved; all others stay as they are."""
    hit = ~F.col("resolved") & F.coalesce(condition, F.lit(False))
    return quarantine.withColumns(
        {
            "resolved": F.col("resolved") | hit,
            "resolved_at": F.when(hit, instant(resolved_at)).otherwise(F.col("resolved_at")),
            "resolution_note": F.when(hit, F.lit(note)).otherwise(F.col("resolution_note")),
        }
    )


def loaded_on(df: DataFrame, day: date) -> DataFrame:
    """A half-open range rather than a cast, so that the scan can use it."""
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col("_loaded_at") >= start) & (F.col("_loaded_at") < end))


def row_conservation(raw: DataFrame, stage, mode: str = "default") -> DataFrame:
    """raw = staged + quarantined + duplicates + dropped, as one row.

    Two aggregates: verdicts per row, and distinct keys among the valid rows.
    """
    valid, rejected = stage.split(raw, mode=mode)
    tallies = (
        raw.select(F.lit("raw_rows").alias("part"))
        .unionByName(valid.select(F.lit("valid_rows").alias("part")))
        .unionByName(rejected.select(F.lit("quarantined_rows").alias("part")))
        .unionByName(stage.typed_rows(valid, mode).select(*stage.keys).distinct().select(
            F.lit("staged_rows").alias("part")))
    )
    parts = ("raw_rows", "staged_rows", "quarantined_rows", "valid_rows")
    counts = tallies.agg(*[F.count_if(F.col("part") == p).alias(p) for p in parts])
    dropped = F.col("raw_rows") - F.col("valid_rows") - F.col("quarantined_rows")
    duplicates = F.col("valid_rows") - F.col("staged_rows")
    sound = (dropped >= 0) & (duplicates >= 0)
    if mode == "default":
        sound = sound & (dropped == 0)
    return counts.select(
        "raw_rows", "staged_rows", "quarantined_rows",
        duplicates.alias("duplicate_rows"),
        dropped.alias("dropped_rows"),
        sound.alias("balanced"),
    )
