"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


def assign_keys(
    new_rows: DataFrame,
    existing: DataFrame,
    key_col: str,
    natural_key: Sequence[str],
    buckets: int = BUCKETS,
) -> DataFrame:
    """Number ``new_rows`` from ``max(existing.key_col) + 1`` without gaps.

    Rows are ranked inside hash buckets of their (unique) natural key; a bucket's
    offset is the running total of the buckets before it. Only the totals, at most
    ``buckets`` rows, are ordered in one place. The stored maximum enters as bucket
    -1, so it needs neither a driver round trip nor a cross join.
    """
    bucket = F.pmod(F.xxhash64(*natural_key), F.lit(buckets)).cast("int")
    placed = new_rows.drop(key_col).withColumn("_bucket", bucket)
    totals = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    base = existing.agg(
        F.lit(-1).alias("_bucket"), F.coalesce(F.max(key_col), F.lit(0)).cast("bigint").alias("_n")
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        base.unionByName(totals)
        .withColumn("_offset", F.sum("_n").over(before))
        .filter("_bucket >= 0")
        .select("_bucket", "_offset")
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(*natural_key)
    numbered = (
        placed.withColumn("_rank", F.row_number().over(in_bucket))
        .join(F.broadcast(offsets), "_bucket")  # at most `buckets` rows
        .withColumn(key_col, (F.col("_offset") + F.col("_rank")).cast("int"))
    )
    columns = new_rows.columns if key_col in new_rows.columns else [key_col, *new_rows.columns]
    return numbered.select(*columns)


def number_settled(
    rows: DataFrame, highest: int | None, key_col: str, natural_key: Sequence[str], per_bucket: int = 50_000
) -> DataFrame:
    """Number ``rows`` from ``highest + 1`` without gaps and without a join.

    For rows that have been written already and are cheap to read again: they are counted
    first, so that no task ranks more than about ``per_bucket`` of them, and the buckets'
    offsets, at most ``BUCKETS`` numbers, enter the plan as a literal.
    """
    count = rows.count()
    buckets = min(BUCKETS, 1 + count // per_bucket)
    bucket = F.pmod(F.xxhash64(*natural_key), F.lit(buckets)).cast("int")
    placed = rows.drop(key_col).withColumn("_bucket", bucket)
    start = highest or 0
    if buckets == 1:
        offset = F.lit(start)
    else:
        sizes = dict(placed.groupBy("_bucket").agg(F.count(F.lit(1))).collect())
        offsets = []
        for b in range(buckets):
            offsets.append(start)
            start += sizes.get(b, 0)
        offset = F.get(F.lit(offsets), F.col("_bucket"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*natural_key))
    numbered = placed.withColumn(key_col, (offset + rank).cast("int"))
    columns = rows.columns if key_col in rows.columns else [key_col, *rows.columns]
    return numbered.select(*columns)
