"""Validation with quarantine: one tagging expression, two filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.keys import instant

REASON = "_reason"


@dataclass(frozen=True)
class Rule:
    """``failing`` is true for a bad row; ``shown`` names the column quoted in the reason."""

    code: str
    failing: Column
    shown: str


def first_failure(rules: Sequence[Rule]) -> Column:
    """``code: value`` of the first rule that fails, else NULL."""
    return F.coalesce(
        *[
            F.when(r.failing, F.concat(F.lit(f"{r.code}: "), F.coalesce(F.col(r.shown), F.lit("null"))))
            for r in rules
        ]
    )


def json_snapshot(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def validate_and_quarantine(
    raw: DataFrame,
    rules: Sequence[Rule],
    source_table: str,
    id_col: str,
    snapshot_cols: Sequence[str],
    quarantined_at: datetime | None = None,
    dropped: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected).

    Both sides are narrow filters over the same scan. Re-reading the column-pruned
    raw batch for the second side is cheaper than caching it at cluster size.
    ``dropped`` marks rows that reach neither side.
    """
    tagged = raw.withColumn(REASON, first_failure(rules))
    valid = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    if dropped is not None:
        valid = valid.filter(~dropped)
    batch = F.col("_batch_id") if "_batch_id" in raw.columns else F.lit(None).cast("string")
    rejected = tagged.filter(F.col(REASON).isNotNull()).select(
        F.lit(source_table).alias("source_table"),
        F.col(id_col).cast("bigint").alias("source_id"),
        F.col(REASON).alias("reason"),
        json_snapshot(snapshot_cols).alias("raw_data"),
        instant(quarantined_at).alias("quarantined_at"),
        F.lit(False).alias("resolved"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolution_note"),
        batch.alias("_batch_id"),
    )
    return valid, rejected
