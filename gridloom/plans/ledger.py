"""What has been loaded: pending files, load metrics, batch lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.keys import instant


def load_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count_if(F.col("status") == "success").alias("loaded"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def split_candidates(files: DataFrame, ledger: DataFrame, source_table: str) -> DataFrame:
    """Candidate files with the ``existing_rows`` of an earlier load, NULL for pending ones.

    A file is known by its base name, also when it had no rows.
    """
    loaded = ledger.filter(F.col("source_table") == source_table).select(
        "source_file", F.col("rows_inserted").alias("existing_rows")
    )
    return files.join(loaded, "source_file", "left")


def batches_of(ledger: DataFrame, source_table: str, source_files: Sequence[str]) -> dict[str, str]:
    """{file: batch id} of those files that were loaded; one ledger row per file."""
    rows = ledger.filter(
        (F.col("source_table") == source_table) & F.col("source_file").isin(list(source_files))
    ).select("source_file", "batch_id")
    return {r.source_file: r.batch_id for r in rows.collect()}


def batches_with_fallback(ledger: DataFrame, source_table: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``preferred``, ``fallback``: file names) with the ``batch_id`` of the first of the two
    that was loaded, NULL if neither was. One ledger row per file, so no row of ``wanted`` is repeated."""
    loaded = ledger.filter(F.col("source_table") == source_table).select("source_file", "batch_id")
    own = loaded.select(F.col("source_file").alias("preferred"), F.col("batch_id").alias("_own"))
    shared = loaded.select(F.col("source_file").alias("fallback"), F.col("batch_id").alias("_shared"))
    return (
        wanted.join(own, "preferred", "left").join(shared, "fallback", "left")
        .select(*wanted.columns, F.coalesce("_own", "_shared").alias("batch_id"))
    )


def loaded_between(raw: DataFrame, ledger: DataFrame, source_table: str, start: datetime, end: datetime) -> DataFrame:
    """The raw rows of the files loaded from ``start`` to before ``end``.

    The files come from the ledger, and with them the partitions: a semi-join that Spark turns into
    dynamic partition pruning, so other batches are neither listed in the query nor read.
    """
    files = ledger.filter(
        (F.col("source_table") == source_table) & (F.col("loaded_at") >= instant(start)) & (F.col("loaded_at") < instant(end))
    )
    return raw.join(files.select(F.col("batch_id").alias("_batch_id")), "_batch_id", "left_semi")


def batch_with_fallback(ledger: DataFrame, source_table: str, preferred: str, fallback: str) -> str | None:
    wanted = ledger.sparkSession.createDataFrame([(preferred, fallback)], "preferred string, fallback string")
    return batches_with_fallback(ledger, source_table, wanted).first()["batch_id"]
