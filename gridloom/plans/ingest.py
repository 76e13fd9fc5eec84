"""Load landed files into the raw layer."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridloom.functions.keys import batch_id, instant
from gridloom.functions.text import blank_to_null
from gridloom.operators.latest import keep_latest
from gridloom.operators.merge import ConstraintError, merge_upsert
from gridloom.operators.quarantine import Rule, validate_and_quarantine
from gridloom.plans.ledger import split_candidates
from gridloom.schemas import DQ_QUARANTINE, LOAD_LEDGER, RAW_CUSTOMERS, RAW_LOCATIONS, RAW_METERS, Table
from gridloom.sources.landing import (
    CUSTOMER_FILE,
    LOCATION_FILE,
    METER_FILE,
    Landing,
    group_by_header,
    list_files,
    missing_columns,
    read_landed,
)
from gridloom.sources.warehouse import Warehouse

METRICS = (
    "status string, reason string, file string, batch_id string, rows_read bigint, rows_inserted bigint, "
    "existing_rows bigint, duration_seconds decimal(12,2)"
)


def ingest_files(
    wh: Warehouse,
    landing: Landing,
    directory: str,
    run_ts: datetime,
    pattern: str | None = None,
    names: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Load all pending files of one kind in one job; returns one metrics row per file.

    A file whose header lacks a needed column is reported as failed and tried again by the
    next run; it does not hold up the others. Rows go to one raw partition per file, the
    ledger rows follow last. A failed run
    leaves no ledger row, and its repetition overwrites the same partitions because a
    batch id depends only on the file's name.
    """
    started = time.monotonic()
    spark, table, source = wh.spark, landing.table, landing.source_table
    files = list_files(spark, directory, pattern or landing.pattern)
    if names is not None:
        files = files.filter(F.col("source_file").isin(list(names)))
    ledger = wh.read(LOAD_LEDGER)
    candidates = split_candidates(files, ledger, source).withColumn(
        "batch_id", batch_id(source, F.col("source_file"))
    )
    # File names, not data: the driver must hand Spark the paths to read.
    listed = candidates.orderBy("source_file").collect()
    pending = [r for r in listed if r.existing_rows is None]
    metrics = [
        ("skipped", "already_ingested", r.source_file, None, 0, 0, r.existing_rows, None)
        for r in listed
        if r.existing_rows is not None
    ]
    headers = group_by_header(spark, [r.path for r in pending]) if landing.file_format == "csv" else {}
    broken = missing_columns(headers, landing)
    headers = {h: group for h, group in headers.items() if not missing_columns({h: group}, landing)}
    metrics += [
        ("failed", f"columns {broken[r.path]} missing from the header", r.source_file, None, 0, 0, None, None)
        for r in pending
        if r.path in broken
    ]
    pending = [r for r in pending if r.path not in broken]
    if pending:
        known = ledger.filter(F.col("source_table") == source)
        first_id = (known.agg(F.max("max_id")).first()[0] or 0) + 1
        seen = Observation()
        rows = read_landed(spark, [r.path for r in pending], landing, multi_line, headers or None).withColumns(
            {
                "id": F.monotonically_increasing_id() + first_id,
                "_loaded_at": instant(run_ts),
                "_batch_id": batch_id(source, F.col("_source_file")),
            }
        )
        wh.overwrite_partitions(table, rows.observe(seen, F.max("id").alias("max_id")))
        batches = [r.batch_id for r in pending]
        # Counted by the files' footers: no column is read.
        written = wh.read(table).filter(F.col("_batch_id").isin(batches)).groupBy("_batch_id").count()
        counts = dict(written.collect())  # one row per file
        highest = seen.get["max_id"]
        seconds = round(time.monotonic() - started, 2)
        entries = []
        for r in pending:
            n = counts.get(r.batch_id, 0)
            max_id = highest if n else None
            metrics.append(("success", None, r.source_file, r.batch_id, n, n, None, seconds))
            entries.append((source, r.source_file, r.batch_id, "success", n, n, max_id, seconds, run_ts))
        wh.append(LOAD_LEDGER, _rows(wh, entries, LOAD_LEDGER.ddl))
    return _rows(wh, metrics, METRICS)


def _rows(wh: Warehouse, rows: list[tuple], ddl: str) -> DataFrame:
    loose = ddl.replace("decimal(12,2)", "double")
    target = wh.spark.createDataFrame([], ddl).schema
    return wh.spark.createDataFrame(rows, loose).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target]
    )


# --- reference data -------------------------------------------------------

_TYPED = {
    RAW_CUSTOMERS.name: {"signup_date": "date"},
    RAW_LOCATIONS.name: {"latitude": "decimal(10,7)", "longitude": "decimal(10,7)"},
    RAW_METERS.name: {"install_date": "date"},
}


def read_reference(
    wh: Warehouse, landing: Landing, table: Table, paths: Sequence[str], run_ts: datetime
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows) of the pieces of one reference file; blank typed fields are NULL.

    Quoted fields may hold line breaks.
    """
    typed = _TYPED[table.name]
    rows = read_landed(wh.spark, paths, landing, multi_line=True).withColumns(
        {
            **{name: blank_to_null(F.col(name)) for name in typed},
            # Named by content: a bad row that is delivered again every day is quarantined once.
            "id": F.xxhash64(*landing.fields),
            "_row": F.monotonically_increasing_id(),
            "_batch_id": batch_id(landing.source_table, F.col("_source_file")),
        }
    )
    rules = [
        Rule(f"uncastable_{name}", F.col(name).isNotNull() & F.col(name).try_cast(to).isNull(), name)
        for name, to in typed.items()
    ]
    valid, rejected = validate_and_quarantine(
        rows, rules, landing.source_table, "id", list(landing.fields), run_ts
    )
    casts = {name: F.col(name).try_cast(to) for name, to in typed.items()}
    return valid.withColumns(casts), rejected


def _merge_reference(wh: Warehouse, table: Table, rows: DataFrame, run_ts: datetime) -> None:
    latest = keep_latest(rows, table.keys, ["_source_file", "_file_pos", "_row"]).withColumn(
        "_loaded_at", instant(run_ts)
    )
    wh.replace(table, merge_upsert(wh.read(table), latest, table.keys))


def ingest_reference(wh: Warehouse, directory: str, run_ts: datetime, strict: bool = False) -> DataFrame:
    """Customers, locations and meters, each optional, in foreign-key order.

    A file may come in pieces named ``customers.partN.csv``; all of them are read.
    Meters of unknown customers are quarantined; ``strict`` raises instead.
    """
    listed = {r.source_file: r.path for r in list_files(wh.spark, directory, "*.csv").collect()}
    metrics = []
    for landing, table in (
        (CUSTOMER_FILE, RAW_CUSTOMERS),
        (LOCATION_FILE, RAW_LOCATIONS),
        (METER_FILE, RAW_METERS),
    ):
        stem, suffix = landing.pattern.rsplit(".", 1)
        shape = re.compile(rf"{re.escape(stem)}(\.part\d+)?\.{suffix}")
        paths = [path for name, path in sorted(listed.items()) if shape.fullmatch(name)]
        if not paths:
            continue
        started = time.monotonic()
        rows, rejected = read_reference(wh, landing, table, paths, run_ts)
        if table is RAW_METERS:
            known = wh.read(RAW_CUSTOMERS).select(F.col("customer_id").alias("_owner"))
            owned = rows.join(known, F.col("customer_id") == F.col("_owner"), "left")
            is_orphan = F.col("customer_id").isNotNull() & F.col("_owner").isNull()
            orphans = owned.filter(is_orphan)
            if strict and not orphans.isEmpty():
                raise ConstraintError("meters refer to customers that do not exist")
            text = orphans.withColumns({name: F.col(name).cast("string") for name in _TYPED[table.name]})
            unknown = [Rule("orphan_customer_id", F.lit(True), "customer_id")]
            rejected = rejected.unionByName(
                validate_and_quarantine(
                    text, unknown, landing.source_table, "id", list(landing.fields), run_ts
                )[1]
            )
            rows = owned.filter(~is_orphan).drop("_owner")
        within = F.col("source_table") == landing.source_table
        wh.insert_if_absent(DQ_QUARANTINE, rejected.dropDuplicates(DQ_QUARANTINE.keys), within)
        _merge_reference(wh, table, rows, run_ts)
        seconds = round(time.monotonic() - started, 2)
        metrics.append(("success", None, landing.pattern, None, rows.count(), wh.read(table).count(), None, seconds))
    return _rows(wh, metrics, METRICS)
