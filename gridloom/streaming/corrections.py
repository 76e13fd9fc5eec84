"""A stream of raw records with keyed state: each late correction replaces the reading once.

The raw layer itself is the source, so records arrive whole, however many files brought them, and
no list of names passes the driver. State holds the last delivery of each key, in the order of
the batch operators (load, file, place, row); a micro-batch passes on the keys it has changed,
and the merge replaces a stored row only by a later one, so a record that is delivered again
changes nothing. The watermark of the readings' own time bounds the state: a key leaves it when
newer readings are ``keep`` past it. Records for such keys are still staged: Spark counts what it
drops behind the watermark, and if there is any, that part of the raw layer is staged by the
batch operators under the same rule.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.keys import instant
from gridloom.operators.latest import keep_latest
from gridloom.plans.pipeline import Feed
from gridloom.schemas import DQ_QUARANTINE
from gridloom.session import remove, scratch_dir
from gridloom.sources.warehouse import Warehouse

#: A delivery's place in the order of deliveries.
ORDER = ("_loaded_at", "_source_file", "_file_pos", "_raw_id")


def _merge(wh: Warehouse, feed: Feed, rows: DataFrame, run_ts: datetime) -> None:
    """Stage one row a key where it is later than the stored one."""
    day = feed.target.partition_by[0]
    dated = rows.withColumns({feed.surrogate: F.col("_raw_id"), "_loaded_at": instant(run_ts), day: F.to_date(feed.moment)})
    touched = sorted(r[0] for r in dated.select(day).distinct().collect())  # days
    wh.upsert(feed.target, dated, touched, feed.update_cols, newer="_raw_id")


def stream_corrections(
    wh: Warehouse,
    feed: Feed,
    checkpoint: str,
    clock: Callable[[], datetime],
    keep: str = "30 days",
    max_files: int | None = None,
) -> int:
    """Stage every raw record that arrived since the last call, then stop; returns how many records
    came behind the watermark.

    ``checkpoint`` remembers the files that were read and the state of each key. Rejected
    records are quarantined once, by a query of their own over the same source. A micro-batch
    repeated after a failure merges the same rows into the same days.
    """
    table = feed.landing.table
    if not wh.exists(table):
        return 0
    reader = wh.spark.readStream.schema(table.ddl)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    valid, rejected = feed.stage.split(reader.parquet(wh.path(table)))

    def settled(rows: DataFrame, use: Callable[[DataFrame], None]) -> None:
        """Run the micro-batch once, and go on in the warehouse's own session."""
        path = scratch_dir(wh.spark, "corrections")
        rows.write.parquet(path)
        use(wh.spark.read.schema(rows.schema).parquet(path))
        remove(wh.spark, path)

    def quarantine(rows: DataFrame) -> None:
        batches = [r[0] for r in rows.select("_batch_id").distinct().collect()]  # the files of a micro-batch
        within = (F.col("source_table") == feed.stage.source_table) & F.col("_batch_id").isin(batches)
        at = instant(clock())
        wh.insert_if_absent(DQ_QUARANTINE, rows.withColumn("quarantined_at", at).dropDuplicates(DQ_QUARANTINE.keys), within)

    carried = [c for c in (*feed.stage.columns, "_batch_id", "_raw_id") if c not in feed.stage.keys]
    last = F.max(F.struct(*ORDER, F.struct(*carried).alias("row"))).alias("last")
    # Event time is an instant; UTC in and out leaves the zone-free moment as it was.
    at = F.to_utc_timestamp(F.col(feed.moment).cast("timestamp"), "UTC").alias("at")
    latest = (
        feed.stage.typed_rows(valid).withColumn("at", at).withWatermark("at", keep)
        .groupBy("at", *feed.stage.keys).agg(last)
        .select(*feed.stage.keys, "last.row.*")
    )
    behind = 0
    for rows, sink, mode, name in (
        (rejected, quarantine, "append", "rejected"),
        (latest, lambda rows: _merge(wh, feed, rows, clock()), "update", "latest"),
    ):
        query = (
            rows.writeStream.foreachBatch(lambda batch, _epoch, use=sink: settled(batch, use)).outputMode(mode)
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        for progress in query.recentProgress:
            behind += sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
            mark = progress["eventTime"].get("watermark")
    if behind:
        late = F.col(feed.moment) <= F.lit(mark.rstrip("Z").replace("T", " ")).cast("timestamp_ntz")
        rows = feed.stage.typed_rows(feed.stage.split(wh.read(table))[0]).filter(late)
        _merge(wh, feed, keep_latest(rows, feed.stage.keys, list(ORDER)).select(*feed.stage.keys, *carried), clock())
    return behind
