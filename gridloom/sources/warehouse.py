"""Parquet tables of the four layers below one root folder.

Three ways of writing, all on Spark's own commit protocol:

* partitioned tables replace only the partitions present in the written rows; a merge
  writes them beside the table first and then swaps folders, and a swap that was cut
  off is finished before the next merge;
* versioned tables (dimensions, reference data) are written whole into a new folder,
  and readers take the newest finished one, so a failed write is never seen. Of a history
  only the open rows are rewritten; rows that a version closes are appended beside them under
  its number, and count once that version is finished;
* the ledger is append-only.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.layout import clustered
from gridloom.operators.merge import ConstraintError, absent_rows, merge_upsert, violations, with_copies
from gridloom.schemas import Table


class Warehouse:
    """``keep_versions`` is how long a replaced version stays for readers that still use it."""

    def __init__(self, spark: SparkSession, root: str, keep_versions: timedelta = timedelta(days=7)):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = keep_versions

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    # --- reading ---

    def read(self, table: Table) -> DataFrame:
        """The table, empty when nothing was written yet. The schema is declared, never inferred."""
        path = self.path(table)
        if table.versioned:
            newest = self._newest(table, self._versions(table))
            if not table.open_flag:
                return newest
            return newest.unionByName(self.read_beside(table, "closed", table).drop("v"))
        self._finish_swap(table)
        if not self._exists(path):
            return self._empty(table)
        return self.spark.read.schema(table.ddl).parquet(path).select(*table.columns)

    def read_open(self, table: Table) -> DataFrame:
        """The open rows of a history; closed ones are not read."""
        return self._newest(table, self._versions(table)).filter(F.col(table.open_flag))

    def _newest(self, table: Table, versions: Sequence[int]) -> DataFrame:
        if not versions:
            return self._empty(table)
        path = f"{self.path(table)}/v={versions[-1]:08d}"
        return self.spark.read.schema(table.ddl).parquet(path).select(*table.columns)

    def _empty(self, table: Table) -> DataFrame:
        return self.spark.createDataFrame([], table.ddl)

    # --- writing ---

    def append(self, table: Table, rows: DataFrame) -> None:
        self._finish_swap(table)
        self._writer(table, rows).mode("append").parquet(self.path(table))

    def overwrite_partitions(self, table: Table, rows: DataFrame) -> None:
        writer = self._writer(table, rows).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(table))

    def swap_partitions(self, table: Table, rows: DataFrame, seen: Observation | None = None) -> None:
        """Like :meth:`overwrite_partitions`, for rows that derive from the table itself.

        With an observation of :func:`violations` the partitions are published only if it has none.

        The stored partitions stay in place until their replacements are complete. An older
        swap that was cut off is finished first: its folder may hold the only copy of a
        partition.
        """
        self._finish_swap(table)
        writer = self._writer(table, rows).mode("overwrite").option("partitionOverwriteMode", "static")
        if seen is None:
            writer.parquet(self._pending(table))  # a static overwrite ends with the _SUCCESS mark
            self._finish_swap(table)
            return
        # Not yet under the name that a later swap would finish.
        unproven = f"{self._pending(table)}-unproven"
        writer.parquet(unproven)
        broken = {name: n for name, n in seen.get.items() if name != "rows" and n}
        fs, folder = self._fs(unproven)
        if broken:
            fs.delete(folder, True)
            raise ConstraintError(f"nothing written to {table.name}: {broken}")
        fs.delete(self._fs(self._pending(table))[1], True)
        if not fs.rename(folder, self._fs(self._pending(table))[1]):
            raise OSError(f"could not publish {unproven}")
        self._finish_swap(table)

    def _pending(self, table: Table) -> str:
        return f"{self.path(table)}.pending"

    def _finish_swap(self, table: Table) -> None:
        """Move finished partitions into the table; safe to repeat from any point."""
        pending = self._pending(table)
        if not self._exists(f"{pending}/_SUCCESS"):
            return
        depth = len(table.partition_by)
        fs, pattern = self._fs(pending + "".join(f"/{name}=*" for name in table.partition_by))
        for status in fs.globStatus(pattern) or []:
            source = status.getPath()
            inner = "/".join(source.toString().split("/")[-depth:])
            _, target = self._fs(f"{self.path(table)}/{inner}")
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"could not move {source.toString()} to {target.toString()}")
        fs.delete(self._fs(pending)[1], True)

    def replace(self, table: Table, rows: DataFrame) -> None:
        versions = self._versions(table)
        number = versions[-1] + 1 if versions else 1
        self._conform(table, rows).write.mode("overwrite").parquet(f"{self.path(table)}/v={number:08d}")
        self._forget(table)

    def replace_open(self, table: Table, open_rows: DataFrame, closed: DataFrame) -> None:
        """The next version of a history: ``open_rows`` replace the open ones, ``closed`` are appended.

        Closed rows that an older layout kept with the open ones move once.
        """
        moved = self._newest(table, self._versions(table)).filter(~F.col(table.open_flag))
        closed = self._conform(table, closed).unionByName(self._conform(table, moved))
        self.replace_beside(table, open_rows, "closed", table, closed)

    def replace_beside(self, table: Table, rows: DataFrame, name: str, kind: Table, beside: DataFrame) -> None:
        """The next version of ``table``, and rows of ``kind`` that belong to it, as one step.

        The rows beside are written first, under the number of the version to come, and count
        once it is finished. A repeated attempt overwrites what a failed one has left.
        """
        versions = self._versions(table)
        number = versions[-1] + 1 if versions else 1
        self._writer(kind, beside).mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{self.path(table)}_{name}/v={number:08d}"
        )
        self.replace(table, rows)

    def read_beside(self, table: Table, name: str, kind: Table) -> DataFrame:
        """The rows written beside all finished versions, with the number ``v`` of each."""
        versions, path = self._versions(table), f"{self.path(table)}_{name}"
        if not versions or not self._exists(path):
            return self.spark.createDataFrame([], f"{kind.ddl}, v int")
        found = self.spark.read.schema(f"{kind.ddl}, v int").parquet(path)
        return found.filter(F.col("v") <= versions[-1]).select(*kind.columns, "v")

    def _forget(self, table: Table) -> None:
        """Delete versions that were replaced longer ago than ``keep_versions``."""
        versions = self._versions(table)
        for old, successor in zip(versions, versions[1:]):
            fs, done = self._fs(f"{self.path(table)}/v={successor:08d}/_SUCCESS")
            if time.time() - fs.getFileStatus(done).getModificationTime() / 1000 > self.keep_versions.total_seconds():
                fs.delete(self._fs(f"{self.path(table)}/v={old:08d}")[1], True)

    def upsert(
        self,
        table: Table,
        updates: DataFrame,
        touched: Sequence,
        update_cols: Sequence[str],
        newer: str | None = None,
    ) -> None:
        """Merge into a partitioned table, rewriting only the ``touched`` partition values.

        With ``newer`` an update counts only where that column is greater than the stored one.

        The partition column depends on the key alone, so a row never moves. ``touched``
        is a list of days and may name more than needed. The rows are rebalanced by day:
        adaptive execution splits a large day over many files and joins small ones. A clustered
        table lies by its cells inside a day.

        NULLs in required columns and keys that ``updates`` repeats are counted while the rows are
        written, and the new partitions are only published if there are none; else the table
        stays as it is and :class:`ConstraintError` says what was found.
        """
        if not touched:
            return
        part = table.partition_by[0]
        current = self.read(table).filter(F.col(part).isin(list(touched)))
        needed = dict.fromkeys([*table.keys, *table.required])
        seen = Observation()
        counted = with_copies(updates, table.keys).observe(seen, *violations([c for c in needed if c in updates.columns]))
        merged = merge_upsert(current, counted, table.keys, update_cols, newer=newer)
        laid = clustered(merged, part, *table.cluster) if table.cluster else merged.hint("rebalance", part)
        self.swap_partitions(table, laid, seen)

    def insert_if_absent(self, table: Table, rows: DataFrame, within: Column) -> None:
        """Append rows with new keys; ``within`` limits the stored partitions to compare with."""
        stored = self.read(table).filter(within)
        self.append(table, absent_rows(stored, rows, table.keys))

    def _conform(self, table: Table, rows: DataFrame) -> DataFrame:
        wanted = self._empty(table).schema
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])

    def _writer(self, table: Table, rows: DataFrame):
        writer = self._conform(table, rows).write
        if table.cluster:  # a row group without the wanted id is not read
            name = table.cluster[0]
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        return writer.partitionBy(*table.partition_by) if table.partition_by else writer

    # --- folders ---

    def _fs(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def exists(self, table: Table) -> bool:
        return self._exists(self.path(table))

    def _exists(self, path: str) -> bool:
        fs, folder = self._fs(path)
        return fs.exists(folder)

    def _versions(self, table: Table) -> list[int]:
        """Finished versions, oldest first: those Spark has marked with ``_SUCCESS``."""
        fs, pattern = self._fs(f"{self.path(table)}/v=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return sorted(int(status.getPath().getParent().getName()[2:]) for status in found)
