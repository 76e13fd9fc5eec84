"""Keyed merge, insert-if-absent and constraint checks on DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.latest import keep_latest


def merge_upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
    touch_cols: Sequence[str] = (),
    newer: str | None = None,
) -> DataFrame:
    """Last writer wins on ``keys``; the result has the target's columns.

    With ``newer`` an update counts only where that column is greater than the stored one.
    A NULL in a key matches nothing, so such a row is added again by each merge; staging and the
    warehouse keep them out. (Null-safe equality would cost a target that is already
    partitioned by its keys another shuffle.)

    On a match only ``update_cols`` and ``touch_cols`` come from the update, every
    other column keeps the stored value. ``order`` reduces repeated keys in
    ``updates`` first. Keys are unique on both sides of the one full outer join,
    so no key can be hot.
    """
    if order:
        updates = keep_latest(updates, keys, order)
    if update_cols is None:
        update_cols = [c for c in target.columns if c not in keys]
    from_update = set(update_cols) | set(touch_cols)

    old = target.withColumn("_old", F.lit(True)).alias("o")
    new = updates.withColumn("_new", F.lit(True)).alias("n")
    match = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    counts = F.col("n._new")
    if newer:
        counts = counts & (F.col("o._old").isNull() | (F.col(f"n.{newer}") > F.col(f"o.{newer}")))

    def pick(name: str):
        stored = F.col(f"o.{name}")
        if name in keys:
            return F.coalesce(stored, F.col(f"n.{name}")).alias(name)
        if name not in updates.columns:
            return stored.alias(name)
        given = F.col(f"n.{name}").cast(target.schema[name].dataType)
        if name in from_update:
            return F.when(counts, given).otherwise(stored).alias(name)
        return F.when(F.col("o._old"), stored).otherwise(given).alias(name)

    return old.join(new, match, "full_outer").select(*[pick(c) for c in target.columns])


def holds(rows: DataFrame, not_null: Sequence[str]) -> Column:
    """True for every row; the job fails on one with a NULL in a ``not_null`` column."""
    broken = F.lit(False)
    for name in not_null:
        broken = broken | F.col(name).isNull()
    message = F.lit(f"NULL in one of the required columns {list(not_null)}")
    return F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def with_copies(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``_copies``, how many share their key. The shuffle is the one that a merge on
    ``keys`` needs anyway."""
    return rows.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def violations(required: Sequence[str]) -> list[Column]:
    """What an observation of rows with ``_copies`` counts: rows, rows of repeated keys, NULLs by column."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_copies") > 1).alias("repeated"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
    ]


def refused_rows(rows: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """The rows for which a write under these rules is refused, with the ``refusal``."""
    needed = [c for c in dict.fromkeys([*keys, *required]) if c in rows.columns]
    refusal = F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in needed], F.when(F.col("_copies") > 1, F.lit("repeated_key"))
    )
    return with_copies(rows, keys).withColumn("refusal", refusal).filter("refusal IS NOT NULL").drop("_copies")


def absent_rows(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key the target lacks."""
    return new.join(target.select(*keys), list(keys), "left_anti").select(*new.columns)


def insert_if_absent(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows are never changed; repeated keys in ``new`` are inserted once."""
    return target.unionByName(absent_rows(target, new, keys).dropDuplicates(list(keys)))


def orphan_rows(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows with a non-null reference to a parent that does not exist."""
    known = parent.select(F.col(parent_col).alias("_parent"))
    referring = child.filter(F.col(child_col).isNotNull())
    return referring.join(known, F.col(child_col) == F.col("_parent"), "left_anti")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: a violation count per NOT NULL column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``copies``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


class ConstraintError(ValueError):
    """A NOT NULL, UNIQUE or reference rule does not hold."""


def require_constraints(
    df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()
) -> DataFrame:
    """Return ``df`` unchanged, or raise. Runs at most one aggregate and one early-stopping check."""
    if not_null:
        counts = null_violations(df, not_null).first().asDict()
        broken = {name: n for name, n in counts.items() if n}
        if broken:
            raise ConstraintError(f"NULL in required columns: {broken}")
    if unique:
        repeated = duplicate_keys(df, unique).first()
        if repeated:
            raise ConstraintError(f"duplicate key: {repeated.asDict()}")
    return df
