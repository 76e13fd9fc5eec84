"""Joins in which a few keys hold much of one side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that the sketch tracks, and of which it tells the most frequent.
TRACKED, TOLD = 10_000, 100


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, at most ``TOLD``.

    One aggregate with a mergeable sketch of frequent items. A key it misses costs balance,
    never a row.
    """
    hashed = f"xxhash64({', '.join(f'`{k}`' for k in keys)})"
    row = df.agg(F.expr(f"approx_top_k({hashed}, {TOLD}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in row["top"] or [] if r["count"] >= max(2, share * row["n"])]


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: Sequence[int], how: str = "left", salts: int = 16
) -> DataFrame:
    """``left`` join ``right`` on ``keys``, with the rows of ``hot`` keys (see :func:`heavy_keys`) dealt to ``salts``
    tasks. Only the right rows of those keys are repeated. ``how`` is left or inner, as a right row
    must not be unmatched in some of its copies."""
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    if not hot:
        return left.join(right, list(keys), how)
    is_hot = F.xxhash64(*keys).isin(list(hot))
    salt: Column = F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts))).otherwise(0).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = left.withColumn("_salt", salt)
    return salted.join(right.withColumn("_salt", F.explode(copies)), [*keys, "_salt"], how).drop("_salt")
