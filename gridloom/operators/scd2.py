"""Type-2 history: merge of a new snapshot, and point-in-time lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.keys import instant
from gridloom.operators.surrogate import number_settled
from gridloom.session import staged

POLICIES = ("contiguous", "reference")


def changed(old: str, new: str, tracked: Sequence[str]) -> Column:
    """Null-safe: true when any tracked column differs between the two aliases."""
    result = F.lit(False)
    for name in tracked:
        result = result | ~F.col(f"{old}.{name}").eqNullSafe(F.col(f"{new}.{name}"))
    return result


def scd2_expire(dim: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], run_ts: datetime) -> DataFrame:
    """``dim`` with the current version of every changed key closed at ``run_ts``."""
    # Closed versions, the bulk of a long history, pass by without a shuffle.
    past, open_now = dim.filter(~F.col("is_current")), dim.filter("is_current")
    joined = open_now.alias("d").join(
        source.select(key, *tracked).withColumn("_hit", F.lit(True)).alias("s"),
        F.col(f"d.{key}") == F.col(f"s.{key}"),
        "left",
    )
    closing = F.col("_hit").isNotNull() & changed("d", "s", tracked)
    replaced = {
        # A version that starts after the run is closed where it starts, never before.
        "valid_to": F.when(closing, F.greatest(instant(run_ts), F.col("d.valid_from"))).otherwise(F.col("d.valid_to")),
        "is_current": ~closing,
    }
    return past.unionByName(joined.select(*[replaced.get(c, F.col(f"d.{c}")).alias(c) for c in dim.columns]))


def scd2_changes(
    open_versions: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    derived: Mapping[str, Column],
    valid_from: Column,
    run_ts: datetime,
    surrogate: str,
    policy: str = "contiguous",
) -> DataFrame:
    """What becomes of the open versions: their rows with ``_fate`` closed, kept or opened.

    One full outer join of the open versions with ``source`` (at most one row a key) decides
    every case, and each pair is exploded into the rows it leaves. Opened rows have no
    surrogate yet. A NULL key is a key like any other.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    now = instant(run_ts)
    columns = open_versions.columns
    incoming = source.withColumns(
        {**derived, "_starts": F.coalesce(valid_from.cast("timestamp_ntz"), now), "_new": F.lit(True)}
    ).alias("s")
    stored = open_versions.withColumn("_old", F.lit(True)).alias("d")
    pairs = stored.join(incoming, F.col(f"d.{key}").eqNullSafe(F.col(f"s.{key}")), "full_outer")
    both = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    closing = both & changed("d", "s", tracked)
    # A version that starts after the run is closed where it starts, never before.
    ends = F.greatest(now, F.col("d.valid_from"))
    starts = F.when(closing, ends).otherwise(F.col("s._starts")) if policy == "contiguous" else F.col("s._starts")

    def row(fate: str, **replaced: Column) -> Column:
        side = "s" if fate == "opened" else "d"
        kinds = {f.name: f.dataType for f in open_versions.schema}
        return F.struct(
            *(replaced.get(c, F.col(f"{side}.{c}")).cast(kinds[c]).alias(c) for c in columns), F.lit(fate).alias("_fate")
        )

    nothing = F.lit(None)
    closed = row("closed", valid_to=ends, is_current=F.lit(False))
    kept = row("kept")
    opened = row("opened", **{surrogate: nothing}, valid_from=starts, valid_to=nothing, is_current=F.lit(True))
    left = F.when(closing, F.array(closed, opened)).when(F.col("_old").isNull(), F.array(opened)).otherwise(F.array(kept))
    return pairs.select(F.inline(left))


def settle_changes(changes: DataFrame, versions: DataFrame, key: str, surrogate: str) -> tuple[DataFrame, DataFrame]:
    """(open rows, closed rows) of :func:`scd2_changes`, with surrogates that continue those of ``versions``.

    The changes are written once to shared scratch; numbering reads that, not the dimension.
    """
    done = staged(changes, "history")
    highest = versions.agg(F.max(surrogate)).first()[0]
    opened = number_settled(done.filter("_fate = 'opened'"), highest, surrogate, [key])
    still_open = done.filter("_fate = 'kept'").unionByName(opened)
    return still_open.drop("_fate"), done.filter("_fate = 'closed'").drop("_fate")


def scd2_merge(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    derived: Mapping[str, Column],
    valid_from: Column,
    run_ts: datetime,
    surrogate: str,
    policy: str = "contiguous",
) -> DataFrame:
    """Close changed versions, open new ones, keep everything else.

    ``derived`` and ``valid_from`` are expressions over the source's columns.
    Under ``contiguous`` a replacing version starts at ``run_ts``, so versions never
    overlap; ``reference`` starts it at ``valid_from`` like a first version.
    Keys missing from the source stay current. Versions closed before, the bulk of a long
    history, pass by without a shuffle.
    """
    changes = scd2_changes(dim.filter("is_current"), source, key, tracked, derived, valid_from, run_ts, surrogate, policy)
    still_open, closed = settle_changes(changes, dim, key, surrogate)
    return dim.filter(~F.col("is_current")).unionByName(closed).unionByName(still_open)


def as_of(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, moment: str, how: str = "inner",
    slice_days: int = 30,
) -> DataFrame:
    """Attach the version valid at ``moment``, by one window over the sorted union of both sides.

    Versions and facts of a key stand in one sequence by time, and the last version is carried
    forward, so the work is a sort however many versions a key has; there is no join and no
    range condition. Sequences are cut by time: each slice of ``slice_days`` opens with the
    version that was in force, found from one row a key and slice, so a key that holds most
    facts is spread over its slices.

    Versions that end where they start are never valid. Of versions that overlap, the last
    started one counts, of equally old ones the last to end; :func:`all_versions_at` gives all
    of them. A NULL key or moment meets no version. ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    extra = [c for c in dim.columns if c not in facts.columns]
    end_of_time = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast("timestamp_ntz"))
    width = slice_days * 86_400_000_000

    def slice_of(at: Column) -> Column:
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), at)
        return F.floor(micros / width).cast("bigint")

    versions = dim.filter(end_of_time > F.col("valid_from")).select(
        F.col(dim_key).alias("_k"), F.col("valid_from").alias("_at"), end_of_time.alias("_to"), F.struct(*extra).alias("_v")
    ).filter(F.col("_k").isNotNull()).withColumn("_slice", slice_of(F.col("_at")))
    every = facts.select(
        F.col(fact_key).alias("_k"), F.col(moment).cast("timestamp_ntz").alias("_at"), F.struct(*facts.columns).alias("_f")
    ).withColumn("_slice", slice_of(F.col("_at")))
    placed = F.col("_k").isNotNull() & F.col("_at").isNotNull()
    rows = every.filter(placed)

    # One row a key and slice: the last version that starts there, and whether facts need an opening.
    started = F.struct("_at", "_to", "_v")
    ends = versions.groupBy("_k", "_slice").agg(F.max_by(started, F.struct("_at", "_to")).alias("_last"))
    asked = rows.select("_k", "_slice").distinct()
    none = F.lit(None).cast(ends.schema["_last"].dataType)
    carried = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    openings = (
        ends.withColumn("_asked", F.lit(False)).unionByName(asked.select("_k", "_slice", none.alias("_last"), F.lit(True).alias("_asked")))
        .groupBy("_k", "_slice").agg(F.first("_last", ignorenulls=True).alias("_last"), F.max("_asked").alias("_asked"))
        .withColumn("_before", F.last("_last", ignorenulls=True).over(carried))
        .filter(F.col("_asked") & F.col("_before").isNotNull())
        .select("_k", "_slice", "_before.*")
    )

    no_fact = F.lit(None).cast(rows.schema["_f"].dataType)
    no_version = F.lit(None).cast(ends.schema["_last"].dataType)
    sequence = (
        versions.unionByName(openings.select(*versions.columns))
        .select("_k", "_slice", F.col("_at"), F.lit(0).alias("_kind"), F.col("_to").alias("_until"), started.alias("_ver"), no_fact.alias("_f"))
        .unionByName(rows.select("_k", "_slice", "_at", F.lit(1).alias("_kind"), F.lit(None).cast("timestamp_ntz").alias("_until"),
                                 no_version.alias("_ver"), "_f"))
    )
    so_far = Window.partitionBy("_k", "_slice").orderBy("_at", "_kind", "_until").rowsBetween(Window.unboundedPreceding, 0)
    met = sequence.withColumn("_ver", F.last("_ver", ignorenulls=True).over(so_far)).filter("_kind = 1")
    valid = F.col("_at") < F.col("_ver._to")
    attached = [F.when(valid, F.col(f"_ver._v.{c}")).alias(c) for c in extra]
    if how == "inner":
        return met.filter(valid).select("_f.*", *attached)
    unplaced = every.filter(~placed).select("_f.*", *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in extra])
    return met.select("_f.*", *attached).unionByName(unplaced)


def all_versions_at(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, moment: str, how: str = "inner"
) -> DataFrame:
    """Attach every version valid at ``moment``, for histories whose versions overlap.

    An equi-join with a range residual. A key gains at most one version per merge
    run, so candidates per fact row are bounded by the number of runs, not by data;
    a hot key is split by the adaptive skew join, or the history is broadcast when
    its measured size is below the session's threshold.
    """
    at = F.col(f"f.{moment}")
    match = (
        (F.col(f"f.{fact_key}") == F.col(f"v.{dim_key}"))
        & (at >= F.col("v.valid_from"))
        & (F.col("v.valid_to").isNull() | (at < F.col("v.valid_to")))
    )
    extra = [c for c in dim.columns if c not in facts.columns]
    return facts.alias("f").join(dim.alias("v"), match, how).select("f.*", *[f"v.{c}" for c in extra])
