"""Exact grouped quantiles of decimals with bounded groups, and mergeable sketches of them.

``percentile`` keeps every distinct value of a group in one task's memory. Here equal
values are counted first, then each wanted rank is located by ``STEP_DIGITS`` digits at a
time, from the high ones down: among the values of a group cut after so many digits, then
among those that share the cut of the one wanted. A task ranks no more rows of a group than
such steps can tell apart, however many readings the group has and digits the decimals.

Where a bound on the error is enough, a sketch of each group and day is kept, and those of
any period are merged without the readings.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP_DIGITS = 6
#: Size of a sketch. Exact up to this many values; beyond, ranks are off by about 1.33 % at
#: 200 and a quarter of a percent at 1024, with 99 % confidence.
SKETCH_SIZE = 1024


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` in which a NULL key meets a NULL key, as in a grouping."""
    named = right.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys]
    return left.join(named, same).drop(*(f"_group_{k}" for k in keys))


def cut_after(value: str, digit: int) -> Column:
    """The decimal less its digits below 10 to the ``digit``. Where that is below the least decimal
    it is NULL, which sorts first."""
    unit = Decimal(10**digit) if digit >= 0 else Decimal(f"0.{'1'.zfill(-digit)}")
    return F.try_subtract(F.col(value), F.pmod(F.col(value), F.lit(unit)))


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles (as ``percentile_cont``), one column per entry of ``probs``.

    ``value`` is a decimal of any precision. NULL values do not count; a NULL key is a key.
    """
    field = df.schema[value].dataType
    if field.typeName() != "decimal":
        raise TypeError(f"{value} must be a decimal, not {field.simpleString()}")
    keys, last = list(keys), -(-field.precision // STEP_DIGITS) - 1
    cuts = [f"_cut_{i}" for i in range(last + 1)]
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias(cuts[last]))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({c: cut_after(cuts[last], STEP_DIGITS * (last - i) - field.scale) for i, c in enumerate(cuts[:-1])})
    )

    def rows_before(by: list[str], order: str) -> Column:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    def found(entry: Column) -> Column:
        """An order statistic that lies in this row, by its rank from here on."""
        inside = (entry["rank"] >= F.col("_from")) & (entry["rank"] < F.col("_from") + F.col("_n"))
        return F.when(inside, F.struct(entry["q"].alias("q"), (entry["rank"] - F.col("_from")).alias("rank"), entry["weight"].alias("weight")))

    def order_statistics(total: Column) -> Column:
        """The two around each fractional position."""
        entries = []
        for name, p in probs.items():
            position = (total - 1) * F.lit(float(p))
            for rank in (F.floor(position), F.ceil(position)):
                entries.append(F.struct(F.lit(name).alias("q"), rank.alias("rank"), (position - F.floor(position)).alias("weight")))
        return F.array(*entries)

    placed = None
    for i, cut in enumerate(cuts):
        above = cuts[i - 1 : i] if i else []
        rows = counted if i == last else counted.groupBy(*keys, *above, cut).agg(F.sum("_n").alias("_n"))
        if placed is None:
            rows = rows.withColumn("_wanted", order_statistics(F.sum("_n").over(Window.partitionBy(*keys))))
        else:  # only values that share the cut of a wanted one are ranked, and only against each other
            rows = join_groups(rows, placed, [*keys, *above])
        rows = rows.withColumn("_from", rows_before([*keys, *above], cut))
        hits = F.array_compact(F.transform("_wanted", found))
        placed = rows.select(*keys, cut, hits.alias("_wanted")).filter(F.size("_wanted") > 0)

    ranked = placed.select(*keys, F.col(cuts[last]).cast("double").alias("_v"), F.inline("_wanted"))

    def blended(name: str) -> Column:
        mine = F.col("q") == name
        low, high = F.min(F.when(mine, F.col("_v"))), F.max(F.when(mine, F.col("_v")))
        return (low + (high - low) * F.max(F.when(mine, F.col("weight")))).alias(name)

    return ranked.groupBy(*keys).agg(*[blended(name) for name in probs])


# --- mergeable states ---------------------------------------------------------


def value_states(df: DataFrame, keys: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """One mergeable state for each group: a quantile sketch, count, sum, squares, least and greatest.

    Groups without a value have no state.
    """
    number = F.col(value).cast("double")
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(number, F.lit(size)).alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.sum(number).alias("total"),
        F.sum(number * number).alias("squares"),
        F.min(number).alias("least"),
        F.max(number).alias("greatest"),
    )


def merge_states(states: DataFrame, keys: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """The states of coarser groups, for instance of a meter from those of its days."""
    return states.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"),
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("squares"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )


def state_quantiles(states: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """``states`` with a quantile for each of ``probs``: the least value whose share of values up to it
    is that much, within the sketch's rank error."""
    return states.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in probs.items()})


def state_moments(states: DataFrame) -> DataFrame:
    """``states`` with mean and sample deviation; a single value has no deviation."""
    mean = F.col("total") / F.col("n")
    spread = F.greatest(F.col("squares") - F.col("total") * mean, F.lit(0.0))
    constant = F.col("least") == F.col("greatest")
    deviation = F.when(constant, 0.0).otherwise(F.sqrt(spread / (F.col("n") - 1)))
    return states.withColumns({"mean": mean, "deviation": F.when(F.col("n") > 1, deviation)})
