"""Where rows lie inside a day: near others of their meter and of their time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs of id bits, each followed by one bit of the time of day, from the highest down.
LEVELS = 6
#: Levels that tell the cells apart by which rows are dealt to tasks: 64 stretches of ids, 8 of the day.
CELL_LEVELS = 3


def interleaved(id_col: str, moment: str) -> Column:
    """Bits of the id's hash and of the time of day, two to one, as one number to sort by."""
    ids = F.shiftrightunsigned(F.xxhash64(id_col), 64 - 2 * LEVELS)
    minute = F.hour(moment) * 60 + F.minute(moment)
    time = F.floor(minute * (1 << LEVELS) / 1440).cast("bigint")
    place = F.lit(0).cast("bigint")
    for level in range(LEVELS):
        pair = F.shiftright(ids, 2 * (LEVELS - 1 - level)).bitwiseAND(F.lit(3))
        bit = F.shiftright(time, LEVELS - 1 - level).bitwiseAND(F.lit(1))
        place = F.shiftleft(place, 3).bitwiseOR(F.shiftleft(pair, 1)).bitwiseOR(bit)
    return place


def clustered(rows: DataFrame, part: str, id_col: str, moment: str) -> DataFrame:
    """Dealt by partition and cell and sorted by the interleaved bits, so that a row group holds few meters
    and hours. Adaptive execution joins small cells and splits large ones; nothing is sampled."""
    at = interleaved(id_col, moment)
    cell = F.shiftright(at, 3 * (LEVELS - CELL_LEVELS))
    placed = rows.withColumns({"_place": at, "_cell": cell})
    return placed.hint("rebalance", part, "_cell").sortWithinPartitions(part, "_place").drop("_place", "_cell")
