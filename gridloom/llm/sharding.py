"""Minimax contiguous partition of documents into shards of near equal bytes.

Equal texts form one atomic group; groups stand in the order of their text's hash. The
smallest feasible shard capacity is binary-searched, each try checked greedily over the
running sums of the ordered sizes, and the shards are cut there.

The driver never sees the groups. It holds sums over ranges of the hash order and splits
only those ranges in which a greedy cut can fall, until each of them is one group; that is
about ``shards ** 2 * 256`` sums a round at any size of the input. A cut is a hash value,
so documents get their shard from a comparison, without a join. DataFrame operations only.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import staged

#: Bits of the hash order, and by how many a range is split in a round.
ORDER_BITS, SPLIT_BITS = 60, 8
#: Rows of a shard are numbered in so many parts.
SLOT_PARTS = 4096


def order_of(text_col: str = "text") -> Column:
    """Place of a text in the order of groups; a null text is the empty one."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 64 - ORDER_BITS)


def size_of(text_col: str = "text") -> Column:
    """UTF-8 bytes and one for the end; a null text has none."""
    return (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("bigint")


@dataclass(frozen=True)
class Range:
    """Hash values [low, low + 2 ** bits) with the bytes of their documents."""

    low: int
    bits: int
    size: int
    single: bool


def _sums(sized: DataFrame, ranges: Sequence[tuple[int, int]], bits: int) -> list[Range]:
    """Sums over all ranges of ``bits`` hash bits inside ``ranges`` that hold rows."""
    inside = F.lit(False)
    for low, high in ranges:
        inside |= F.col("_order").between(low, high)
    found = (
        sized.filter(inside)
        .groupBy(F.shiftright("_order", bits).alias("at"))
        .agg(F.sum("_size").alias("size"), F.min("_order").alias("a"), F.max("_order").alias("b"))
        .collect()
    )
    return sorted((Range(r["at"] << bits, bits, r["size"], r["a"] == r["b"]) for r in found), key=lambda x: x.low)


def greedy_cuts(sums: Sequence[int], capacity: int, shards: int) -> list[int] | None:
    """Cuts as indexes into the running ``sums`` (from 0), or None if more shards are needed."""
    cuts, at, end = [], 0, len(sums) - 1
    for _ in range(shards):
        reach = bisect_right(sums, sums[at] + capacity) - 1
        if reach == end:
            return cuts
        if reach == at:
            return None
        cuts.append(at := reach)
    return None


def least_capacity(sums: Sequence[int], shards: int, low: int) -> int:
    """Smallest capacity of at least ``low`` that the greedy check accepts."""
    high = max(low, sums[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(sums, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return high


def even_cuts(sums: Sequence[int], capacity: int, shards: int) -> list[int]:
    """Cuts under ``capacity``, each as near as it may be to an even share of what is left.

    The greedy cuts fill the first shards and may leave the last ones empty; each cut here
    lies between the last place from which the rest still fits and the greedy place.
    """
    latest, at = [0] * (shards + 1), len(sums) - 1
    for j in range(shards, 0, -1):  # from the end: where shard j - 1 may begin at the earliest
        latest[j] = at
        at = bisect_left(sums, sums[at] - capacity)
    cuts, at = [], 0
    for j in range(1, shards):
        goal = sums[at] + (sums[-1] - sums[at]) / (shards - j + 1)
        near = bisect_left(sums, goal)
        if near > at and goal - sums[near - 1] <= (sums[near] if near < len(sums) else goal * 2) - goal:
            near -= 1
        reach = bisect_right(sums, sums[at] + capacity) - 1
        at = min(max(near, latest[j], at), reach)
        cuts.append(at)
    return cuts


def find_cuts(sized: DataFrame, shards: int = 16) -> tuple[list[int], int]:
    """(hash values at which the shards 1, 2, ... begin, capacity) for rows of ``_order`` and
    ``_size``. Cuts are fewer than ``shards - 1`` where there is nothing to cut."""
    bits = ORDER_BITS - SPLIT_BITS
    parts = _sums(sized, [(0, (1 << ORDER_BITS) - 1)], bits)
    if not parts:
        return [], 0
    while True:
        sums = [0, *accumulate(p.size for p in parts)]
        low = max([-(-sums[-1] // shards), *(p.size for p in parts if p.single)])
        high = least_capacity(sums, shards, low)
        wanted: list[list[int]] = []  # one stretch of the order for each cut, at most
        bits = 0
        if low < high:
            # The j-th greedy cut lies between these for any capacity from low to high.
            first, last = 0, 0
            for _ in range(shards - 1):
                first = bisect_right(sums, sums[first] + low) - 1
                last = min(last + high, sums[-1])
                split = [p for p in parts[first : bisect_left(sums, last) + 1] if not p.single]
                if split:
                    bits = max(bits, *(p.bits for p in split))
                    a, b = split[0].low, split[-1].low + (1 << split[-1].bits) - 1
                    if wanted and a <= wanted[-1][1] + 1:
                        wanted[-1][1] = max(b, wanted[-1][1])
                    else:
                        wanted.append([a, b])
        if not wanted:
            break
        bits -= SPLIT_BITS
        finer = _sums(sized, wanted, max(bits, 0))
        inside = lambda p: any(a <= p.low <= b for a, b in wanted)
        parts = sorted([*(p for p in parts if not inside(p)), *finer], key=lambda p: p.low)
    return [parts[k].low for k in even_cuts(sums, high, shards) if k < len(parts)], high


def shard_of(cuts: Sequence[int], order: Column) -> Column:
    """Number of cuts at or below a document's place in the order."""
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (order >= F.lit(cut)).cast("int")
    return shard


def with_slots(rows: DataFrame, shard_col: str, id_col: str, *more: str) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, by parts hashed from the id.

    Only the parts' counts, ``SLOT_PARTS`` a shard at most, are summed in order.
    """
    part = F.pmod(F.xxhash64(id_col, *more), F.lit(SLOT_PARTS)).alias("_part")
    rows = rows.select("*", part)
    before = Window.partitionBy(shard_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(shard_col, "_part").agg(F.count(F.lit(1)).alias("_n"))
        .select(shard_col, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(shard_col, "_part").orderBy(id_col, *more)
    return (
        rows.withColumn("_at", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), [shard_col, "_part"])  # at most shards * SLOT_PARTS rows
        .withColumn("slot", (F.col("_before") + F.col("_at")).cast("bigint"))
        .drop("_part", "_before", "_at")
    )


def assign_shards(docs: DataFrame, shards: int = 16, text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard``. All columns stay; a column named ``shard`` is replaced.

    Equal texts share a shard; a null text counts as an empty one. An empty table gives no
    rows; fewer groups than shards leave shards empty.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    sized = staged(docs.select(order_of(text_col).alias("_order"), size_of(text_col).alias("_size")), "sizes")
    cuts, _ = find_cuts(sized, shards)
    return docs.withColumn("shard", shard_of(cuts, order_of(text_col)))


def shard_digest(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each document goes: size, text checksum, shard and gapless slot.

    Texts are read once; what follows works on a staged row of 32 bytes a document. Rows with
    a null or repeated id keep slots of their own.
    """
    sized = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            size_of(text_col).alias("_size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit(""))).alias("text_crc32"),
            order_of(text_col).alias("_order"),
        ),
        "sizes",
    )
    cuts, _ = find_cuts(sized, shards)
    placed = with_slots(sized.withColumn("shard", shard_of(cuts, F.col("_order"))), "shard", "doc_id", "_order")
    return placed.select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
