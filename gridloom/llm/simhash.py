"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at three or fewer differing bits. Two 31-bit parts of a
fingerprint carry anchors: the words of the perfect Hamming code [31, 26], so every part lies
within one bit (the covering radius) of exactly one anchor, its home. Of two linked
fingerprints one part differs in one bit at most; there, one of them lies within radius plus
one of the other's home. So each fingerprint is replicated to all anchors within two bits of
each part, at most 16, and compared per anchor with those at home there.

Equal fingerprints are one before anything is replicated. An anchor with more than
``cell_rows`` fingerprints is split into blocks that are compared pairwise in tasks of their
own. A task keeps a spanning forest of an anchor's links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import apart, slices, staged
from gridloom.llm.components import components

PART_BITS, PARTS = 31, (0, 31)
#: Differing bits that link. The two parts and the code serve three; fewer are found as well.
MAX_BITS = 3
#: Cells up to this size are compared all at once, larger ones one by one.
SMALL = 8

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned majority bits over the hashes of all word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [_hash(joined)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes = [_hash(joined[a : b - 1]) for a, b in zip(starts, ends[shingle - 1 :])]
    n, counts = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with ``_fingerprint`` (the 64 bits as a signed bigint)."""
    names = docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 1 << 20):
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(text_col)]
            column = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*names, "_fingerprint"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kept}, _fingerprint bigint")


def _syndromes(parts: np.ndarray) -> np.ndarray:
    """Place (from 1) of the bit that leads each part to its nearest code word, 0 for none."""
    out = np.zeros(len(parts), np.int64)
    for j in range(1, PART_BITS + 1):
        out ^= np.where((parts >> (j - 1)) & 1, j, 0)
    return out


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, row of ``prints``, at home?) for all anchors within two bits of either part."""
    cells, rows, homes = [], [], []
    number = np.arange(len(prints))
    for k, shift in enumerate(PARTS):
        parts = ((prints.view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << PART_BITS) - 1)).astype(np.int64)
        place = _syndromes(parts)
        base = np.int64(k) << PART_BITS

        def add(word: np.ndarray, which: np.ndarray, home: bool) -> None:
            cells.append(base | word)
            rows.append(which)
            homes.append(np.full(len(which), home))

        add(np.where(place > 0, parts ^ (1 << np.maximum(place - 1, 0)), parts), number, True)
        for a in range(1, PART_BITS + 1):  # two bits whose places sum to the syndrome's
            b = place ^ a
            which = np.flatnonzero((place > 0) & (a < b))
            add(parts[which] ^ (1 << (a - 1)) ^ (1 << (b[which] - 1)), which, False)
    return np.concatenate(cells), np.concatenate(rows), np.concatenate(homes)


def _visits(prints: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False)
            cell, row, home = anchors(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(found[row]), pa.array(home)], ["cell", "print", "home"]
            )

    return prints.mapInArrow(run, "cell bigint, print bigint, home boolean")


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(homes: np.ndarray, visitors: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join all that ``homes`` x ``visitors`` links join: a breadth-first tree each."""
    near = np.empty((len(homes), len(visitors)), bool)
    for k, h in enumerate(homes):
        near[k] = _differing(visitors, h) <= max_bits
    links, new_home, new_visitor = [], np.ones(len(homes), bool), np.ones(len(visitors), bool)
    for seed in range(len(homes)):
        queue = [seed] if new_home[seed] else []
        new_home[seed] = False
        while queue:
            h = queue.pop()
            for v in np.flatnonzero(near[h] & new_visitor).tolist():
                new_visitor[v] = False
                links.append((int(homes[h]), int(visitors[v])))
                for other in np.flatnonzero(near[:, v] & new_home).tolist():
                    new_home[other] = False
                    links.append((int(homes[other]), int(visitors[v])))
                    queue.append(other)
    return links


def _cell_links(max_bits: int):
    """Links of the cells in batches sorted by cell; the last cell waits for the next batch."""

    def of_rows(key: np.ndarray, prints: np.ndarray, home: np.ndarray, visitor: np.ndarray) -> np.ndarray:
        edges = np.flatnonzero(np.r_[True, np.any(key[1:] != key[:-1], axis=1), True])
        sizes = np.diff(edges)
        small = np.repeat(sizes <= SMALL, sizes)
        group = np.repeat(np.arange(len(sizes)), sizes)
        found = []
        for d in range(1, SMALL):
            same = (group[:-d] == group[d:]) & small[d:]
            same &= (home[:-d] & visitor[d:]) | (visitor[:-d] & home[d:])
            at = np.flatnonzero(same)
            at = at[_differing(prints[at], prints[at + d]) <= max_bits]
            found.append(np.stack([prints[at], prints[at + d]], 1))
        for g in np.flatnonzero(sizes > SMALL):
            part = slice(edges[g], edges[g + 1])
            p, h, v = prints[part], home[part], visitor[part]
            found.append(np.array(forest(p[h], p[v], max_bits), np.int64).reshape(-1, 2))
        links = np.sort(np.concatenate(found), axis=1)
        return np.unique(links[links[:, 0] != links[:, 1]], axis=0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            block = np.stack([c.cast(pa.int64()).to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            if held and np.array_equal(held[-1][-1, :3], block[-1, :3]):
                held.append(block)
                continue
            rows = np.concatenate([*held, block])
            ends = np.flatnonzero(np.any(rows[:, :3] != rows[-1, :3], axis=1))
            cut = ends[-1] + 1 if len(ends) else 0
            held = [rows[cut:]]
            if cut:
                yield _batch(of_rows(rows[:cut, :3], rows[:cut, 3], rows[:cut, 4] > 0, rows[:cut, 5] > 0))
        if held:
            rows = np.concatenate(held)
            yield _batch(of_rows(rows[:, :3], rows[:, 3], rows[:, 4] > 0, rows[:, 5] > 0))

    return run


def _batch(links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], ["a", "b"])


def links(prints: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = 2048) -> DataFrame:
    """``a`` < ``b``: links whose components are those of all pairs of distinct ``prints`` with
    ``max_bits`` or fewer differing bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    visits = _visits(prints)
    crowded = (
        visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_rows)
        .select("cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks"))
    )
    placed = visits.join(crowded, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    alone = placed.filter("blocks = 1").select("cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "print", "home", F.lit(True).alias("visitor"))
    hot = placed.filter("blocks > 1")
    as_home = hot.filter("home").select("cell", own.alias("i"), F.explode(others).alias("j"), "print", F.lit(True).alias("home"), F.lit(False).alias("visitor"))
    as_visitor = hot.select("cell", F.explode(others).alias("i"), own.alias("j"), "print", F.lit(False).alias("home"), F.lit(True).alias("visitor"))
    keys = ["cell", "i", "j"]
    dealt = alone.unionByName(as_home).unionByName(as_visitor).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_cell_links(max_bits), "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row for each row.

    A component is what linked fingerprints reach; its id is the least id in it. A null text
    has no words, like an empty one, and their fingerprint zero is linked as any other. A null
    id is never a component's id unless the component has no other. Repeated rows are rows of
    one component. An empty table gives no rows.
    """
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    prints = staged(with_fingerprint(ids, "_text", shingle).drop("_text"), "prints")
    reached = component_of(prints, max_bits)
    return prints.join(reached, "_fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("_fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def component_of(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``_fingerprint``, ``component_id`` and ``_root`` for each distinct fingerprint of ``prints``
    (``doc_id``, ``_fingerprint``)."""
    known = staged(prints.groupBy("_fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(known.select("_fingerprint"), max_bits))
    rooted = staged(
        known.join(roots.withColumnRenamed("node", "_fingerprint"), "_fingerprint", "left")
        .select("_fingerprint", "least", F.coalesce("root", "_fingerprint").alias("_root")),
        "roots",
    )
    least = rooted.groupBy("_root").agg(F.min("least").alias("component_id"))
    return rooted.drop("least").join(least, "_root")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one document of each component of :func:`near_duplicates`: that with the least id, once.

    The rows to keep are settled on ids and checksums of texts; texts are shuffled once, to meet them.
    A null id stays only where a component has no other. Of rows with the least id and different
    texts one stays, of equal rows too. An empty table gives no rows. Columns of any name pass.
    """
    inner, back = apart(docs, _id=id_col, _text=text_col)
    keyed = inner.select(F.col("_id").alias("doc_id"), "_text", F.xxhash64("_text").alias("_key"))
    prints = staged(with_fingerprint(keyed, "_text", shingle).drop("_text"), "prints")
    least = prints.join(component_of(prints.drop("_key"), max_bits), "_fingerprint").filter(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    rows = least.groupBy("_root", "doc_id", "_key").agg(F.count(F.lit(1)).alias("_copies"))
    kept = staged(
        rows.groupBy("_root").agg(F.min(F.struct("doc_id", "_key", "_copies")).alias("k"))
        .select(F.col("k.doc_id").alias("_kept"), F.col("k._key").alias("_kept_key"), "k._copies"), "kept",
    )
    same = F.col("_id").eqNullSafe(F.col("_kept")) & (F.xxhash64("_text") == F.col("_kept_key"))
    found = inner.join(kept, same)
    if kept.filter("_copies > 1").isEmpty():
        return back(found)
    once = found.filter("_copies > 1").dropDuplicates(["_id", "_kept_key"])
    return back(found.filter("_copies = 1").unionByName(once))
