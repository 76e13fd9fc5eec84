"""Ranked lexical search by NRA: sequential reads of impact-sorted lists.

A first pass counts the query terms of each document; document frequencies and lengths give
every posting its impact, its whole share of a score in integers. Then each task takes its
documents in blocks of bounded postings, sorts the postings of each term by falling impact, and
reads the lists of a query in step. A document has an interval: below, what was read of it;
above, that plus the next impact of every list in which it was not yet met. Reading goes on until no
unread document and no other interval reaches the k-th best and the documents that do have
closed intervals, ties among them included. The best of earlier blocks raise the bar for later
ones, so most lists are left early. A task passes on ``k`` documents a query.

Postings are never shuffled. Queries reach the tasks in blocks of at most about ``block_bytes`` of
text, one pass over the documents each, so neither the driver nor a task holds more of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import slices, staged, text_buffers

#: Postings that a task sorts at once.
CELL = 1 << 20
#: Depth of the first reads of a list, and how much deeper each next one goes.
FIRST, STEP = 128, 4
NULL = np.iinfo(np.int64).min
#: Terms are letters, digits and all that is not ASCII; everything else is a blank.
TERMS = bytes(
    (b | 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
RESULT = "item_id bigint, doc_id bigint, score bigint"


def _parts(raw: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of translated bytes, some at a time."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + size)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def term_counts(text: str | None) -> Counter[bytes]:
    counts: Counter[bytes] = Counter()
    for terms in _parts((text or "").encode().translate(TERMS)):
        counts.update(terms)
    return counts


def count_terms(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n`` (terms) and, of the terms with a ``number``, ``terms`` and ``times``, for each
    row of ``docs`` (``doc_id``, ``text``) that has a term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.get
        for batch in slices(batches, "text", 1 << 20):
            raw, bounds = text_buffers(batch.column("text"))
            raw = raw.tobytes().translate(TERMS)
            lengths, ends, terms, times = [], [0], [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                n, found = 0, Counter()
                for part in _parts(raw[a:b]):
                    n += len(part)
                    found.update(map(get, part))
                found.pop(None, None)
                lengths.append(n)
                terms.extend(found.keys())
                times.extend(found.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                ],
                ["doc_id", "n", "terms", "times"],
            )
            yield out.filter(pa.array(np.array(lengths) > 0))

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, times array<bigint>")


@dataclass
class Corpus:
    documents: int
    terms: int
    weights: np.ndarray  # of each numbered term

    def impacts(self, term: np.ndarray, times: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The share of a score that one occurrence of the term in a query takes from a document."""
        if 25 * int(n.max(initial=0)) * self.documents < 1 << 63:
            long = 25 * n * self.documents // self.terms
        else:
            long = np.array([25 * int(x) * self.documents // self.terms for x in n], np.int64)
        return self.weights[term] * (1_000_000_000 * times // (1000 * times + 12 * (75 + long)))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Cell:
    """Impact-sorted lists of a block of documents."""

    ids: np.ndarray
    starts: np.ndarray  # of each term's list, and the end
    docs: np.ndarray  # places in ids
    impacts: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, docs: np.ndarray, term: np.ndarray, impacts: np.ndarray, n_terms: int) -> Cell:
        order = np.lexsort((-impacts, term))
        starts = np.searchsorted(term[order], np.arange(n_terms + 1))
        return cls(ids, starts, docs[order], impacts[order])


@dataclass
class Best:
    """The ``k`` best documents of a query so far: falling scores, then rising ids."""

    k: int
    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls, k: int) -> Best:
        return cls(k, np.zeros(0, np.int64), np.zeros(0, np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]

    def bar(self, lower: np.ndarray) -> int:
        """The k-th best score so far, those of ``lower`` included; 0 while there are fewer."""
        known = np.r_[self.scores, lower]
        if len(known) < self.k:
            return 0
        return max(int(np.partition(known, len(known) - self.k)[len(known) - self.k]), 0)


def search(cell: Cell, terms: np.ndarray, times: np.ndarray, best: Best) -> int:
    """Puts the cell's documents that belong to the best among them; returns the postings read."""
    at, end = cell.starts[terms].copy(), cell.starts[terms + 1]
    lower = np.zeros(len(cell.ids), np.int64)
    met = np.zeros(len(cell.ids), bool)
    read_docs, read_list, depth, total = [], [], FIRST, 0
    while True:
        upto = np.minimum(at + depth, end)
        counts = upto - at
        if counts.any():
            # Places of the postings now read: at[l], at[l] + 1, ... for each list l.
            which = np.repeat(np.arange(len(terms)), counts)
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + at[which]
            docs = cell.docs[place]
            np.add.at(lower, docs, cell.impacts[place] * times[which])
            met[docs] = True
            read_docs.append(docs)
            read_list.append(which)
            total += len(docs)
        at, depth = upto, depth * STEP
        more = at < end
        ahead = np.zeros(len(terms), np.int64)
        ahead[more] = cell.impacts[at[more]] * times[more]
        unread = int(ahead.sum())
        seen = np.flatnonzero(met)
        bar = best.bar(lower[seen])
        if unread and unread >= bar:
            continue  # a document not met yet may belong to the best
        known = np.zeros(len(cell.ids), np.int64)
        for docs, which in zip(read_docs, read_list):
            np.add.at(known, docs, ahead[which])
        still = unread - known[seen]  # at most so much is to come
        able = lower[seen] + still >= max(bar, 1)
        if not unread or not still[able].any():
            found = seen[able]
            best.add(lower[found], cell.ids[found])
            return total


def _block_search(counted: DataFrame, queries: list[tuple], corpus: Corpus, k: int) -> DataFrame:
    """``item_id``, ``doc_id``, ``score``: each task's ``k`` best for each of ``queries`` (id, terms, times)."""
    n_terms = len(corpus.weights)

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[Cell]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ends = batch.column("terms").offsets.to_numpy()
                last = int(np.searchsorted(ends, ends[at] + CELL - size, "right")) - 1
                last = min(max(last, at + 1), batch.num_rows)
                held.append(batch.slice(at, last - at))
                size += int(ends[last] - ends[at])
                at = last
                if size >= CELL:
                    yield cell(held)
                    held, size = [], 0
            # A batch without query terms has no postings, but rows.
            if sum(b.num_rows for b in held) > CELL:
                yield cell(held)
                held, size = [], 0
        if held:
            yield cell(held)

    def cell(held: list[pa.RecordBatch]) -> Cell:
        rows = pa.Table.from_batches(held).combine_chunks()
        column = lambda name: rows.column(name).combine_chunks()
        per = np.diff(column("terms").offsets.to_numpy()) if rows.num_rows else np.zeros(0, np.int64)
        docs = np.repeat(np.arange(rows.num_rows), per)
        term = column("terms").flatten().to_numpy(zero_copy_only=False)
        times = column("times").flatten().to_numpy(zero_copy_only=False)
        impacts = corpus.impacts(term, times, column("n").to_numpy(zero_copy_only=False)[docs])
        ids = column("doc_id").fill_null(int(NULL)).to_numpy(zero_copy_only=False)
        return Cell.of(ids, docs, term, impacts, n_terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best.none(k) for _ in queries]
        for block in cells(batches):
            for (_, terms, times), mine in zip(queries, best):
                search(block, terms, times, mine)
        for start in range(0, len(queries), 1024):
            part = list(zip(queries[start : start + 1024], best[start : start + 1024]))
            found = np.concatenate([b.ids for _, b in part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([q[0] for q, b in part for _ in b.ids], pa.int64()),
                    pa.array(found, pa.int64(), mask=found == NULL),
                    pa.array(np.concatenate([b.scores for _, b in part]), pa.int64()),
                ],
                ["item_id", "doc_id", "score"],
            )

    return counted.mapInArrow(run, RESULT)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all tasks. Shares of each query's rows are cut first, so no task sorts them all."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))
    some = Window.partitionBy("item_id", "share").orderBy(*order)
    cut = found.withColumn("share", share).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return cut.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 4 << 20,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``k`` best documents of each item.

    A score sums the impacts of the item's terms, repeats included; only scores above 0 count,
    and equal ones stand by rising id, a null id first. Every row of ``docs`` is a document of its
    own. Equal rows of ``items`` are one item; different texts under one id, null too, are one
    item with the terms of all. A null text has no terms. An item without a hit and an empty
    table give no rows; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(
        F.col(item_id_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text")
    ).filter("text IS NOT NULL").distinct()
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    placed = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    results = []
    for block in range(blocks):
        rows = placed.filter(F.col("block") == block).select("item_id", "text").collect()
        results.append(_one_block(texts, [tuple(r) for r in rows], k))
    results = [r for r in results if r is not None]
    if not results:
        return texts.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, results)


def _one_block(texts: DataFrame, items: list[tuple], k: int) -> DataFrame | None:
    wanted: dict[int | None, Counter[bytes]] = {}
    for item, text in items:
        wanted.setdefault(item, Counter()).update(term_counts(text))
    number = {term: i for i, term in enumerate(sorted(set().union(*wanted.values())))} if wanted else {}
    if not number:
        return None
    counted = staged(count_terms(texts, number), "counted")
    # One row for each term of the block, and the two sums.
    sums = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = np.zeros(len(number), np.int64)
    for term, n in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).toLocalIterator():
        holding[term] = n
    if not sums[0]:
        return None
    corpus = Corpus(sums[0], sums[1], np.array([weight(sums[0], int(d)) for d in holding], np.int64))
    queries = []
    for item, counts in wanted.items():
        use = [(number[t], n) for t, n in counts.items() if holding[number[t]] and corpus.weights[number[t]]]
        if use:
            terms, times = (np.array(x, np.int64) for x in zip(*sorted(use)))
            queries.append((item, terms, times))
    if not queries:
        return None
    return _ranked(staged(_block_search(counted, queries, corpus, k), "best"), k)
