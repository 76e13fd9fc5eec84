"""Exact top-k inner-product search as a Voronoi join.

Queries and data are integer vectors. Both are grouped by pivots: data by the nearest one, with
count and radius (the farthest vector's distance) of each group as its summary; queries by the
pivot that promises most. For a vector x of the group of pivot p with radius r, ``<q, x>`` is at
most ``<q, p> + r * |q|``. Each query is first solved in its home group. The k-th score found
there is its threshold, and the query is replicated to just those other groups whose bound
reaches it, so every true neighbour is met. Data are never replicated for a query: a group is
dealt once a phase.

A hot group is split into blocks of bounded bytes, and so are the queries; a merge of k rows a block and
query ends the search.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import staged

PACKED = "id bigint, vector binary"


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``id`` and ``vector``: floor(scale * x) of every component. Null vectors, and vectors that
    hold a null or non-finite component, are left out. A component beyond 64 bits is an error."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    wide = F.transform(vector_col, lambda x: x.cast("double"))
    return (
        rows.select(F.col(id_col).cast("bigint").alias("id"), wide.alias("vector"))
        .filter(F.col("vector").isNotNull() & F.forall("vector", finite))
        .withColumn("vector", F.transform("vector", lambda x: _whole(x * scale)))
    )


def _whole(x: Column) -> Column:
    beyond = F.raise_error(F.lit("a component is too large for a 64-bit integer")).cast("bigint")
    return F.when(F.abs(x) < float(1 << 63), F.floor(x)).otherwise(beyond)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Integer lists as rows of ``width``, shorter ones filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` and ``b``: by floats while they are exact, and an
    error where one does not fit 64 bits."""
    largest = np.abs(a.astype(float)).max(initial=0) * np.abs(b.astype(float)).max(initial=0) * max(1, a.shape[1])
    if largest < 2**53:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    if largest < 2**62:
        return a @ b.T
    whole = a.astype(object) @ b.T.astype(object)
    if whole.size and max(abs(whole.max()), abs(whole.min())) >= 1 << 63:
        raise OverflowError("an inner product does not fit a 64-bit integer")
    return whole.astype(np.int64)


def choose_pivots(vectors: DataFrame, width: int, count: int, sample: int) -> np.ndarray:
    """``count`` distinct vectors far from each other, out of a sample of ``sample`` distinct ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, ...], int] = {}
        for batch in batches:
            hashes = batch.column("h").to_pylist()
            for k in np.argsort(batch.column("h").to_numpy())[: 4 * sample].tolist():
                best[tuple(batch.column("vector")[k].as_py())] = hashes[k]
            best = dict(sorted(best.items(), key=lambda x: x[1])[:sample])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(best.values()), pa.int64()), pa.array([list(v) for v in best], pa.list_(pa.int64()))],
            ["h", "vector"],
        )

    least = vectors.select(F.xxhash64("vector").alias("h"), "vector").mapInArrow(run, "h bigint, vector array<bigint>")
    rows = least.distinct().orderBy("h").limit(sample).collect()
    found = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        found[k, : len(r.vector)] = r.vector
    if not len(found):
        return np.zeros((0, width), np.int64)
    chosen, distance = [0], ((found - found[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(found)) and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((found - found[chosen[-1]]) ** 2).sum(1))
    return found[chosen].astype(np.int64)


def _nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, distance) by rows."""
    v, p = vectors.astype(float), pivots.astype(float)
    squares = (v**2).sum(1)[:, None] - 2 * v @ p.T + (p**2).sum(1)
    cell = squares.argmin(1)
    return cell, np.sqrt(((v - p[cell]) ** 2).sum(1))


def _closest(legal: np.ndarray, scores: np.ndarray, k: int, least: int | None) -> np.ndarray:
    """Places of the k greatest scores among the legal ones, the first of equals; none below ``least``."""
    if least is not None:
        legal = legal[scores[legal] >= least]
    if len(legal) <= k:
        return legal
    floor = np.partition(scores[legal], len(legal) - k)[len(legal) - k]
    above = legal[scores[legal] > floor]
    return np.concatenate([above, legal[scores[legal] == floor][: k - len(above)]])


FOUND = "query_id bigint, vec_id bigint, score bigint"


@dataclass
class Groups:
    """Pivots, and the count and radius of the data of each."""

    points: np.ndarray
    counts: np.ndarray
    radius: np.ndarray

    def __post_init__(self) -> None:
        self.used = np.flatnonzero(self.counts)

    def bounds(self, vectors: np.ndarray) -> np.ndarray:
        """The most that a product with a vector of each used group can be."""
        middle = inner(vectors, self.points[self.used]).astype(float)
        reach = np.sqrt((vectors.astype(float) ** 2).sum(1))[:, None] * self.radius[self.used]
        return middle + reach * (1 + 1e-9) + np.abs(middle) * 1e-12 + 1e-6

    def visits(self, vectors: np.ndarray, least: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(place of a query, group): its home, or with thresholds the others that it must visit."""
        home = inner(vectors, self.points[self.used]).argmax(1)
        at = np.arange(len(home))
        if least is None:
            return at, self.used[home]
        wanted = self.bounds(vectors) >= least[:, None]
        wanted[at, home] = False
        which, group = np.nonzero(wanted)
        return which, self.used[group]


def top_k(
    queries: DataFrame,
    data: DataFrame,
    k: int = 10,
    pivots: int = 32,
    pivot_sample: int = 1024,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the k greatest inner products of
    each query among the data with another id; equal scores in order of ``vec_id``.

    ``queries`` and ``data`` hold ``id`` and an integer ``vector``. Shorter vectors count as filled
    up with zeros. A null id takes no part. A repeated data id gives a row each; a repeated
    query id is answered once. With fewer than k candidates all are returned, with none no row.
    A product beyond 64 bits is an error. Pivots come from a sample of ``pivot_sample`` vectors;
    they steer the work, not the result.
    """
    if k < 1:
        raise ValueError("k must be positive")
    data = data.filter("id is not null").select("id", "vector")
    queries = staged(queries.filter("id is not null").dropDuplicates(["id"]).select("id", "vector"), "queries")
    n, width = data.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    m, wide = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    width = max(width, wide, 1)
    if not n or not m:
        return queries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    points = choose_pivots(data, width, pivots, pivot_sample)
    rows = max(1, block_bytes // (8 * width))

    def to_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            cell, far = _nearest(vectors, points)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cell, pa.int32()), pa.array(far), pa.array([v.tobytes() for v in vectors], pa.binary())],
                ["id", "cell", "far", "vector"],
            )

    grouped = staged(data.mapInArrow(to_cells, "id bigint, cell int, far double, vector binary"), "vectors")
    counts, radius = np.zeros(len(points), np.int64), np.zeros(len(points))
    for r in grouped.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    blocks, parts = -(-counts // rows), -(-m // rows)
    groups = Groups(points, counts, radius)

    def visits(at_home: bool):
        """A row for each query and block of a group that it visits."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = _matrix(batch.column("vector"), width)
                least = pa.nulls(len(vectors), pa.int64()) if at_home else batch.column("least")
                known = least.cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy(zero_copy_only=False)
                which, cell = groups.visits(vectors, None if at_home else known)
                times = blocks[cell]
                which, cell = np.repeat(which, times), np.repeat(cell, times)
                block = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                raw = pa.array([v.tobytes() for v in vectors], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), pa.array(block, pa.int32()), batch.column("id").take(pa.array(which)),
                     least.take(pa.array(which)), raw.take(pa.array(which))],
                    ["cell", "block", "id", "least", "vector"],
                )

        return run

    def solve(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(d):
            d = d.sort_values("id")
            ids, own = d["id"].to_numpy(), q["id"].to_numpy()
            least = [None if pd.isna(x) else int(x) for x in q["least"].astype(object)]
            b = np.frombuffer(b"".join(d["vector"]), np.int64).reshape(len(d), width)
            a = np.frombuffer(b"".join(q["vector"]), np.int64).reshape(len(q), width)
            for at in range(0, len(q), 64):
                scores = inner(a[at : at + 64], b)
                for x, low, row in zip(own[at : at + 64], least[at : at + 64], scores):
                    found = _closest(np.flatnonzero(ids != x), row, k, low)
                    out.append(pd.DataFrame({"query_id": x, "vec_id": ids[found], "score": row[found]}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})

    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")
    block = F.pmod(F.xxhash64("id"), F.get(F.lit([max(int(x), 1) for x in blocks]), F.col("cell"))).cast("int").alias("block")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(int(parts) - 1))).alias("part")
    dealt = grouped.select("cell", block, every_part, "id", "vector")
    keys = ["cell", "block", "part"]

    def searched(asked: DataFrame, at_home: bool) -> DataFrame:
        visiting = asked.mapInArrow(visits(at_home), "cell int, block int, id bigint, least bigint, vector binary")
        left = visiting.select("cell", "block", part, "id", "least", "vector")
        return left.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(solve, FOUND)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    home = staged(best(searched(queries, True)), "home")
    least = home.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    others = searched(queries.join(least, "id", "left").select("id", "vector", "least"), False)
    return best(home.drop("rank").unionByName(others)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
