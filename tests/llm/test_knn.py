from __future__ import annotations

import math

import numpy as np
import pytest

from gridloom.llm import catalog, knn
from tests.oracle import compare, duck


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_sql(spark, sf):
    where = f"/root/testdata/{sf}"
    difference, rows = compare(spark, duck(where), catalog.op10_knn, catalog.ORACLES["op10_knn"], where)
    assert difference is None and rows > 0


def brute(queries, data, k):
    out = []
    for q, a in sorted(dict(queries).items()):
        scores = sorted((-sum(x * y for x, y in zip(a, b)), d) for d, b in data if d != q)
        out += [(q, r + 1, d, -s) for r, (s, d) in enumerate(scores[:k])]
    return out


def run(spark, queries, data, **options):
    kind = "id bigint, vector array<bigint>"
    out = knn.top_k(spark.createDataFrame(queries, kind), spark.createDataFrame(data, kind), **options)
    return sorted(map(tuple, out.collect()))


def test_ties_hot_vector_and_blocks(spark):
    rng = np.random.default_rng(7)
    data = [(i, rng.integers(-30, 30, 5).tolist()) for i in range(300)]
    data += [(1000 + i, [9, 9, 9, 9, 9]) for i in range(200)] + [(2000, []), (2001, [40])]
    queries = [d for d in data if d[0] % 10 == 0]
    assert run(spark, queries, data, k=5, block_bytes=1200, pivots=4) == brute(queries, data, 5)
    assert run(spark, queries, data, k=5) == brute(queries, data, 5)


def test_repeated_ids_and_few_candidates(spark):
    data = [(1, [5, 5])] * 30 + [(2, [1, 0]), (3, [0, 1]), (4, [-1, -1])]
    queries = [(1, [5, 5]), (1, [5, 5]), (2, [1, 0])]
    assert run(spark, queries, data, k=3) == brute(queries, data, 3)
    assert run(spark, [(1, [1])], [(1, [1])]) == []
    assert run(spark, [], data) == [] and run(spark, queries, []) == []
    with pytest.raises(ValueError):
        run(spark, queries, data, k=0)


def test_products_beyond_floats_are_exact(spark):
    data = [(i, [2**31 + i, 2**30 - i]) for i in range(20)]
    assert run(spark, data[:3], data, k=4) == brute(data[:3], data, 4)
    small = [(0, [2**40, 0]), (1, [0, 2**40]), (2, [3, 4])]  # a bound is beyond 64 bits, no product is
    with pytest.raises(Exception, match="does not fit"):
        run(spark, small[:1], [*small, (3, [2**40, 0])], k=3)


def test_overflow_is_an_error(spark):
    data = [(0, [3 * 10**12] * 2), (1, [3 * 10**12] * 2)]
    with pytest.raises(Exception, match="does not fit a 64-bit integer"):
        run(spark, data, data)
    frame = spark.createDataFrame([(0, [1e300])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large for a 64-bit integer"):
        knn.integer_vectors(frame).collect()


def test_clustered_vectors_are_pruned(spark):
    """Each query meets its own cluster and few others."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, (24, 8))
    data = [(i, (centres[i % 24] + rng.integers(-20, 20, 8)).tolist()) for i in range(2400)]
    queries = [d for d in data if d[0] % 100 == 0]
    assert run(spark, queries, data) == brute(queries, data, 10)
    vectors, asked = (np.array([v for _, v in rows]) for rows in (data, queries))
    cell, far = knn._nearest(vectors, centres)
    groups = knn.Groups(centres, np.bincount(cell), np.array([far[cell == c].max() for c in range(24)]))
    kth = np.sort(asked @ vectors.T, axis=1)[:, -11].astype(float)  # the home group's, and its own row
    assert len(groups.visits(asked, None)[0]) + len(groups.visits(asked, kth)[0]) < 4 * len(queries)


def test_integer_vectors(spark):
    rows = [(0, [0.5, -0.0001]), (1, None), (2, [None, 1.0]), (3, [math.nan]), (4, [math.inf]), (None, [1.0]), (6, [])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, id int, vector string")
    got = sorted(((r.id, r.vector) for r in knn.integer_vectors(frame).collect()), key=str)
    assert got == sorted([(0, [512, -1]), (None, [1024]), (6, [])], key=str)
