from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.llm import catalog, sharding

SF = "/root/testdata/sf0.01"


def brute_capacity(sizes, shards):
    """Smallest largest part over all contiguous partitions, by dynamic programming."""
    sums, n = [0, *accumulate(sizes)], len(sizes)
    best = [0] + [float("inf")] * n
    for _ in range(shards):
        best = [min(max(best[i], sums[j] - sums[i]) for i in range(j + 1)) for j in range(n + 1)]
    return best[n]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=30), st.integers(1, 8))
def test_capacity_and_cuts(sizes, shards):
    sums = [0, *accumulate(sizes)]
    capacity = sharding.least_capacity(sums, shards, -(-sums[-1] // shards))
    assert capacity == brute_capacity(sizes, shards)
    edges = [0, *sharding.even_cuts(sums, capacity, shards), len(sizes)]
    assert len(edges) == shards + 1 and edges == sorted(edges)
    assert all(sums[b] - sums[a] <= capacity for a, b in zip(edges, edges[1:]))


@pytest.mark.parametrize("split_bits", [2, 8])
@pytest.mark.parametrize("hot", [0, 400])
def test_search_by_ranges_is_exact(spark, monkeypatch, split_bits, hot):
    monkeypatch.setattr(sharding, "SPLIT_BITS", split_bits)
    rows = spark.range(600).select(
        F.shiftrightunsigned(F.xxhash64(F.greatest(F.col("id"), F.lit(hot))), 4).alias("_order"),
        (F.pmod(F.xxhash64(F.col("id") + 1), F.lit(90)) + 1).alias("_size"),
    ).cache()
    groups = defaultdict(int)
    for r in rows.collect():
        groups[r["_order"]] += r["_size"]
    sizes = [groups[k] for k in sorted(groups)]
    cuts, capacity = sharding.find_cuts(rows, 16)
    assert capacity == brute_capacity(sizes, 16)
    filled = Counter()
    for order, size in groups.items():
        filled[sum(order >= c for c in cuts)] += size
    assert max(filled.values()) <= capacity and set(filled) <= set(range(16))


def check(docs, got, shards=16):
    texts = defaultdict(list)
    for doc, text in docs:
        texts[doc].append((len((text or "").encode()) + 1, zlib.crc32((text or "").encode()), text))
    assert Counter(r.doc_id for r in got) == Counter(doc for doc, _ in docs)
    for r in got:
        assert (r.size, r.text_crc32) in {t[:2] for t in texts[r.doc_id]}
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    slots, homes = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        homes[(r.size, r.text_crc32)].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_query(spark):
    got = catalog.op7_shard(spark, SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(docs, got)
    filled = Counter()
    for r in got:
        filled[r.shard] += r.size
    assert len(filled) == 16 and max(filled.values()) < 1.1 * sum(filled.values()) / 16


def test_odd_rows(spark):
    docs = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (2, None), (3, ""), (4, "é" * 100_000)]
    frame = spark.createDataFrame([(*d, 9) for d in docs], "doc_id bigint, text string, shard int")
    check(docs, sharding.shard_digest(frame).collect())
    out = sharding.assign_shards(frame, 3)
    assert out.columns == frame.columns and {r.shard for r in out.collect()} <= {0, 1, 2}
    assert sharding.shard_digest(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(frame, 0)


def test_no_python_in_the_plan(spark):
    plan = catalog.op7_shard(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
