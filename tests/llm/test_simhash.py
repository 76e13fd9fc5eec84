from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import catalog, simhash
from gridloom.llm.components import components

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_roots(values):
    """Least value reachable over links of three or fewer bits."""
    values, root = sorted(set(values)), {}
    for v in values:
        if v in root:
            continue
        root[v], queue = v, [v]
        while queue:
            x = queue.pop()
            for y in values:
                if y not in root and (x ^ y).bit_count() <= 3:
                    root[y] = v
                    queue.append(y)
    return root


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_anchors_cover_every_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        x = int(rng.integers(0, 1 << 63)) << 1
        y = x
        for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
            y ^= 1 << int(b)
        both = np.array([x, y], np.uint64).view(np.int64)
        cell, row, home = simhash.anchors(both)
        at = [{int(c) for c, r in zip(cell, row) if r == k} for k in (0, 1)]
        assert {int(c) for c, r, h in zip(cell, row, home) if r == 0 and h} & at[1]
        assert max(map(len, at)) <= 32 and home.sum() == 4


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: brute_print(r.text) for r in docs}
    root = brute_roots(prints.values())
    least = {}
    for doc, p in prints.items():
        least[root[p]] = min(least.get(root[p], doc), doc)
    want = sorted((doc, f"{p:016x}", least[root[p]]) for doc, p in prints.items())
    got = sorted(map(tuple, catalog.op1_simhash(spark, SF).collect()))
    assert got == want and len(least) < len(docs)


@pytest.mark.parametrize("cell_rows", [1, 7, 2048])
def test_links_join_what_all_pairs_join(spark, cell_rows):
    rng = np.random.default_rng(6)
    values = {0}
    for _ in range(12):  # chains of close values, and one crowd around a centre
        x = int(rng.integers(0, 1 << 63)) * 2
        for _ in range(int(rng.integers(1, 12))):
            values.add(x)
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                x ^= 1 << int(b)
    for _ in range(60):
        values.add(sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)))
    frame = spark.createDataFrame([(signed(v),) for v in values], "_fingerprint bigint")
    found = simhash.links(frame, cell_rows=cell_rows).collect()
    true = {tuple(sorted((signed(a), signed(b)))) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= 3}
    assert {(r.a, r.b) for r in found} <= true

    def groups(pairs):
        root = {signed(v): signed(v) for v in values}

        def top(v):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in pairs:
            root[max(top(a), top(b))] = min(top(a), top(b))
        return {v: top(v) for v in root}

    assert groups((r.a, r.b) for r in found) == groups(true)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 100), (5, 5), (200, 300), (300, 400)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert got == {**{k: 0 for k in range(41)}, 90: 90, 100: 90, 200: 200, 300: 200, 400: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(70_000))
    docs = [(5, "A b C d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (7, None), (8, ""), (9, " \t"),
            (10, "one"), (11, "one two"), (12, long), (None, "x y z q"), (13, "Éa éb c")]
    frame = spark.createDataFrame([(*d, 0) for d in docs], "doc_id bigint, text string, cell int")
    got = simhash.near_duplicates(frame).collect()
    assert len(got) == len(docs)
    prints = {t: f"{brute_print(t):016x}" for _, t in docs}
    assert sorted(r.fingerprint for r in got) == sorted(prints[t] for _, t in docs)
    of = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert of[5, prints["a b c d"]] == of[None, prints["a b c d"]] == 3
    assert of[7, "0" * 16] == of[9, "0" * 16] == 7 and of[None, prints["x y z q"]] is None
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 7, 10, 11, 12, None, 13], key=str)
    assert simhash.near_duplicates(frame.limit(0)).count() == 0
    assert simhash.keep_one(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(frame, max_bits=4)


def test_stage(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.keep_one_of_each(spark, docs, sf)
    assert out.columns == docs.columns
    groups = catalog.op1_simhash(spark, sf).agg(F.count_distinct("component_id")).first()[0]
    assert out.count() == groups
