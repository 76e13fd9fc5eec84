from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from gridloom.llm import catalog, quality

SF = "/root/testdata/sf0.1"


def brute_strength(groups):
    """groups: (rows, sum) of each; the pseudo-count by moments, as written in books."""
    total, k = sum(n for n, _ in groups), len(groups)
    if k < 2 or total <= k:
        return 1e6
    share = sum(s for _, s in groups) / total
    between = sum(n * (s / n - share) ** 2 for n, s in groups)
    spread = (between - (k - 1) * share * (1 - share)) / (total - sum(n * n for n, _ in groups) / total)
    return min(max(share * (1 - share) / max(spread, 1e-12) - 1, 1.0), 1e6)


def brute(rows, prior):
    """rows: (id, host, path, log odds)."""
    p = [1 / (1 + math.exp(-e)) for *_, e in rows]
    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for (_, h, s, _), x in zip(rows, p):
        for group in (hosts[h], paths[h, s]):
            group[0] += 1
            group[1] += x
    share = sum(p) / len(p)
    a, b = brute_strength(list(hosts.values())), brute_strength(list(paths.values()))
    out = []
    for (doc, h, s, e), x in zip(rows, p):
        host = (hosts[h][1] - x + a * share) / (hosts[h][0] - 1 + a)
        path = (paths[h, s][1] - x + b * host) / (paths[h, s][0] - 1 + b)
        inside = min(max(path, 1e-4), 1 - 1e-4)
        odds = e - math.log(prior / (1 - prior)) + math.log(inside / (1 - inside))
        out.append((doc, x, host, path, 1 / (1 + math.exp(-odds))))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_shares_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    lean = rng.normal(0, 2, 8)
    rows = []
    for i in range(400):
        h = int(rng.integers(0, 8)) if rng.random() < 0.6 else 0  # a hot host
        rows.append((i, f"h{h}", f"p{int(rng.integers(0, 3))}", float(rng.normal(lean[h], 1))))
    rows.append((400, "alone", "x", 3.0))
    frame = spark.createDataFrame(rows, "doc_id bigint, _host string, _path string, _evidence double")
    got = quality.join_sites(frame, 0.7).select("doc_id", "doc_score", "host_share", "path_share", "score")
    for x, y in zip(sorted(map(tuple, got.collect())), brute(rows, 0.7)):
        assert x == pytest.approx(y, rel=1e-9)


def test_sparse_sites_stand_near_their_parent(spark):
    rows = [(i, "good", "p", 3.0) for i in range(200)] + [(200 + i, "bad", "p", -3.0) for i in range(200)]
    rows += [(500, "new", "p", 0.0)]
    frame = spark.createDataFrame(rows, "doc_id bigint, _host string, _path string, _evidence double")
    got = {r.doc_id: r for r in quality.join_sites(frame, 0.5).collect()}
    assert got[0].path_share > 0.9 and got[200].path_share < 0.1 and abs(got[500].path_share - 0.5) < 0.02


def test_held_out_accuracy_on_the_query(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = catalog.op2_quality(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(labels[r.doc_id], r.keep) for r in got if r.held_out and r.doc_id in labels]
    kept = {y: np.mean([k for x, k in held if x == y]) for y in (0, 1)}
    assert kept[1] > 0.95 and kept[0] < 0.2, kept


def test_odd_rows(spark):
    docs = [(1, "a good text " * 5, "en", "s"), (1, "a good text " * 5, "en", "s"), (None, "%%% &&&", None, None),
            (3, None, "fr", None), (4, "", None, "s"), (5, "é" * 300_000, "en", "t")]
    frame = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id bigint, text string, lang string, source string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 0), (4, 0), (4, 1)], "doc_id bigint, quality int")
    for marks in (labels, labels.limit(0)):
        got = quality.quality(frame, marks).collect()
        assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert {r.path_share for r in got} == {0.5}
    assert quality.quality(frame.limit(0), labels).count() == 0
