from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import catalog, ranked
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=20):
    read = [(d, Counter(split(t)), len(split(t))) for d, t in docs]
    read = [r for r in read if r[2]]
    n_docs, n_terms = len(read), sum(r[2] for r in read)
    holding = Counter(t for _, c, _ in read for t in c)
    wanted = {}
    for item, text in set(items):
        wanted.setdefault(item, Counter()).update(split(text))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, counts, n in read:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(
                times * ranked.weight(n_docs, holding[t]) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t, times in terms.items() if counts[t]
            )
            if score > 0:
                scores.append((-score, doc is not None, doc or 0))
        for rank, (score, given, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, doc if given else None, -score))
    return sorted(out, key=str)


def got(docs, items, **options):
    return sorted((tuple(r) for r in ranked.rank_documents(docs, items, **options).collect()), key=str)


def test_query_equals_sql(spark):
    difference, n = compare(spark, duck(SF), catalog.op12_ranked, catalog.ORACLES["op12_ranked"], SF)
    assert difference is None and n == 800


@pytest.fixture
def corpus():
    rng = np.random.default_rng(4)
    vocab = [f"w{x}" for x in range(60)] + ["É", "x-y", "A", "", "..", "漢字"]
    pick = lambda n: " ".join(vocab[int(x)] for x in np.minimum(rng.zipf(1.3, n), len(vocab)) - 1)
    docs = [(int(rng.integers(0, 500)), pick(int(rng.integers(0, 60)))) for _ in range(700)]
    docs += [(k, "w1 w2 copy") for k in range(900, 1000)] + [(5, "w1 w2 copy"), (None, "w1 w2 copy"), (6, None), (7, "")]
    docs += [(8, "w3 " * 400_000)]
    items = [(k, pick(12)) for k in range(12)] + [(20, "copy"), (20, "copy"), (21, "none of it"), (22, None), (23, ""), (None, "w1 W1"), (24, "w4"), (24, "w5")]
    return docs, items


def test_all_documents(spark, corpus, monkeypatch):
    docs, items = corpus
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, n int, score string").repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    monkeypatch.setattr(ranked, "CELL", 500)
    assert got(frame, asked) == want
    assert got(frame, asked, block_bytes=40) == want  # queries in many blocks
    assert got(frame, asked, k=3) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{n} bigint, text string") for n in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    assert got(docs, items) == got(some, items) == got(docs, some.withColumnRenamed("doc_id", "item_id")) == []
    assert ranked.rank_documents(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_lists_are_left_early():
    rng = np.random.default_rng(8)
    n, terms = 20_000, 6
    docs = np.concatenate([rng.permutation(n)[: n // 2] for _ in range(terms)])
    term = np.repeat(np.arange(terms), n // 2)
    impacts = rng.zipf(1.5, len(docs)).clip(max=10**6).astype(np.int64)
    cell = ranked.Cell.of(np.arange(n), docs, term, impacts, terms)
    scores = np.zeros(n, np.int64)
    np.add.at(scores, docs, impacts)
    best = ranked.Best.none(20)
    ranked.search(cell, np.arange(terms), np.ones(terms, np.int64), best)
    order = np.lexsort((np.arange(n), -scores))[:20]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    # A second block whose documents cannot come near the best is left after the first reads.
    weak = ranked.Cell.of(np.arange(n) + n, docs, term, np.minimum(impacts, 2), terms)
    before = best.ids.tolist()
    assert ranked.search(weak, np.arange(terms), np.ones(terms, np.int64), best) <= terms * ranked.FIRST
    assert best.ids.tolist() == before
