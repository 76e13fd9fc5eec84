from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

import corpus_pipeline
from gridloom.llm import catalog, decontaminate
from gridloom.llm.fm_index import FMIndex

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, benchmark, window=10):
    windows = {}
    for item, text in benchmark:
        words = split(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if size else ():
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, items = split(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    items |= found
        listed = sorted(str(i) for i in items if i is not None)
        out.append((doc, len(words), len(hit), len(listed),
                    hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = rng.integers(0, 4, rng.integers(1, 80))
        index = FMIndex(text, 3, sample=5)
        patterns = rng.integers(1, 4, (6, 4))
        lengths = rng.integers(1, 5, 6)
        low, high = index.search(patterns, lengths)
        for row, length, a, b in zip(patterns, lengths, low, high):
            pattern = row[4 - length :]
            want = [i for i in range(len(text) - length + 1) if (text[i : i + length] == pattern).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_query_equals_brute_force(spark):
    got = catalog.op8_decontaminate(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    assert ordered(got) == ordered(brute(docs, benchmark))
    assert any(r.contaminated for r in got)


@pytest.fixture
def odd(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    docs = [
        (1, passage, 7), (1, passage, 7), (2, None, None), (3, "", 0), (None, passage.upper(), 1),
        (4, "x " * 30_000 + passage + " y" * 5, 2), (5, "w0 w1 w2", 3), (6, "Straße ÉTÉ", 4), (7, "w13", 5),
    ]
    items = [(10, passage), (10, passage), (9, "straße"), (None, "w1 w2"), (11, None), (12, "..."), (13, "w13")]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, item_id int"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_odd_rows(odd, block_bytes):
    docs, items = odd
    found = decontaminate.find_contamination(docs, items, block_bytes=block_bytes)
    want = brute([(r[0], r[1]) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert ordered(decontaminate.digest(found).collect()) == ordered(want)
    assert found.columns[:3] == docs.columns


def test_empty_tables(spark, odd):
    docs, items = odd
    assert decontaminate.digest(decontaminate.find_contamination(docs.limit(0), items)).count() == 0
    none = decontaminate.digest(decontaminate.find_contamination(docs, items.limit(0))).collect()
    assert len(none) == docs.count() and not any(r.contaminated for r in none)


@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_cut_leaves_clean_text_alone(spark, odd, block_bytes):
    docs, items = odd
    cut = decontaminate.find_contamination(docs, items, block_bytes=block_bytes, filler="\n")
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left[2] is None and left[3] == "" and left[1] == "\n" and left[6] == "\n ÉTÉ"
    assert left[4] == "x " * 30_000 + "\n" + " y" * 5


def test_stage_cuts_benchmark(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.cut_benchmark(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns and out.count() == docs.count()
