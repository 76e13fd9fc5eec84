from __future__ import annotations

import zlib

import numpy as np
import pytest

import corpus_pipeline
from gridloom.llm import catalog, toxicity

SF = "/root/testdata/sf0.1"


def test_windows_hold_every_word():
    text = "One, two; three! " * 50 + "É" * 300
    joined = b" ".join(w.strip() for w in toxicity.windows(text))
    assert joined == b" ".join(toxicity.words(text)) and toxicity.windows("") == toxicity.windows(None) == []
    assert all(w[:1] == w[-1:] == b" " for w in toxicity.windows(text))


def test_held_out_accuracy_on_the_query(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = catalog.op6_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got[:500]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(labels[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in labels]
    toxic = np.array([s for y, s in held if y])
    clean = np.array([s for y, s in held if not y])
    ranked = (toxic[:, None] > clean).mean() + (toxic[:, None] == clean).mean() / 2
    assert ranked > 0.9 and (clean >= 0.5).sum() <= 16 and (toxic >= 0.5).sum() > 60 and (len(toxic), len(clean)) == (97, 728)


def rows(spark, n=400):
    rng = np.random.default_rng(8)
    plain = [f"w{k}" for k in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = rng.choice(plain, 60).tolist()
        if i % 4 == 0:
            text.insert(20, "vilest")
            text.insert(40, "nastyword")
        docs.append((i, " ".join(text), i % 3))
        labels.append((i, int(i % 4 == 0)))
    return docs, labels


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs, labels = rows(spark)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, score int")
    scores = [
        sorted(map(tuple, toxicity.toxicity(frame, spark.createDataFrame(y, "doc_id bigint, toxic int")).collect()))
        for y in (labels, turned)
    ]
    assert scores[0] == scores[1]
    assert np.mean([p == int(d % 4 == 0) for d, _, _, p in scores[0]]) > 0.96


def test_odd_rows(spark):
    docs, labels = rows(spark)
    odd = [(None, "w1 vilest w2", 0), (900, None, 0), (901, "", 0), (902, "w5 " * 50_000 + "nastyword w3 vilest", 0),
           (0, docs[0][1], 0), (0, docs[0][1], 0)]
    marks = [*labels, *labels[:50], (None, 1), (901, None), (902, 0), (7777, 1)]
    frame = spark.createDataFrame(docs + odd, "doc_id bigint, text string, toxic int")
    got = toxicity.toxicity(frame, spark.createDataFrame(marks, "doc_id bigint, toxic int")).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(docs) + len(odd)
    assert by_id[None].held_out and by_id[900].score == by_id[901].score < 0.5
    assert all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.toxicity(frame, none).collect()} == {0.0}
    assert toxicity.toxicity(frame.limit(0), none).count() == 0


def test_stage(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.drop_toxic(spark, docs, sf)
    assert out.columns == docs.columns and 0.85 * docs.count() < out.count() < docs.count()
