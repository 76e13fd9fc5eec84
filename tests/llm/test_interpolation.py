from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import catalog, interpolation

SF = "/root/testdata/sf0.01"
UPPER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), None]


def checksum(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode())


def bucket(n):
    return int(n).bit_length()


def brute(docs):
    """Rows by dictionaries, with weights learned from single events instead of cells."""
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    train = []
    for doc, text in docs:
        if checksum(doc) % 5 != 1:
            half, found = checksum(doc) // 5 % 2, tokens(text)
            train.append((half, found))
            words[half].update(found)
            pairs[half].update(zip([None, *found], found))
    total = [sum(w.values()) for w in words]
    v = len(words[0] | words[1])
    events = {}
    for half, found in train:
        o = 1 - half
        for h, w in zip([None, *found], found):
            c = words[o][h]
            event = (pairs[o][h, w] / max(c, 1), words[o][w] / max(total[o], 1), 1 / (v + 1))
            events.setdefault(bucket(c), []).append(event)
    weights = {}
    for b, found in events.items():
        x, w = np.array(found), np.full(3, 1 / 3)
        for _ in range(200):
            share = w * x
            w = ((share / share.sum(1, keepdims=True)).sum(0) + 1) / (len(x) + 3)
        weights[b] = w
    if 0 in weights:
        weights[0] = np.r_[0, weights[0][1:] / weights[0][1:].sum()]
    c1, c2, n = words[0] + words[1], pairs[0] + pairs[1], sum(total)
    out = []
    for doc, text in docs:
        found = tokens(text)
        base = sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v + 1))) for w in found)
        score = 0.0
        for h, w in zip([None, *found], found):
            b = min(bucket(c1[h]), max(weights))
            while b not in weights and b:
                b -= 1
            score += math.log10(weights[b] @ [c2[h, w] / max(c1[h], 1), c1[w] / n, 1 / (v + 1)])
        out.append((doc, checksum(doc) % 5 == 1, len(found), sum(c1[w] > 0 for w in found), n, base, score))
    return out


def order(row):
    return (row[0] is not None, row[0] or 0, round(row[5], 6))


def check(got, docs):
    want = sorted(brute(docs), key=order)
    got = sorted((tuple(r) for r in got), key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-9)
    # The cells hold mean estimates, so the weights may differ a little.
    assert np.allclose([r[6] for r in got], [r[6] for r in want], rtol=2e-3, atol=0.01)
    return got


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = check(catalog.op11_lm_score(spark, SF).collect(), docs)
    held = [r for r in got if r[1]]
    assert len(held) > 150
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than the unigrams on unseen texts


@pytest.fixture
def odd():
    rng = np.random.default_rng(2)
    vocab = [f"W{x}" for x in range(50)] + ["É", "é", "漢 字", "a b", "\x0bz\t"]
    pick = lambda n: " ".join(vocab[int(x)] for x in np.minimum(rng.zipf(1.4, n), len(vocab)) - 1)
    docs = [(int(k), pick(int(rng.integers(0, 40)))) for k in rng.integers(0, 100, 200)]
    docs += [(200 + k, "copy of one text") for k in range(80)]
    return docs + [(None, "no id"), (None, None), (300, None), (301, ""), (302, " \n "), (303, "long " * 3000), (304, "x" * 9000), (1, pick(5)), (1, "a b")]


def test_odd_rows_in_small_chunks(spark, odd, monkeypatch):
    monkeypatch.setattr(interpolation, "CHUNK_BYTES", 700)  # texts are cut to many pieces
    monkeypatch.setattr(interpolation, "GROUP_ENTRIES", 64)
    frame = spark.createDataFrame([(d, t, 3, "x") for d, t in odd], "doc_id bigint, text string, chunk int, kind string").repartition(3)
    check(interpolation.score_documents(frame).collect(), odd)


def test_pieces_of_a_text(monkeypatch):
    monkeypatch.setattr(interpolation, "CHUNK_BYTES", 40)
    made = interpolation._Chunks(1)
    text = b" " * 90 + b" ".join(b"w%d" % k for k in range(60)) + b" " * 50
    rows = [*made.add(7, 0, text)]
    rows += [made.close()] if made.pieces else []
    pairs = []
    for row in rows:
        stream = interpolation.Stream(interpolation.zstd.ZstdDecompressor().decompress(row[7]), *row[3:7])
        names = list(stream.words)
        pairs += [(names[a], names[b]) for a, b in zip(stream.found[stream.at - 1], stream.found[stream.at])]
    words = [b" ", *text.split(), b" "]
    assert pairs == list(zip(words, words[1:]))


def test_probabilities_sum_to_one(spark):
    weights = np.array([[0, 0.7, 0.3], [0.5, 0.3, 0.2]])
    counts = np.array([5, 3, 1, 1])
    mixture = interpolation.Mixture(int(counts.sum()), len(counts), weights)
    for pairs, context in ((np.array([0, 1, 0, 0]), 1), (np.zeros(4, int), 0)):
        p = mixture.probability(np.r_[pairs, 0], np.full(5, context), np.r_[counts, 0])
        assert p.sum() == pytest.approx(1)


def test_no_rows_and_no_training(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert interpolation.score_documents(none).count() == 0
    held = next(k for k in range(100) if checksum(k) % 5 == 1)
    row = interpolation.score_documents(spark.createDataFrame([(held, "a b")], "doc_id bigint, text string")).first()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_learned_weights():
    cells = np.array([[interpolation.WIDE**2 + 5, 900, 450.0, 9.0], [interpolation.WIDE**2 + 6, 100, 0.0, 1.0]])
    weights = interpolation.learn_weights(cells, 10**6)
    assert weights[1, 0] > 0.8 and weights[1, 1] > 0.05 and (weights > 0)[1].all()
    assert weights.sum(1) == pytest.approx(1)
