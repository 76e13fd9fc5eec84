from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import catalog, repeats

SF = "/root/testdata/sf0.01"
N = 28
TOKEN = re.compile(f"[{repeats.UNSPACED}][ \n\t]?|[^ \n\t{repeats.UNSPACED}]+[ \n\t]?|[ \n\t]")


def hash_of(text):
    """A text's ``_key``: its signed hash."""
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).view(np.int64))


def sentence(seed, n=12):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 10**6, n)) + ". "


def brute(docs):
    """{(id, text): text left} by the first place of every run of 28 words, all places compared."""
    read, first = {}, {}
    rows = sorted({d for d in docs if None not in d}, key=lambda d: (d[0], hash_of(d[1])))
    for row in rows:
        tokens = TOKEN.findall(row[1])
        assert "".join(tokens) == row[1]
        places = [k for k, t in enumerate(tokens) if t.strip(" \n\t")]
        words, gone = [tokens[k].strip(" \n\t") for k in places], set()
        for q in range(len(words) - N + 1):
            other, f = first.setdefault(tuple(words[q : q + N]), (row, q))
            if (other, f) != (row, q):
                gone |= set(range(max(q, f + N) if other == row else q, q + N))
        ends = [*places[1:], len(tokens)]
        cut = {t for w in gone for t in range(places[w], ends[w])}
        read[row] = "".join(t for k, t in enumerate(tokens) if k not in cut)
    return read


def check(spark, docs, got=None):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = got or [(r.doc_id, r.text) for r in repeats.drop_runs(frame).collect()]
    want = brute(docs)
    assert sorted(got, key=str) == sorted(((d, want.get((d, t), t)) for d, t in docs), key=str)
    return {d: t for d, t in got}


def test_query_equals_all_places(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, docs, [(r.doc_id, r.text) for r in catalog.op9_line_dedup(spark, SF).collect()])


def test_runs_of_28_words_in_whole_lines(spark):
    docs = []
    for k in range(40):
        run = sentence(1000 + k, 14) + sentence(2000 + k, 14)
        docs += [(2 * k, sentence(3000 + k) + run + sentence(4000 + k)), (2 * k + 1, sentence(5000 + k) + run + sentence(6000 + k))]
    left = check(spark, docs)
    assert all(left[2 * k + 1] == sentence(5000 + k) + sentence(6000 + k) for k in range(40))


def test_passages_cut_inside_sentences(spark):
    docs = []
    for k in range(40):
        words = sentence(k, 60).split()  # one sentence, of which another one holds the middle
        docs += [(2 * k, sentence(100 + k, 60)[:-2] + " " + " ".join(words) + ". "),
                 (2 * k + 1, " ".join(["before", *words[3:57], "after"]) + ". ")]
    docs += [(100, "".join(chr(0x4E00 + x) for x in np.random.default_rng(1).integers(0, 9000, 80)))]
    docs += [(101, "前後" + docs[-1][1][5:75] + "後。")]
    left = check(spark, docs)
    assert all(left[2 * k + 1] == "before after. " for k in range(40)) and left[101] == "前後後。"


def test_longer_run_around_a_frequent_one(spark):
    quote, docs = sentence(7, 20), []
    docs.append((0, sentence(8, 40) + quote + sentence(9, 40)))  # the quote's first place
    for k in range(20):  # each pair shares a run of its own around the quote
        run = sentence(200 + k, 6) + quote + sentence(300 + k, 6)
        docs += [(2 * k + 1, sentence(400 + k) + run), (2 * k + 2, sentence(500 + k) + run)]
    left = check(spark, docs)
    assert all(left[2 * k + 1] == docs[2 * k + 1][1] and left[2 * k + 2] == sentence(500 + k) for k in range(20))


def test_random_words(spark):
    """Few words, so that runs repeat in all ways: within texts, across them, at their edges."""
    rng = np.random.default_rng(3)
    pool = ["a", "b", "c", "d e", "\n", "f. ", "  "]
    docs = []
    for _ in range(120):
        parts = [sentence(int(rng.integers(0, 12)), int(rng.integers(8, 40))) for _ in range(int(rng.integers(0, 6)))]
        parts += [" ".join(pool[k] for k in rng.integers(0, len(pool), int(rng.integers(0, 50)))) for _ in range(2)]
        parts += ["x y " * int(rng.integers(0, 40))]
        docs.append((int(rng.integers(0, 60)), " ".join(parts[k] for k in rng.permutation(len(parts)))))
    check(spark, docs + docs[:5])


def test_odd_rows(spark):
    passage = "".join(sentence(s) for s in range(5))  # 60 words
    docs = [
        (1, sentence(10) + passage + sentence(11)), (2, sentence(12) + passage + sentence(13)), (3, "x " * 200 + passage.strip()),
        (4, None), (5, ""), (None, passage), (6, " \n "), (8, passage), (8, passage), (8, passage + "more"), (9, sentence(15) + "\n" + sentence(15)),
        (10, (sentence(20) + "\n") * 2000), (11, "\x01a " + passage + "\x01b. c"), (12, "  " + passage.replace(" ", "  ")),
    ]
    frame = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id bigint, text string, gram int, _n_lines string")
    out = repeats.drop_runs(frame)
    assert out.columns == ["doc_id", "text", "gram", "_n_lines", "_n_removed"]
    got = out.collect()
    left = check(spark, docs, [(r.doc_id, r.text) for r in got])
    assert left[1] == docs[0][1] and left[2] == sentence(12) + sentence(13) and left[None] == passage
    assert len(left[10]) < len(docs[11][1]) / 2
    assert {r.doc_id: r._n_removed for r in got}[2] == 5
    assert repeats.drop_runs(frame.limit(0)).count() == 0


def test_stage(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.drop_repeated_lines(spark, docs, sf)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_no_python_in_the_plan(spark):
    plan = catalog.op9_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_no_text_is_staged_and_windows_are_compiled(spark, monkeypatch):
    seen, real = {}, repeats.staged

    def staged(df, purpose):
        seen[purpose] = df.columns, df._jdf.queryExecution().executedPlan().toString()
        return real(df, purpose)

    monkeypatch.setattr(repeats, "staged", staged)
    check(spark, [(1, sentence(1, 40) + sentence(2, 40)), (2, sentence(1, 40) + sentence(3, 40))])
    assert not any("_text" in columns for columns, _ in seen.values())
    assert re.search(r"\*\(\d+\) Generate explode\(sequence", seen["grams"][1])


def test_selected_places_are_the_first_least_of_all_windows(spark):
    rng = np.random.default_rng(5)
    # Few different hashes, so that the least one stands in a window more than once.
    rows = [(k, k, [int(x) for x in rng.integers(0, 6 if k % 2 else 10**9, int(rng.integers(20, 90)))]) for k in range(60)]
    got = repeats._selected(spark.createDataFrame(rows, "_id bigint, _key bigint, _h array<bigint>")).collect()
    want = []
    for k, _, h in rows:
        windows = range(len(h) - N + 1)
        want += [(k, at) for at in {min(range(i, i + repeats.WINDOW), key=lambda x: (h[x], x)) for i in windows}]
    assert sorted((r._id, r.at) for r in got) == sorted(want)
    assert all(r.b == min(r.at + N, len(rows[r._id][2])) for r in got)


def test_lines_are_counted_as_they_split(spark):
    rng = np.random.default_rng(6)
    pool = ["a", " ", ".", "!", "? ", "\n", "…", "… ", "。", "！", "？", "\x01", "é"]
    texts = [None, "", *("".join(pool[k] for k in rng.integers(0, len(pool), int(rng.integers(0, 30)))) for _ in range(400))]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    pattern = "|".join(f"(?<={re.escape(end)})" for end in repeats.LINE_ENDS)
    for row in frame.select("text", repeats._n_lines(F.col("text")).alias("n")).collect():
        assert row.n == len([x for x in re.split(pattern, row.text or "") if x])
