"""Tables whose columns are named as the operators name their own, and the pipeline as a whole."""

from __future__ import annotations

import pytest

import corpus_pipeline
from gridloom.llm import catalog, decontaminate, packing, pii, quality, repeats, sharding, simhash, toxicity
from gridloom.llm.common import table

SF = "/root/testdata/sf0.001"
#: Names that one operator or another uses for itself.
OWN = (
    "_key", "_root", "_fingerprint", "_text", "_id", "_kept", "_kept_key", "_copies", "_score", "_base", "_spans", "_evidence",
    "_n_words", "_n_hit", "_bytes", "_items", "_left", "_ranges", "_run_id", "_run_key", "_n_lines", "_n_removed",
    "column_0", "kind", "rows", "chunk", "component_id", "score", "lang", "source", "n_chars",
)


@pytest.fixture(scope="module")
def docs(spark):
    frame = table(spark, SF, "documents").select("doc_id", "text")
    return frame.selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in OWN))


@pytest.mark.parametrize("operator", [simhash.keep_one, repeats.drop_runs, lambda d: decontaminate.find_contamination(
    d, table(d.sparkSession, SF, "benchmark"), filler="\n")])
def test_columns_pass(docs, operator):
    docs = docs.drop("_n_lines", "_n_removed")  # drop_runs adds these
    out = operator(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    names = docs.columns[1:][1:]
    want = {r.doc_id: tuple(r[n] for n in names) for r in docs.collect()}
    assert all(want[r.doc_id] == tuple(r[n] for n in names) for r in out.collect())


def test_added_columns_replace(spark, docs):
    labels = table(spark, SF, "labels")
    for out, made in (
        (toxicity.with_score(docs, toxicity.learn(docs, labels)), ["_score"]),
        (pii.with_spans(docs, None), ["_base", "_spans"]),
        (quality.with_evidence(docs, quality.learn(docs, labels)), ["_evidence"]),
        (decontaminate.find_contamination(docs, table(spark, SF, "benchmark")), ["_n_words", "_n_hit", "_spans", "_bytes", "_items"]),
    ):
        assert out.columns[-len(made):] == made and len(set(out.columns)) == len(out.columns)
        assert out.count() == docs.count()


def test_queries_of_named_tables(spark, docs):
    labels = table(spark, SF, "labels")
    plain = docs.select("doc_id", "text")
    for run in (
        simhash.near_duplicates, sharding.shard_digest, lambda d: toxicity.toxicity(d, labels),
        lambda d: packing.pack(d, catalog.public_tokenizers.path("byte_bpe_50k.json")).drop("sequence_id", "offset"),
    ):
        assert sorted(map(tuple, run(docs).collect())) == sorted(map(tuple, run(plain).collect()))


def test_stages_pass_all_columns(spark, docs, monkeypatch):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.schema == docs.schema or out.dtypes == docs.dtypes, name


def test_pipeline_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        frame = table(spark, SF, name)
        (frame.limit(0) if name == "documents" else frame).write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and "sequence_id" in out.columns


def test_pipeline_on_null_texts_and_ids(spark, tmp_path):
    for name in ("labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = [(1, None), (2, None), (None, "a b c"), (None, None), (3, ""), (4, "a b c d")]
    frame = spark.createDataFrame([(*r, "en", "web", 3) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    # Texts without words are copies of each other, and so are none of the rest.
    got = [(r.doc_id, r.length) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(k for k, _ in got if k is not None) == [1, 4] and len(got) == 3
