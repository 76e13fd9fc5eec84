"""The corpus pipeline: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontaminate, packing, repeats, simhash, toxicity
from gridloom.llm.common import apart, staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a text has changed."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    inner, back = apart(docs, doc_id="doc_id", text="text")
    return back(toxicity.with_score(inner, model).filter("_score < 0.5"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of words are cut out of the texts."""
    inner, back = apart(docs, doc_id="doc_id", text="text")
    return _counted(back(repeats.drop_runs(inner)))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, also by way of others, the one with the least id stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    return _counted(decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), filler="\n"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each),
    ("decontamination", cut_benchmark),
    ("packing", pack_sequences),
]
ORACLE_SQL = None  # the learned, hashed and tokenized stages have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
