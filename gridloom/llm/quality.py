"""Document quality by hierarchical empirical Bayes.

A text classifier gives each document the probability of good quality. Sites form a
hierarchy: all documents, hosts, paths of a host. Each level's share of good documents is
shrunk toward the level above by a strength that is itself estimated from the spread between
the level's groups, so a sparse site stands near its parent and a large one near its own
share. A document's verdict joins its own evidence with its path's share, from which it is
left out itself.

Groups are only ever summed. A host that holds a third of all rows is one partially
aggregated row and the short side of a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices, staged, text_buffers
from gridloom.llm.fitting import logistic
from gridloom.llm.toxicity import held_out

#: Hashed byte trigrams.
BUCKETS = 1 << 16
#: Bounds of the estimated strengths and of shares.
STRENGTHS, SHARES = (1.0, 1e6), (1e-4, 1 - 1e-4)


def _trigrams(raw: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.uint32)
    mixed = (wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA6B)) ^ (wide[2:] * np.uint32(0xC2B2AE35))
    return mixed >> np.uint32(16)


@dataclass
class QualityModel:
    table: np.ndarray  # log likelihood ratio of each trigram bucket
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def features(self, texts: pa.Array) -> np.ndarray:
        """Mean trigram evidence, length and how far the text compresses, by rows."""
        raw, bounds = text_buffers(texts)
        size = np.diff(bounds)
        ratio = np.array([
            len(zlib.compress(raw[a:b].tobytes(), 1)) / (b - a + 16) for a, b in zip(bounds[:-1], bounds[1:])
        ]).reshape(-1)
        total = np.zeros(len(raw) + 1)
        if len(raw) > 2:
            total[1:-2] = np.cumsum(self.table[_trigrams(raw)])
            total[-2:] = total[-3]
        inside = np.maximum(size - 2, 0)
        evidence = (total[bounds[:-1] + inside] - total[bounds[:-1]]) / np.maximum(inside, 1)
        return np.stack([evidence, np.log1p(size), ratio, np.log1p(size) * ratio], 1)

    def evidence(self, features: np.ndarray) -> np.ndarray:
        """Log odds of good quality by the text alone."""
        x = np.c_[(features - self.mean) / self.scale, np.ones(len(features))]
        return np.clip(x @ self.weights, -12, 12)


def fit(good: Sequence[str], bad: Sequence[str]) -> QualityModel | None:
    if not good or not bad:
        return None
    counts = []
    for texts in (good, bad):
        found = np.zeros(BUCKETS)
        for text in texts:
            raw = np.frombuffer(text.encode(), np.uint8)
            if len(raw) > 2:
                found += np.bincount(_trigrams(raw), minlength=BUCKETS) / (len(raw) - 2)
        counts.append((found + 1e-4) / (found.sum() + 1e-4 * BUCKETS))
    table = np.log(counts[0]) - np.log(counts[1])
    model = QualityModel(table, np.zeros(4), np.ones(4), np.zeros(5), len(good) / (len(good) + len(bad)))
    x = model.features(pa.array([*good, *bad], pa.large_string()))
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    y = np.r_[np.ones(len(good)), np.zeros(len(bad))]
    model.weights = logistic(np.c_[(x - model.mean) / model.scale, np.ones(len(x))], y)
    return model


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = 3000, sample_bytes: int = 200_000,
) -> QualityModel | None:
    """Fits on at most ``sample_rows`` texts of each class outside the held-out fifth, the first
    in the order of the id's hash, none longer than ``sample_bytes``; these bound what the
    driver gets. Null labels and ids are passed over; of repeated ids the worst label counts."""
    known = (
        labels.filter(~held_out(id_col) & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_label"))
    )
    picked = [known.filter(F.col("_label") == v).orderBy(F.xxhash64("_id")).limit(sample_rows) for v in (1, 0)]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(
        F.col("_text").isNotNull() & (F.octet_length("_text") <= sample_bytes)
    )
    rows = (
        texts.join(F.broadcast(picked[0].unionByName(picked[1])), "_id")  # 2 * sample_rows ids at most
        .groupBy("_text").agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("_text")).limit(2 * sample_rows).collect()
    )
    return fit([r["_text"] for r in rows if r["_label"] == 1], [r["_text"] for r in rows if r["_label"] == 0])


def with_evidence(docs: DataFrame, model: QualityModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_evidence``, the text's log odds of good quality; 0 without a model. A column of
    that name is replaced."""
    if model is None:
        return docs.withColumn("_evidence", F.lit(0.0))
    docs = docs.drop("_evidence")
    names = docs.columns
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 1 << 20):
            found = model.evidence(model.features(batch.column(text_col)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*names, "_evidence"])

    return docs.mapInArrow(run, f"{kept}, _evidence double")


def strength(groups: DataFrame, n: str, good: str) -> float:
    """Pseudo-count of the parent's share, by moments over the groups' ``n`` rows and ``good`` sums.

    With no spread beyond chance between groups it is large, and each group takes its parent's
    share.
    """
    row = groups.filter(F.col(n) > 0).agg(
        F.sum(n).alias("n"), F.sum(good).alias("s"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col(n) * F.col(n)).alias("nn"), F.sum(F.col(good) * F.col(good) / F.col(n)).alias("between"),
    ).first()
    total, k = float(row["n"] or 0), int(row["k"] or 0)
    if k < 2 or total <= k:
        return STRENGTHS[1]
    share = row["s"] / total
    inside = share * (1 - share)
    # Sum of squares between groups = (k - 1) * inside + spread * (total - nn / total).
    spread = (row["between"] - total * share * share - (k - 1) * inside) / max(total - row["nn"] / total, 1e-9)
    return float(np.clip(inside / max(spread, 1e-12) - 1, *STRENGTHS))


def _log_odds(share: Column) -> Column:
    inside = F.least(F.greatest(share, F.lit(SHARES[0])), F.lit(SHARES[1]))
    return F.ln(inside / (1 - inside))


def join_sites(evidence: DataFrame, prior: float) -> DataFrame:
    """``doc_id``, ``_host``, ``_path`` and ``_evidence`` with ``doc_score``, ``host_share``,
    ``path_share`` and ``score``."""
    p = 1 / (1 + F.exp(-F.col("_evidence")))
    rows = evidence.withColumn("doc_score", p)
    paths = staged(
        rows.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("_n"), F.sum("doc_score").alias("_good")), "paths"
    )
    hosts = paths.groupBy("_host").agg(F.sum("_n").alias("_host_n"), F.sum("_good").alias("_host_good"))
    whole = paths.agg(F.sum("_n").alias("n"), F.sum("_good").alias("good")).first()
    share = (whole["good"] or 0.0) / (whole["n"] or 1)
    of_host, of_path = strength(hosts, "_host_n", "_host_good"), strength(paths, "_n", "_good")
    sites = paths.join(hosts, "_host")
    # Each document is left out of the sums of its own sites.
    host_share = (F.col("_host_good") - F.col("doc_score") + of_host * share) / (F.col("_host_n") - 1 + of_host)
    path_share = (F.col("_good") - F.col("doc_score") + of_path * F.col("host_share")) / (F.col("_n") - 1 + of_path)
    prior = min(max(prior, SHARES[0]), SHARES[1])
    ratio = F.col("_evidence") - float(np.log(prior / (1 - prior)))
    return (
        rows.join(sites, ["_host", "_path"])
        .withColumn("host_share", host_share)
        .withColumn("path_share", path_share)
        .withColumn("score", 1 / (1 + F.exp(-(ratio + _log_odds(F.col("path_share"))))))
        .drop("_n", "_good", "_host_n", "_host_good")
    )


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    host: str | Column = "source", path: str | Column = "lang", **options,
) -> DataFrame:
    """``doc_id``, ``host``, ``path``, ``held_out``, ``doc_score`` (text alone), ``host_share``,
    ``path_share``, ``score`` and ``keep`` (1 from 0.5 on) for each row.

    Null hosts form one host, null paths one path of their host; a null text is an empty one.
    A host with one document has its parent's share. Repeated rows count as often as they
    stand. Without labels of both classes the text says nothing and every share is one half.
    An empty table gives no rows.
    """
    model = learn(docs, labels, id_col, text_col, **options)
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(as_column(host).cast("string"), F.lit("")).alias("_host"),
        F.coalesce(as_column(path).cast("string"), F.lit("")).alias("_path"), F.col(text_col).alias("_text"),
    )
    evidence = staged(with_evidence(rows, model, "_text").drop("_text"), "evidence")
    scored = join_sites(evidence, model.prior if model else 0.5)
    return scored.select(
        "doc_id", F.col("_host").alias("host"), F.col("_path").alias("path"), held_out().alias("held_out"),
        "doc_score", "host_share", "path_share", "score", (F.col("score") >= 0.5).cast("int").alias("keep"),
    )
