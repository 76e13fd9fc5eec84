"""Toxicity by compression distance.

zstandard trains one dictionary on windows of ordinary texts and one on windows of toxic texts, both
from a bounded sample of labelled texts. What the toxic dictionary holds of ordinary language would
blur the comparison, so of its words only those stay that are significantly and mostly in
toxic texts, and they are put behind the ordinary dictionary's content. Each window of a text is then
compressed with either; what the toxic one saves is its gain. How far and how often windows
gain is calibrated to a probability by a logistic fit on gains that are measured out of
fold: each third of the sample by dictionaries trained on the other two.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices
from gridloom.llm.fitting import logistic, sigmoid

WINDOW_BYTES = 90
LEVEL = 3
#: Sizes of the trained dictionaries, and zstandard's lengths of segments and of the parts it counts.
ORDINARY_BYTES, TOXIC_BYTES = 16 << 10, 32 << 10
SEGMENT, PART = 32, 6
#: Text of a class that the dictionaries are trained on.
TRAIN_BYTES, TRAIN_WINDOW = 8 << 20, 60
#: A word stays in the toxic dictionary if at least so many toxic texts hold it, if it is so many
#: standard errors more frequent in toxic texts, and if so much of its rate is theirs.
LEAST_TEXTS, LEAST_Z, LEAST_PURITY = 4, 4.0, 0.9
PARTS = 3
FOLDS = 5

_KEPT = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words; punctuation separates them."""
    return (text or "").encode().translate(_KEPT).split()


def windows(text: str | None, size: int = WINDOW_BYTES) -> list[bytes]:
    """Words in stretches of ``size`` bytes or a little more, with a blank at either end."""
    joined, out, at = b" ".join(words(text)), [], 0
    while at < len(joined):
        end = joined.find(b" ", at + size)
        end = len(joined) if end < 0 else end
        out.append(b" " + joined[at:end] + b" ")
        at = end + 1
    return out


@dataclass
class ToxicityModel:
    ordinary: bytes  # dictionary contents
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    @cached_property
    def compressors(self) -> list[zstd.ZstdCompressor]:
        found = []
        for content in (self.ordinary, self.toxic):
            # As raw content, so that both code what they do not hold alike.
            raw = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            found.append(zstd.ZstdCompressor(
                level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False
            ))
        return found

    def features(self, text: str | None) -> list[float]:
        ordinary, toxic = (c.compress for c in self.compressors)
        gain = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)] or [0])
        return [
            gain.max(), np.sort(gain)[-3:].mean(), (gain >= 1).mean(), np.log1p((gain >= 1).sum()),
            np.log1p((gain >= 2).sum()), np.log1p((gain >= 4).sum()), np.log1p(len(gain)),
        ]

    def score(self, features: np.ndarray) -> np.ndarray:
        x = np.c_[(features - self.mean) / self.scale, np.ones(len(features))]
        return sigmoid(x @ self.weights)


def trained(texts: Sequence[str], size: int) -> bytes:
    """The content of a dictionary that zstandard trains on the texts' windows. Too little text to
    train on is its own dictionary."""
    found, total = [], 0
    for text in texts:
        for window in windows(text, TRAIN_WINDOW):
            found.append(window)
            total += len(window)
        if total > TRAIN_BYTES:
            break
    try:
        return bytes(zstd.train_dictionary(size, found, k=SEGMENT, d=PART).as_bytes())
    except zstd.ZstdError:
        return b"".join(found)[-size:]


def train_dictionaries(toxic: Sequence[str], ordinary: Sequence[str]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents; the surest words stand last, where they are cheapest."""
    n1, n0 = len(toxic), len(ordinary)
    in_toxic, in_ordinary = (Counter(w for text in texts for w in set(words(text))) for texts in (toxic, ordinary))

    def z(word: bytes) -> float:
        share = (in_toxic[word] + in_ordinary[word] + 1) / (n1 + n0 + 1)
        error = (share * (1 - share) * (1 / n1 + 1 / n0)) ** 0.5
        return (in_toxic[word] / n1 - in_ordinary[word] / n0) / max(error, 1e-9)

    def stays(word: bytes) -> bool:
        rate = in_toxic[word] / n1
        pure = rate >= LEAST_PURITY * (rate + (in_ordinary[word] + 0.5) / n0)
        return in_toxic[word] >= LEAST_TEXTS and pure and z(word) >= LEAST_Z

    base = trained(ordinary, ORDINARY_BYTES)
    marks = sorted((w for w in set(trained(toxic, TOXIC_BYTES).split(b" ")) if stays(w)), key=lambda w: (z(w), w))
    return base, base + b"".join(b" " + w + b" " for w in marks)


def fit(toxic: Sequence[str], ordinary: Sequence[str]) -> ToxicityModel | None:
    """A model of labelled texts, or None where a class has none."""
    if not toxic or not ordinary:
        return None

    def model(a: Sequence[str], b: Sequence[str]) -> ToxicityModel:
        return ToxicityModel(*train_dictionaries(a, b), np.zeros(7), np.ones(7), np.zeros(8))

    x, y = [], []
    for part in range(PARTS):
        mine, others = ([[t for i, t in enumerate(texts) if (i % PARTS == part) == own] for texts in (toxic, ordinary)] for own in (True, False))
        if not all(others):  # too few texts to hold any out
            others = [toxic, ordinary]
        apart = model(*others)
        for label, texts in zip((1, 0), mine):
            x += [apart.features(t) for t in texts]
            y += [label] * len(texts)
    x, y = np.array(x, float), np.array(y, float)
    whole = model(toxic, ordinary)
    whole.mean, whole.scale = x.mean(0), x.std(0) + 1e-9
    whole.weights = logistic(np.c_[(x - whole.mean) / whole.scale, np.ones(len(x))], y)
    return whole


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned; those without an id are among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = 3000,
    sample_bytes: int = 200_000,
) -> ToxicityModel | None:
    """Fits on at most ``sample_rows`` texts of each class, the first in the order of the id's
    hash, none longer than ``sample_bytes``; these two bound what the driver gets.

    Null labels and ids are passed over, a repeated id is toxic if any of its labels says so,
    and equal texts count once.
    """
    known = (
        labels.filter(~held_out(id_col) & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    )
    picked = [known.filter(F.col("_label") == v).orderBy(F.xxhash64("_id")).limit(sample_rows) for v in (1, 0)]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(
        F.col("_text").isNotNull() & (F.octet_length("_text") <= sample_bytes)
    )
    rows = (
        texts.join(F.broadcast(picked[0].unionByName(picked[1])), "_id")  # 2 * sample_rows ids at most
        .groupBy("_text").agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_text")).limit(2 * sample_rows).collect()
    )
    return fit([r["_text"] for r in rows if r["_label"] == 1], [r["_text"] for r in rows if r["_label"] == 0])


def with_score(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_score``, from the text alone.

    A null text is scored as an empty one, which has one window without gain. Without a model
    every score is 0. Repeated rows score alike; an empty table gives no rows. A column of
    that name is replaced.
    """
    if model is None:
        return docs.withColumn("_score", F.lit(0.0))
    docs = docs.drop("_score")
    names = docs.columns
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 1 << 20):
            x = np.array([model.features(t.as_py()) for t in batch.column(text_col)], float).reshape(-1, 7)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], [*names, "_score"])

    return docs.mapInArrow(run, f"{kept}, _score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from 0.5 on) for each row."""
    model = learn(docs, labels, id_col, text_col, **options)
    scored = with_score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), model, "_text")
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )
