"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridloom.session import release, staged, unstage

__all__ = ["apart", "release", "slices", "staged", "table", "text_buffers", "unstage"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apart(docs: DataFrame, **own: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with the columns ``own`` (new name: column) renamed and all others numbered, so that no
    name can clash; and the way back to the columns as they were."""
    given = {column: name for name, column in own.items()}
    names = [given.get(c, f"column_{k}") for k, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda frame: frame.select(*names).toDF(*docs.columns)


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column``'s text is at most ``max_bytes`` in each.

    A single longer text makes a batch of its own.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, bounds = text_buffers(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, n + 1 bounds); a null text is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]
