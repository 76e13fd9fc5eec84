"""Bounded-space best-fit packing of tokenized documents into sequences.

Documents go, in the order in which a task reads them, into the open sequence with the
least free space that still holds them. A fixed number of sequences is open; they stand in
a bitset keyed by free space, so the best fit is the lowest set bit at or above the length.
If none fits and all places are taken, the fullest open sequence is closed.

What stands in sequences that are still open when a task ends is packed again by the same rule,
the longest pieces first, in tasks of up to ``AGAIN`` pieces. So the number of sequences hardly
depends on how the documents were dealt to tasks. Only those narrow rows are shuffled.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices, staged

SCHEMA = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
)
#: A sequence id holds the task's number above this many bits, and the second pass' mark.
SEQUENCE_BITS, SECOND = 36, 1 << 62
#: Pieces that a task of the second pass packs.
AGAIN = 200_000


# Fixed value: how byte-level tokenizers cut text into words before the merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable Latin-1 letters
    stand for themselves, the other bytes take the letters from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted({*range(256)} - {*own})
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _as_ranks(parts: dict) -> dict[bytes, int] | None:
    """The vocabulary as merge ranks, if merging by rank gives the tokenizer's own ids."""
    cut, model = parts["pre_tokenizer"] or {}, parts["model"]
    plain = (
        parts["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        and not cut["add_prefix_space"] and model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                           "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return None
    letters, vocab = _byte_letters(), model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merged = [vocab["".join(pair)] for pair in pairs]
    if merged != sorted(set(merged)) or len(vocab) != len(merged) + 256:
        return None
    return {bytes(letters[c] for c in token): rank for token, rank in vocab.items()}


class TokenIds:
    """Text -> its token ids.

    A byte-level vocabulary is merged by tiktoken, four times as fast as the tokenizer's own
    library with the same ids; texts under any other tokenizer go to that library.
    """

    def __init__(self, tokenizer_path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        parts = json.loads(self.tokenizer.to_str())
        special = {token["content"]: token["id"] for token in parts["added_tokens"]}
        ranks, self.merge = _as_ranks(parts), None
        if ranks:
            import tiktoken

            merge = tiktoken.Encoding(tokenizer_path, pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
            self.merge = merge.encode_to_numpy

    def __call__(self, text: str) -> np.ndarray:
        if self.merge:
            return self.merge(text, allowed_special="all").astype("<u4", copy=False)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


class OpenBins:
    """Open sequences by free space."""

    def __init__(self, capacity: int, open_bins: int) -> None:
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.count, self.opened = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def open(self) -> set[int]:
        return {sequence for stack in self.by_free for sequence in stack}

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        sequence = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.count -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of ``length`` tokens."""
        fitting = self.bits >> length << length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.opened
            self.opened += 1
        left = free - length
        if left:
            if self.count >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # closes the fullest
            self.by_free[left].append(sequence)
            self.bits |= 1 << left
            self.count += 1
        return sequence, self.capacity - free


_TOKENS: dict[str, TokenIds] = {}  # one for each worker process


NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5]


def _rows(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _first_pass(texts: DataFrame, tokenizer_path: str, capacity: int, end_id: int, open_bins: int) -> DataFrame:
    """Pieces with their places, and ``open``: whether the task left the sequence open.

    A sequence's rows wait until it is full or closed, so a task holds the rows of ``open_bins``
    sequences at most.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _TOKENS.get(tokenizer_path) or _TOKENS.setdefault(tokenizer_path, TokenIds(tokenizer_path))
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        waiting: dict[int, list[tuple]] = {}
        for batch in slices(batches, "text", 1 << 20):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = tokens(text.as_py() or "").tobytes() + end
                total, start, piece = len(ids) // 4, 0, 0
                while start < total:
                    length = (total - start) % capacity or capacity
                    sequence, offset = bins.place(length)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    row = (doc, piece, start, length, crc, base + sequence, offset, False)
                    waiting.setdefault(sequence, []).append(row)
                    start, piece = start + length, piece + 1
            still = bins.open()
            done = [row for sequence in [s for s in waiting if s not in still] for row in waiting.pop(sequence)]
            yield _rows(done, [*NAMES, "open"], [*TYPES, pa.bool_()])
        left = [(*row[:-1], True) for rows in waiting.values() for row in rows]
        yield _rows(left, [*NAMES, "open"], [*TYPES, pa.bool_()])

    return texts.mapInArrow(run, f"{SCHEMA}, open boolean")


def _second_pass(pieces: DataFrame, count: int, capacity: int) -> DataFrame:
    """``pieces`` in new sequences, longest first. No task has more of them than it may keep open."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, 2 * AGAIN)
        base = SECOND + (TaskContext.get().partitionId() << SEQUENCE_BITS)
        for batch in batches:
            places = [bins.place(n) for n in batch.column("length").to_pylist()]
            moved = [pa.array([x + base for x, _ in places], pa.int64()), pa.array([x for _, x in places], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in NAMES[:5]), *moved], NAMES)

    dealt = pieces.repartition(-(-count // AGAIN), F.xxhash64("doc_id", "piece", "ids_crc32", "sequence_id"))
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("sequence_id"), F.col("offset")]
    return dealt.select(*NAMES).sortWithinPartitions(*order).mapInArrow(run, SCHEMA)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    end_id: int = 2,
    open_bins: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each piece of each document: where it stands and a checksum of its ids.

    ``tokenizer_path`` must be readable on every executor. A null text is empty, and an
    empty text is the end id alone. Only a document of more than ``capacity`` tokens is cut,
    its first piece taking the remainder. A null id stays null, repeated ids are documents of
    their own, an empty table gives no rows; other columns are not read.
    """
    if capacity < 1 or open_bins < 1:
        raise ValueError("capacity and open_bins must be positive")
    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    placed = staged(_first_pass(picked, tokenizer_path, capacity, end_id, open_bins), "packed")
    closed, left = placed.filter("NOT open").drop("open"), placed.filter("open").drop("open")
    count = left.count()
    if not count:
        return closed
    return closed.unionByName(_second_pass(left, count, capacity))
