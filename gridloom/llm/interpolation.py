"""Language-model scores by deleted interpolation.

The probability of a token after another mixes three estimates: the maximum-likelihood bigram,
the maximum-likelihood unigram, and one over the vocabulary and one unknown token. The mixture
weights depend on how often the context was seen, in buckets of powers of two, and are learned
by expectation-maximisation on held-out counts: the training documents are dealt to two
halves, and the tokens of either are predicted from the counts of the other. All tokens count;
the events are tallied in narrow cells of (bucket, bigram estimate, unigram estimate), whose
number has a bound, and the cells' mean estimates go to the driver.

Texts are held as chunks of some megabytes. A chunk lists its distinct words and bigrams, by
64-bit keys, with their counts in either half; the lists are dealt by key, added up, and the
totals go back to the chunks that asked, in the order of the keys, so they need none. A word that a
third of all tokens are is one entry of each chunk, and no task holds more than its share of
the keys. Chunk and totals are then joined once; what the join leaves are the tallied events of
each chunk and the counts along its tokens, from which the scores follow without the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import release, slices, staged, text_buffers, unstage

CHUNK_BYTES = 6 << 20
#: Entries of the lists that are added up in one task.
GROUP_ENTRIES = 1 << 20
#: One in this many documents is held out from training, by the checksum of its id.
FOLDS, HELD_OUT = 5, 1
#: The token after a text, and before its first word; no word holds a blank.
END = b" "
WORD, PAIR = 1, 2
#: Cells to an octave of an estimate, and so many at most.
FINE, WIDE = 4, 256
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)

CHUNK = (
    "chunk bigint, rows array<bigint>, ids array<bigint>, kinds array<int>, begins array<boolean>, "
    "ends array<boolean>, sizes array<bigint>, text binary"
)


def packed(values: np.ndarray) -> bytes:
    """An array by planes of bytes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstd.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str = "<u8") -> np.ndarray:
    planes = np.frombuffer(zstd.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


class _Chunks:
    """Collects texts to chunks. A text that does not fit is cut after a word, and the next
    piece starts with that word as its context."""

    def __init__(self, task: int) -> None:
        self.task, self.rows, self.made = task, 0, 0
        self._clear()

    def _clear(self) -> None:
        self.pieces: list[tuple] = []
        self.texts: list[bytes] = []
        self.size = 0

    def add(self, doc: int | None, kind: int, text: bytes) -> Iterator[tuple]:
        row, at, before = (self.task << 33) + self.rows, 0, None
        self.rows += 1
        while True:
            room = CHUNK_BYTES - self.size
            end = len(text)
            if end - at > room:
                found = _BLANK.search(text, at + room)
                end = found.start() if found else end
            part = text[at:end]
            last = part.rsplit(None, 1)[-1:] if end < len(text) else []
            if before is not None:
                part = before + b" " + part
            self.pieces.append((row, doc, kind, before is None, end == len(text), len(part)))
            self.texts.append(part)
            self.size += len(part)
            if self.size >= CHUNK_BYTES:
                yield self.close()
            if end == len(text):
                return
            at, before = end, last[0] if last else before

    def close(self) -> tuple:
        text = zstd.ZstdCompressor(level=3).compress(b"".join(self.texts))
        row = ((self.task << 33) + self.made, *(list(c) for c in zip(*self.pieces)), text)
        self.made += 1
        self._clear()
        return row


class _Numbers(dict):
    """Numbers words as they first come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class Stream:
    """The tokens of a chunk: ``word`` after ``before`` (places in ``keys``, sorted), in ``piece``."""

    def __init__(self, text: bytes, kinds, begins, ends, sizes) -> None:
        number = _Numbers({END: 0})
        found, context, piece, at = [], [], [], 0
        for begin, end, size in zip(begins, ends, sizes):
            start = len(found)
            if begin:
                found.append(0)
            found.extend(map(number.__getitem__, text[at : at + size].split()))
            if end:
                found.append(0)
            context.append(start)
            piece.append(len(found) - start)
            at += size
        self.found = np.array(found, np.int64)
        self.words = number
        held = np.array(piece, np.int64)
        token = np.ones(len(found), bool)
        token[[c for c, n in zip(context, piece) if n]] = False
        self.at = np.flatnonzero(token)
        self.lengths, self.starts = held, ~token
        self.piece = np.repeat(np.arange(len(held)), held)[self.at]
        self.kind_of = np.array(kinds, np.int64)[self.piece]

    def index(self) -> None:
        """Keys of the distinct words and bigrams, sorted, and the place of each token's."""
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)
        self.word_keys, place = np.unique(hashes, return_inverse=True)
        self.words_at = place[self.found]
        self.word, self.before = self.words_at[self.at], self.words_at[self.at - 1]
        first = hashes[self.found[self.at - 1]] * _MIX[0]
        pairs = ((first << np.uint64(31)) | (first >> np.uint64(33))) ^ hashes[self.found[self.at]]
        pairs = (pairs ^ (pairs >> np.uint64(30))) * _MIX[1]
        pairs = (pairs ^ (pairs >> np.uint64(27))) * _MIX[2]
        self.pair_keys, at, self.pair = np.unique(pairs ^ (pairs >> np.uint64(31)), return_index=True, return_inverse=True)
        #: The word and the context of each distinct bigram.
        self.pair_word, self.pair_before = self.word[at], self.before[at]

    def halves(self, place: np.ndarray, size: int) -> list[np.ndarray]:
        """How often each entry occurs in either half of the training documents."""
        return [np.bincount(place[self.kind_of == f], minlength=size).astype(np.uint64) for f in (0, 1)]


def chunks(docs: DataFrame) -> DataFrame:
    """Chunks of the texts of ``doc_id``, ``kind`` (the half, or 2 where held out), ``text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Chunks(TaskContext.get().partitionId())
        for batch in slices(batches, "text", 1 << 20):
            raw, bounds = text_buffers(batch.column("text"))
            raw = raw.tobytes().lower()
            for k, (doc, kind) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("kind").to_pylist())):
                for row in made.add(doc, kind, raw[bounds[k] : bounds[k + 1]]):
                    yield out(row)
        if made.pieces:
            yield out(made.close())

    many, flags = pa.list_(pa.int64()), pa.list_(pa.bool_())
    types = [pa.int64(), many, many, pa.list_(pa.int32()), flags, flags, many, pa.binary()]
    names = [f.split()[0] for f in CHUNK.split(", ")]

    def out(row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    return docs.mapInArrow(run, CHUNK)


def _streams(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, Stream]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            text = zstd.ZstdDecompressor().decompress(row.pop("text"))
            stream = Stream(text, row["kinds"], row["begins"], row["ends"], row["sizes"])
            stream.index()
            yield row, stream


def lists(chunked: DataFrame, bits: int) -> DataFrame:
    """The sorted keys of each chunk with their counts in either half, cut at the first ``bits`` bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, stream in _streams(batches):
            out: list[list] = [[] for _ in range(5)]
            for kind, keys, place in ((WORD, stream.word_keys, stream.word), (PAIR, stream.pair_keys, stream.pair)):
                counts = stream.halves(place, len(keys))
                top = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                bounds = np.searchsorted(top, np.arange((1 << bits) + 1))
                for bucket in np.flatnonzero(np.diff(bounds)).tolist():
                    part = slice(bounds[bucket], bounds[bucket + 1])
                    steps = np.diff(keys[part], prepend=np.uint64(0))
                    both = np.concatenate([c[part] for c in counts])
                    for column, value in zip(out, (kind, bucket, row["chunk"], packed(steps), packed(both))):
                        column.append(value)
            types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            names = ["kind", "bucket", "chunk", "keys", "counts"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return chunked.select("chunk", "kinds", "begins", "ends", "sizes", "text").mapInArrow(
        run, "kind int, bucket int, chunk bigint, keys binary, counts binary"
    )


def totals(listed: DataFrame) -> DataFrame:
    """What all chunks counted, for each chunk in the order of its keys; in one row of each group
    ``trained`` is how many of its keys occur in training, ``half_0`` and ``half_1`` how often."""

    def run(group: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in group.column("keys")]
        counts = [unpacked(x.as_py()).reshape(2, -1) for x in group.column("counts")]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        both = np.concatenate(counts, axis=1)
        added = np.zeros((2, place.max() + 1), np.uint64)
        for half in (0, 1):
            np.add.at(added[half], place, both[half])
        out, at = [], 0
        for own in keys:
            out.append(packed(np.ascontiguousarray(added[:, place[at : at + len(own)]]).reshape(-1)))
            at += len(own)
        rest = [0] * (len(keys) - 1)
        sums = [int(added.any(0).sum()), *(int(x) for x in added.sum(1))]
        return pa.table({
            "kind": group.column("kind"), "bucket": group.column("bucket"), "chunk": group.column("chunk"),
            "totals": pa.array(out, pa.binary()),
            **{name: pa.array([n, *rest], pa.int64()) for name, n in zip(("trained", "half_0", "half_1"), sums)},
        })

    return listed.groupBy("kind", "bucket").applyInArrow(
        run, "kind int, bucket int, chunk bigint, totals binary, trained bigint, half_0 bigint, half_1 bigint"
    )


def _counted(row: dict, kind: int) -> np.ndarray:
    """(2, n) totals of a chunk's words or bigrams."""
    parts = sorted((x["bucket"], x["totals"]) for x in row["found"] if x["kind"] == kind)
    return np.concatenate([unpacked(x).reshape(2, -1) for _, x in parts], axis=1).astype(np.int64)


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else one more than the logarithm of their count."""
    return np.frexp(context.astype(float))[1].astype(np.int64) * (context > 0)


def _ratio(part: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _fine(estimate: np.ndarray) -> np.ndarray:
    """Cell of an estimate; 0 where it is 0."""
    with np.errstate(divide="ignore"):
        place = 1 - np.round(FINE * np.log2(estimate))
    return np.where(estimate > 0, np.clip(place, 1, WIDE - 1), 0).astype(np.int64)


def _events(stream: Stream, words: np.ndarray, pairs: np.ndarray, tokens: tuple[int, int]) -> list[np.ndarray]:
    """Cells, events, and the sums of their bigram and unigram estimates, each half by the other's counts."""
    own, out = stream.halves(stream.pair, len(stream.pair_keys)), []
    for half in (0, 1):
        other, n = 1 - half, own[half].astype(np.int64)
        at = np.flatnonzero(n)
        context, times = words[other][stream.pair_before[at]], n[at]
        two = _ratio(pairs[other][at], context)
        one = _ratio(words[other][stream.pair_word[at]], tokens[other])
        cell = (_bucket(context) * WIDE + _fine(two)) * WIDE + _fine(one)
        cells, place = np.unique(cell, return_inverse=True)
        sums = [np.bincount(place, times * x, len(cells)) for x in (np.ones(len(at)), two, one)]
        out.append((cells, sums[0].astype(np.int64), *sums[1:]))
    return [np.concatenate(c) for c in zip(*out)]


COUNTED = (
    "rows array<bigint>, ids array<bigint>, kinds array<int>, lengths array<bigint>, starts binary, words binary, "
    "pairs binary, events array<struct<cell: bigint, n: bigint, two: double, one: double>>"
)


def counted(joined: DataFrame, tokens: tuple[int, int]) -> DataFrame:
    """Of each chunk: its events, and along its places what training counted of the word, and of the
    word after the one before. ``starts`` marks the places that are only context."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, stream in _streams(batches):
            words, pairs = _counted(row, WORD), _counted(row, PAIR)
            events = _events(stream, words, pairs, tokens)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            flat = pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(events, kinds)], ["cell", "n", "two", "one"]
            )
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["rows"]], many), pa.array([row["ids"]], many), pa.array([row["kinds"]], pa.list_(pa.int32())),
                    pa.array([stream.lengths.tolist()], many), pa.array([packed(stream.starts)]),
                    pa.array([packed(words.sum(0)[stream.words_at])]), pa.array([packed(pairs.sum(0)[stream.pair])]),
                    pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat),
                ],
                [f.split()[0] for f in COUNTED.split(", ")[:7]] + ["events"],
            )

    return joined.mapInArrow(run, COUNTED)


@dataclass
class Mixture:
    """Weights of the bigram, the unigram and the even estimate for each bucket of contexts."""

    tokens: int
    words: int
    weights: np.ndarray

    def probability(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """From the counts of a bigram, its context and its word."""
        w = self.weights[np.minimum(_bucket(context), len(self.weights) - 1)]
        even = 1 / (self.words + 1)
        return w[:, 0] * _ratio(pair, context) + w[:, 1] * _ratio(word, self.tokens) + w[:, 2] * even


def learn_weights(cells: np.ndarray, words: int, rounds: int = 200) -> np.ndarray:
    """Expectation-maximisation in each bucket over ``cells`` (cell, events, sums of both estimates).

    Each weight starts with one event of its own, so none becomes 0; a bucket without events
    takes the weights of the one below it.
    """
    if not len(cells):
        return np.array([[0.0, 0.0, 1.0]])
    bucket = cells[:, 0].astype(np.int64) // WIDE**2
    n = cells[:, 1]
    estimates = np.c_[cells[:, 2] / n, cells[:, 3] / n, np.full(len(n), 1 / (words + 1))]
    size = bucket.max() + 1
    events = np.bincount(bucket, n, size)
    weights = np.full((size, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[bucket] * estimates
        share *= (n / share.sum(1))[:, None]
        expected = np.stack([np.bincount(bucket, share[:, k], size) for k in range(3)], 1) + 1
        new = expected / (events + 3)[:, None]
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-9:
            break
    for b in range(1, size):
        if not events[b]:
            weights[b] = weights[b - 1]
    # A context never seen has no bigram estimate.
    weights[0] = [0, *(weights[0, 1:] / weights[0, 1:].sum())]
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` (both logarithms to base 10) for each row.

    Tokens are the blank-separated words of the whole text, A-Z lower-cased, and one end; a null
    text is empty. Training rows are those whose id, as text, has a checksum that leaves another
    rest by ``FOLDS`` than ``HELD_OUT``; a null id counts as empty text. Repeated rows are rows of
    their own, in training too. Without training rows all tokens are unknown. An empty table
    gives no rows; other columns are not read.
    """
    checksum = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    kind = F.when(checksum % FOLDS == HELD_OUT, 2).otherwise(F.floor(checksum / FOLDS) % 2).cast("int")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), kind.alias("kind"), F.col(text_col).alias("text"))
    chunked = staged(chunks(texts), "chunks")
    size = chunked.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0] or 0
    # Words of about six bytes, and for each an entry of its own and one of its pair.
    bits = min(30, max(0, (size // 3 // GROUP_ENTRIES).bit_length() - 1))
    added = staged(totals(lists(chunked, bits)), "totals")
    of_words = added.filter(F.col("kind") == WORD).agg(F.sum("trained"), F.sum("half_0"), F.sum("half_1")).first()
    words, *tokens = (n or 0 for n in of_words)
    release(added.sparkSession)  # the lists were larger than all that follows
    per_chunk = added.groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "totals")).alias("found"))
    joined = chunked.join(per_chunk, "chunk")  # both sides hold a row a chunk
    known = staged(counted(joined, tuple(tokens)), "counted")
    unstage(chunked, added)
    events = known.select(F.inline("events")).groupBy("cell").agg(F.sum("n"), F.sum("two"), F.sum("one"))
    cells = np.array([tuple(r) for r in events.collect()], float)  # bounded by the cells
    mixture = Mixture(sum(tokens), words, learn_weights(cells, words))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                at = np.flatnonzero(~unpacked(row["starts"], "?"))
                word, pair = (unpacked(row[name], "<i8") for name in ("words", "pairs"))
                context, word = word[at - 1], word[at]
                p = mixture.probability(pair, context, word)
                base = np.log10((word + 0.5) / (mixture.tokens + 0.5 * (mixture.words + 1)))
                of_piece, n = np.repeat(np.arange(len(row["rows"])), row["lengths"])[at], len(row["rows"])
                add = lambda x: pa.array(np.bincount(of_piece, x, n))  # noqa: E731, B023
                count = lambda x: pa.array(np.bincount(of_piece, x, n).astype(np.int64))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["rows"], pa.int64()), pa.array(row["ids"], pa.int64()), pa.array([x == 2 for x in row["kinds"]]),
                        count(np.ones(len(at))), count(word > 0), add(base), add(np.log10(p)),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    made = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    pieces = known.drop("events").mapInArrow(run, made)
    whole = pieces.groupBy("row").agg(
        F.min("doc_id").alias("doc_id"), F.min("held_out").alias("held_out"),
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")),
    )
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(mixture.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
