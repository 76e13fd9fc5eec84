"""Benchmark decontamination with an FM-index for each training shard.

A shard is a stretch of documents within a task. Its words become numbers of the
benchmark's vocabulary; every stretch of words outside it, which no benchmark phrase can
hold, shrinks to one separator, and so does a stretch too short for the shortest phrase.
The phrases are searched backward through wavelet-tree ranks in all the shard at once,
occurrences are located from sampled suffix positions, compared with the words themselves,
and merged to spans. Documents are neither shuffled nor joined.

The benchmark reaches the tasks in blocks of at most ``block_bytes`` of text, one pass
over the documents for each, so its size is not bounded by a task's memory.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import apart, slices, text_buffers
from gridloom.llm.fm_index import FMIndex

#: Of the word keys; any large odd number will do.
BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Words are digits, letters and all that is not ASCII.
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("0") : ord("9") + 1] = IN_WORD[ord("a") : ord("z") + 1] = IN_WORD[128:] = True

STATE = "_n_words bigint, _n_hit bigint, _spans array<bigint>, _bytes array<bigint>, _items array<string>"


@dataclass
class Words:
    raw: np.ndarray  # lower-cased bytes of all texts
    begins: np.ndarray
    ends: np.ndarray
    keys: np.ndarray
    first: np.ndarray  # of each document, its first word; n + 1 values

    def text(self, word: int, count: int) -> bytes:
        """``count`` words from ``word`` on, space-joined."""
        return b" ".join(
            self.raw[a:b].tobytes()
            for a, b in zip(self.begins[word : word + count], self.ends[word : word + count])
        )


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64, kept for the next shard."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", inverse)):
            grown = np.full(n, base, np.uint64)
            grown[0] = 1
            _POWERS[name] = np.multiply.accumulate(grown)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def split_words(texts: pa.Array) -> Words:
    """All words of all texts with a 64-bit polynomial key each."""
    raw, bounds = text_buffers(texts)
    raw = LOWER[raw]
    inside = np.r_[False, IN_WORD[raw], False]
    starts, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]
    cut = edge[inside[edge + 1] & inside[edge]]  # a word may not run into the next text
    starts[cut], stops[cut - 1] = True, True
    begins, ends = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    if not len(begins):
        return Words(raw, begins, ends, np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64))
    up, down = _powers(len(raw))
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
    keys = (total[ends] - total[begins]) * down[begins]
    return Words(raw, begins, ends, keys, np.searchsorted(begins, bounds))


class Phrases:
    """One block of the benchmark: its vocabulary and its distinct windows."""

    def __init__(self, texts: list[str], item_ids: list[str], window: int) -> None:
        words = split_words(pa.array(texts, pa.large_string()))
        self.vocab, symbols = np.unique(words.keys, return_inverse=True)
        symbols = symbols.astype(np.int64) + 1
        rows: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.items: list[set[str]] = []
        windows: list[np.ndarray] = []
        for item, (a, b) in zip(item_ids, zip(words.first[:-1], words.first[1:])):
            size = min(window, b - a)
            for at in range(a, b - size + 1) if size else ():
                text = words.text(at, size)
                if text not in rows:
                    rows[text] = len(windows)
                    windows.append(symbols[at : at + size])
                    self.texts.append(text)
                    self.items.append(set())
                self.items[rows[text]].add(item)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        width = int(self.lengths.max(initial=0))
        self.patterns = np.zeros((len(windows), width), np.int64)
        for row, found in zip(self.patterns, windows):
            row[width - len(found) :] = found
        self.shortest = int(self.lengths.min(initial=window))
        self.seen = np.zeros(1 << 16, bool)  # quick test before the search in the vocabulary
        self.seen[self.vocab >> np.uint64(48)] = True

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        """Number in the vocabulary from 1, or 0."""
        out = np.zeros(len(keys), np.int64)
        maybe = np.flatnonzero(self.seen[keys >> np.uint64(48)])
        at = np.minimum(np.searchsorted(self.vocab, keys[maybe]), len(self.vocab) - 1)
        out[maybe] = np.where(self.vocab[at] == keys[maybe], at + 1, 0)
        return out

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of each occurrence in the shard."""
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.lengths) or not len(words.keys):
            return nothing
        symbols = self.symbols(words.keys)
        known = symbols > 0
        # Stretches of known words within a document.
        head = known.copy()
        head[1:] &= ~known[:-1]
        firsts = words.first[:-1][words.first[:-1] < len(known)]
        head[firsts] |= known[firsts]
        heads = np.flatnonzero(head)
        if not len(heads):
            return nothing
        at = np.flatnonzero(known)
        stretch = np.searchsorted(heads, at, side="right") - 1
        size = np.bincount(stretch, minlength=len(heads))
        at = at[size[stretch] >= self.shortest]
        if not len(at):
            return nothing
        # The kept words, with a separator before each stretch.
        new = np.r_[True, (np.diff(at) != 1) | head[at[1:]]]
        place = np.arange(len(at)) + np.cumsum(new)
        text, back = np.zeros(place[-1] + 1, np.int64), np.full(place[-1] + 1, -1, np.int64)
        text[place], back[place] = symbols[at], at
        index = FMIndex(text, len(self.vocab))
        low, high = index.search(self.patterns, self.lengths)
        which = np.repeat(np.arange(len(low)), high - low)
        rows = np.arange(len(which)) + np.repeat(low - np.r_[0, np.cumsum(high - low)[:-1]], high - low)
        start = back[index.locate(rows)]
        # Keys could collide; the words decide.
        true = np.fromiter(
            (words.text(s, n) == self.texts[w] for s, w, n in zip(start, which, self.lengths[which])),
            bool, len(which),
        )
        return start[true], which[true]


def _pass(block: Phrases, first_pass: bool, cut: tuple[str, str] | None = None):
    """Adds one block's spans and items to those of earlier passes.

    With ``cut``, a text column and a filler, the spans are cut out of that column instead.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 2 << 20):
            words = split_words(batch.column("_text"))
            start, which = block.occurrences(words)
            n = batch.num_rows
            document = np.searchsorted(words.first, start, side="right") - 1
            spans: dict[int, list[int]] = defaultdict(list)
            items: dict[int, set[str]] = defaultdict(set)
            for d, s, w in zip(document.tolist(), start.tolist(), which.tolist()):
                s -= int(words.first[d])
                spans[d] += (s, s + int(block.lengths[w]))
                items[d] |= block.items[w]
            _, bounds = text_buffers(batch.column("_text"))
            if not first_pass:
                for d, (old, listed) in enumerate(
                    zip(batch.column("_spans").to_pylist(), batch.column("_items").to_pylist())
                ):
                    if old:
                        spans[d] += old
                        items[d] |= set(listed)
            merged: list[list[int]] = [[] for _ in range(n)]
            places: list[list[int]] = [[] for _ in range(n)]
            for d, found in spans.items():
                merged[d] = merge_spans(found)
                base, offset = int(words.first[d]), int(bounds[d])
                for a, b in zip(merged[d][::2], merged[d][1::2]):
                    places[d] += (int(words.begins[base + a]) - offset, int(words.ends[base + b - 1]) - offset)
            names = ["_n_words", "_n_hit", "_spans", "_bytes", "_items"]
            kept = [c for c in batch.schema.names if c not in names]
            if cut:
                kept.remove("_text")
                texts = _without(batch.column(cut[0]), places, cut[1])
                columns = [texts if c == cut[0] else batch.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(columns, kept)
                continue
            state = [
                pa.array(np.diff(words.first), pa.int64()),
                pa.array([sum(m[1::2]) - sum(m[::2]) for m in merged], pa.int64()),
                pa.array(merged, pa.list_(pa.int64())),
                pa.array(places, pa.list_(pa.int64())),
                pa.array([sorted(items[d] - {None}) if d in items else [] for d in range(n)], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + state, kept + names)

    return run


def merge_spans(flat: list[int]) -> list[int]:
    """[begin, end, begin, end, ...] with overlapping and touching spans made one."""
    out: list[int] = []
    for a, b in sorted(zip(flat[::2], flat[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def _without(texts: pa.Array, places: list[list[int]], filler: str) -> pa.Array:
    out = texts.to_pylist()
    for d, spans in enumerate(places):
        if spans:
            raw = out[d].encode()
            edges = [0, *spans, len(raw)]
            out[d] = filler.join(raw[a:b].decode() for a, b in zip(edges[::2], edges[1::2]))
    return pa.array(out, pa.string())


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 4 << 20,
    filler: str | None = None,
) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_hit`` (words in spans), ``_spans`` (word positions),
    ``_bytes`` (UTF-8 positions) and ``_items`` (ids as text) of all benchmark windows that
    occur in each text.

    A span list is flat: begin, end, begin, end. A null or empty text has no words; a null or
    wordless item matches nothing; an item with a null id marks words but is not listed;
    repeated items count once; an empty table gives none. All columns of ``docs`` stay, but
    ones with these five names or ``_text`` are replaced.

    With a ``filler`` nothing is added: each span is cut out of its text, the filler in its
    place, texts without a span are unchanged, and columns of any name pass.
    """
    if filler is not None:
        docs, back = apart(docs, text=text_col)
        text_col = "text"
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
    items = items.filter("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    docs = docs.drop(*STATE.replace(",", "").split()[::2]) if filler is None else docs
    out = docs.withColumn("_text", F.col(text_col))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        phrases = Phrases([r.text for r in block], [r.id for r in block], window)
        if filler is not None and k == blocks - 1:
            return back(out.mapInArrow(_pass(phrases, k == 0, (text_col, filler)), docs.schema))
        out = out.mapInArrow(_pass(phrases, k == 0), f"{kept}, {STATE}")
    return out.drop("_text")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and item checksum of each document of :func:`find_contamination`."""
    return found.select(
        F.col(id_col).alias("doc_id"),
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )
