"""Personal data by a character-level bidirectional LSTM with CRF transitions.

Rules find well-formed addresses and numbers. On a bounded sample of the corpus their spans
are the labels from which the network is trained; in use it reads every text in overlapping
windows, so it also marks what only looks like such data: a malformed address, a card number
with a wrong check digit. None of the four kinds can do without a digit or an at sign, so windows
without either are passed over. Each window is decoded on its own; the spans of a text's windows are
then reconciled as a whole. The rules' own spans always stay, and a span of the network is
added where it overlaps none of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.bilstm_crf import BiLstmCrf
from gridloom.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The rules' patterns; possessive, as no shorter repeat of theirs could let the rest match.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Window and overlap in characters, and windows read at once.
WINDOW, OVERLAP, AT_ONCE = 384, 48, 512
HIDDEN = 8
#: Characters: ASCII, any other one, none.
OTHER, NONE, CLASSES = 128, 129, 130
#: Least log odds of a span against none in its place, by the scores of the two paths.
LEAST_ODDS = 8.0
IS_SIGN = np.array([chr(c) in "0123456789@" for c in range(CLASSES)])
IN_WORD = np.array([chr(c).isalnum() for c in range(OTHER)] + [True, False])

Span = tuple[int, int, int]  # start, kind, end


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The rules' spans in order of start, then kind."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(points, OTHER).astype(np.uint8)


def window_starts(length: int) -> list[int]:
    """Starts of overlapping windows that cover a text; each place is inside one by half the overlap."""
    step = WINDOW - OVERLAP
    return list(range(0, max(length - OVERLAP, 1), step)) if length else []


@dataclass
class PiiModel:
    net: BiLstmCrf

    def spans(self, texts: Sequence[str]) -> list[list[Span]]:
        """The network's reconciled spans in each text."""
        codes = [classes_of(t) for t in texts]
        starts = [window_starts(len(c)) for c in codes]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        begin = np.array([s for some in starts for s in some], np.int64)
        bounds = np.cumsum([0, *map(len, codes)])
        joined = np.concatenate([*codes, np.full(WINDOW, NONE, np.uint8)]) if codes else np.zeros(0, np.uint8)
        signs = np.concatenate([[0], np.cumsum(IS_SIGN[joined])])
        ends = bounds[owner] + np.minimum(begin + WINDOW, bounds[owner + 1] - bounds[owner])
        may = signs[ends] > signs[bounds[owner] + begin]
        owner, begin = owner[may], begin[may]
        found: list[list[tuple[float, Span]]] = [[] for _ in texts]
        order = np.argsort(np.minimum(bounds[owner + 1] - bounds[owner] - begin, WINDOW), kind="stable")
        for part in np.split(order, range(AT_ONCE, len(order), AT_ONCE)):
            if not len(part):
                continue
            left = bounds[owner[part] + 1] - bounds[owner[part]] - begin[part]
            width = min(WINDOW, int(left.max()))
            place = (bounds[owner[part]] + begin[part])[:, None] + np.arange(width)
            windows = np.where(np.arange(width) < left[:, None], joined[np.minimum(place, len(joined) - 1)], NONE)
            scores = self.net.emissions(windows)
            rows = np.flatnonzero(self.net.may_leave(scores))
            if len(rows):
                scores = scores[rows]
                states = self.net.decode(scores)
                for r, row in enumerate(rows):
                    self._add(found[owner[part[row]]], states[r], scores[r], int(begin[part[row]]), int(min(left[row], width)))
        return [_reconcile(some, code) for some, code in zip(found, codes)]

    def _add(self, into: list[tuple[float, Span]], states: np.ndarray, scores: np.ndarray, begin: int, size: int) -> None:
        moves, edges = self.net.moves, np.flatnonzero(np.r_[True, states[1:size] != states[: size - 1], True])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if k := int(states[a]):
                turns = moves[0, k] + moves[k, 0] + (b - a - 1) * moves[k, k] - (b - a + 1) * moves[0, 0]
                into.append((float((scores[a:b, k] - scores[a:b, 0]).sum() + turns), (begin + a, k - 1, begin + b)))


def _reconcile(found: list[tuple[float, Span]], code: np.ndarray) -> list[Span]:
    """Of spans that overlap, from one window or two, the surest stays; ties by place. A span that
    begins or ends inside a word is none."""

    def whole(start: int, end: int) -> bool:
        cut = lambda at: 0 < at < len(code) and IN_WORD[code[at - 1]] and IN_WORD[code[at]]
        return not cut(start) and not cut(end)

    chosen: list[Span] = []
    for odds, span in sorted(set(found), key=lambda x: (-x[0], x[1])):
        if odds >= LEAST_ODDS and whole(span[0], span[2]) and not any(span[0] < s[2] and s[0] < span[2] for s in chosen):
            chosen.append(span)
    return sorted(chosen)


def fit(texts: Sequence[str], steps: int = 400, windows: int = 1800, length: int = 64, seed: int = 0) -> PiiModel | None:
    """Trains on windows of the texts around the rules' spans and elsewhere; None without spans.

    Few spans are shown at several places of a window, so the work does not depend on them.
    """
    rng, batch = np.random.default_rng(seed), 64
    labelled = [(classes_of(t), np.zeros(len(t), np.int8), base_spans(t)) for t in texts]
    around = sum(len(spans) for *_, spans in labelled)
    if not around:
        return None
    shows = min(20, -(-windows // around))
    inside: list[tuple[np.ndarray, np.ndarray]] = []
    plain: list[tuple[np.ndarray, np.ndarray]] = []
    for code, state, spans in labelled:
        for start, kind, end in reversed(spans):
            state[start:end] = kind + 1
        places = [max(0, s - int(rng.integers(0, length - 10))) for s, _, _ in spans for _ in range(shows)]
        places += rng.integers(0, max(len(code) - length, 1), min(shows, 4)).tolist() if len(code) else []
        for at in places:
            row, label = np.full(length, NONE, np.uint8), np.zeros(length, np.int8)
            piece = code[at : at + length]
            row[: len(piece)], label[: len(piece)] = piece, state[at : at + length]
            (inside if label.any() else plain).append((row, label))
    picked = [some[i] for some, n in ((inside, windows * 2 // 3), (plain, windows // 3)) for i in rng.permutation(len(some))[:n]]
    net = BiLstmCrf.new(CLASSES, HIDDEN, len(KINDS) + 1, seed)
    epochs = -(-steps * batch // len(picked))
    net.train(np.stack([w for w, _ in picked]), np.stack([s for _, s in picked]), epochs, batch, rate=0.03, seed=seed)
    return PiiModel(net)


def learn(docs: DataFrame, text_col: str = "text", sample_rows: int = 1500, sample_bytes: int = 50_000) -> PiiModel | None:
    """Fits on at most ``sample_rows`` distinct texts that hold a digit or an at sign, the first in
    the order of the text's hash, none longer than ``sample_bytes``; that bounds what the driver
    gets and the time of training."""
    hashed = docs.select(F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_hash")).filter(
        F.col("_text").rlike("[0-9@]") & (F.octet_length("_text") <= sample_bytes)
    )
    picked = hashed.select("_hash").distinct().orderBy("_hash").limit(sample_rows)
    texts = hashed.join(F.broadcast(picked), "_hash").groupBy("_text").agg(F.min("_hash").alias("_hash"))  # sample_rows hashes
    return fit([r["_text"] for r in texts.orderBy("_hash", "_text").limit(sample_rows).collect()])


def with_spans(docs: DataFrame, model: PiiModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: kind:start:end of the rules' spans and of all spans, by
    start, then kind; code points, end exclusive.

    A null or empty text has none. Without a model the rules stand alone. Repeated rows are
    alike; an empty table gives no rows. Columns of these names are replaced.
    """
    docs = docs.drop("_base", "_spans")
    names = docs.columns
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    named = lambda spans: [f"{KINDS[k]}:{a}:{b}" for a, k, b in spans]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, 1 << 20):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = model.spans(texts) if model else [[] for _ in texts]
            every = [
                sorted([*b, *(s for s in m if not any(s[0] < x[2] and x[0] < s[2] for x in b))]) for b, m in zip(base, more)
            ]
            columns = [pa.array([named(s) for s in some], pa.list_(pa.string())) for some in (base, every)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, "_base", "_spans"])

    return docs.mapInArrow(run, f"{kept}, _base array<string>, _spans array<string>")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id``, counts of all spans by kind, ``base_sha256`` of the rules' spans and ``spans``."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    found = with_spans(picked, learn(docs, text_col, **options), "_text")
    count = lambda kind: F.size(F.filter("_spans", lambda s: F.startswith(s, F.lit(f"{kind}:"))))
    return found.select(
        "doc_id", *(count(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.array_join("_base", ","), 256).alias("base_sha256"), F.array_join("_spans", ",").alias("spans"),
    )
