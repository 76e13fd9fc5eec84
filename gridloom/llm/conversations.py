"""Repair of conversations by alignment with the alternating grammar.

The role initials of a sound conversation are a grammar string: nothing, or an optional ``s``
and then ``ua`` once or more. A conversation is aligned with the grammar string of every
feasible length by Wagner and Fischer's table, filled from the end so that a walk from the
start reads off the ASCII-least of the cheapest edits. Ukkonen's bands hold only the diagonals
that can still reach the incumbent cost, lengths that cannot reach it are passed over, and of
equally cheap lengths the backtraced audits are compared.

Edits of a row: Keep costs 0, Rerole to user or assistant 1, Delete 2; Insert of an empty user
or assistant turn costs 5. Blank and duplicate rows must be deleted; a truncated row that is not
adds 5.

Rows are shuffled once, by conversation. A task streams through its sorted rows: first a byte
for each row of a conversation, then the rows themselves, so it holds bytes, never texts. Beyond
``LONG`` rows the table's columns are folded by the grammar's period into four, which gives the
same audit in time and space linear in the rows. A checksum of a whole conversation can only be
taken in order, so one conversation stays in one task however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows above which the table's columns are folded.
LONG = 128
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
INITIALS = "sua"
FAULTS = ("none", "blank", "duplicate", "truncated")
#: Codes of a row are 4 * initial + fault. For the alignment blank and duplicate rows are x,
#: truncated ones upper case, initials that the grammar lacks o.
LETTERS = bytes(ord(x) for initial in "suao" for x in (initial, "x", "x", initial.upper()))
LEGAL = frozenset({(0, 1), (1, 2), (2, 1)})
ROLES = {ord("u"): "user", ord("a"): "assistant"}
FAR = 1 << 60


def target(length: int) -> bytes:
    """The grammar string of a length; there is none of length 1."""
    return b"s" * (length % 2) + b"ua" * (length // 2)


def _taking(row: int, symbol: int) -> tuple[int, int]:
    """(cost, letter) of turning a row into a symbol."""
    if row == ord("x"):
        return FAR, 0
    extra = TRUNCATED if row < ord("a") else 0
    if row | 32 == symbol:
        return extra, ord("K")
    return (FAR, 0) if symbol == ord("s") else (extra + REROLE, ord("R"))


def _to_length(rows: bytes, goal: bytes, limit: int) -> tuple[int, bytes] | None:
    """(cost, least audit) of aligning ``rows`` with ``goal`` at a cost of ``limit`` or less."""
    n, m = len(rows), len(goal)
    beyond = m - n
    slack = (limit - (INSERT * beyond if beyond > 0 else -DELETE * beyond)) // (INSERT + DELETE)
    if slack < 0:
        return None
    low, high = min(0, beyond) - slack, max(0, beyond) + slack
    width = high - low + 1
    table = [[FAR] * (width + 1) for _ in range(n + 2)]  # column of target place j: j - i - low
    for i in range(n, -1, -1):
        here, below = table[i], table[i + 1]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            at = j - i - low
            if i == n and j == m:
                here[at] = 0
                continue
            cost = FAR
            if i < n and at:
                cost = below[at - 1] + DELETE
            if j < m:
                if goal[j] != 115:
                    cost = min(cost, here[at + 1] + INSERT)
                if i < n:
                    cost = min(cost, below[at] + _taking(rows[i], goal[j])[0])
            here[at] = cost
    if not 0 <= -low < width or table[0][-low] > limit:
        return None
    audit, i, j = bytearray(), 0, 0
    while i < n or j < m:
        at = j - i - low
        cost = table[i][at]
        if i < n and at and table[i + 1][at - 1] + DELETE == cost:
            audit.append(ord("D"))
            i += 1
        elif j < m and goal[j] != 115 and table[i][at + 1] + INSERT == cost:
            audit.append(ord("I"))
            j += 1
        else:
            audit.append(_taking(rows[i], goal[j])[1])
            i, j = i + 1, j + 1
    return table[0][-low], bytes(audit)


def align_lengths(rows: bytes) -> tuple[int, bytes]:
    """(cost, audit) over the grammar strings of all feasible lengths."""
    n, forced = len(rows), rows.count(b"x")
    best = (DELETE * n, b"D" * n)  # the empty string

    def bound(length: int) -> int:
        deleted = max(forced, n - length)
        return DELETE * deleted + INSERT * (length - n + deleted)

    lengths = sorted((bound(m), m) for m in range(2, n + DELETE * n // INSERT + 1))
    for least, m in lengths:
        if least > best[0]:
            break
        found = _to_length(rows, target(m), best[0])
        if found:
            best = min(best, found)
    return best


def align_folded(rows: bytes) -> tuple[int, bytes]:
    """As :func:`align_lengths`, with the columns at equal places of the grammar's period as one.

    Places: 0 before all, 1 after ``s``, 2 after ``u``, 3 after ``a``.
    """
    n = len(rows)
    after = {(0, 115): 1, (0, 117): 2, (1, 117): 2, (2, 97): 3, (3, 117): 2}
    cost = [0, FAR, INSERT, 0]
    cost[1] = INSERT + cost[2]
    choices = [bytearray(n + 1) for _ in range(4)]
    choices[1][n] = choices[2][n] = ord("I")
    moves = [[(symbol, to) for (place, symbol), to in after.items() if place == q] for q in range(4)]
    inserted = [2, 2, 3, 2]
    for i in range(n - 1, -1, -1):
        row, new, letters = rows[i], [0] * 4, [0] * 4
        for q in range(4):
            options = [(cost[q] + DELETE, ord("D"))]
            for symbol, to in moves[q]:
                price, letter = _taking(row, symbol)
                options.append((cost[to] + price, letter))
            new[q], letters[q] = min(options)
        first = list(new)
        for q in (2, 3, 0, 1):
            to = inserted[q]
            by_insert = INSERT + (first[to] if q > 1 else new[to])
            if (by_insert, ord("I")) < (new[q], letters[q]):
                new[q], letters[q] = by_insert, ord("I")
        cost = new
        for q in range(4):
            choices[q][i] = letters[q]
    audit, i, q = bytearray(), 0, 0
    while i < n or q in (1, 2):
        letter = choices[q][i]
        audit.append(letter)
        if letter == ord("I"):
            q = inserted[q]
            continue
        if letter == ord("R"):
            q = 3 if q == 2 else 2
        elif letter == ord("K"):
            q = after[q, rows[i] | 32]
        i += 1
    return cost[0], bytes(audit)


_align_short = lru_cache(1 << 16)(align_lengths)


def align(rows: bytes) -> tuple[int, bytes]:
    """(cost, audit) of the cheapest repair; of equally cheap ones the ASCII-least audit."""
    return _align_short(rows) if len(rows) <= LONG else align_folded(rows)


def _marked(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    """Two rows for each turn, dealt by conversation and sorted: the code (``pass`` 0), then the text."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = turns.select(
        F.col(id_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), space(role_col).alias("role"),
        space(text_col).alias("text"), (F.lit(True) if present is None else present).alias("here"),
    ).repartition("conv")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("conv").orderBy(*order)))
    again = F.row_number().over(Window.partitionBy("conv", "here", "role", "text").orderBy("at")) > 1
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), 1).when(again, 2)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 3).otherwise(0)
    )
    initial = F.lit(len(INITIALS))
    for k, letter in enumerate(INITIALS):
        initial = F.when(F.startswith("role", F.lit(letter)), k).otherwise(initial)
    placed = rows.withColumn("code", F.when(F.col("here"), initial * 4 + fault).otherwise(-1))
    nothing = F.lit(None).cast("string")
    first = F.struct(F.lit(0).alias("pass"), nothing.alias("role"), nothing.alias("text"))
    second = F.struct(F.lit(1).alias("pass"), F.col("role"), F.col("text"))
    both = F.when(F.col("here"), F.array(first, second)).otherwise(F.array(first))
    dealt = placed.select("conv", "at", "turn", "code", F.explode(both).alias("p"))
    return dealt.select("conv", "at", "turn", "code", "p.*").sortWithinPartitions("conv", "pass", "at")


class _Conversation:
    """The state of one conversation while its rows pass."""

    def __init__(self, conv) -> None:
        self.conv, self.codes, self.step, self.made = conv, bytearray(), 0, 0
        self.least = self.last = None
        self.turns = self.cost = 0
        self.audit = None

    def note(self, code: int, turn: int | None) -> None:
        if code < 0:
            return
        self.codes.append(code)
        if turn is not None:
            if self.least is None:
                self.least = turn
            if turn != self.last:
                self.turns, self.last = self.turns + 1, turn

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = align(bytes(self.codes).translate(LETTERS.ljust(256, b"x")))
            self.odd = (len(self.audit) - self.audit.count(b"D")) % 2

    def _symbol(self) -> int:
        at = self.made - self.odd
        self.made += 1
        return ord("s") if at < 0 else b"ua"[at % 2]

    def edits(self, role: str | None, text: str | None) -> Iterator[tuple[int, str, str, str]]:
        """(step, edit, role, text) up to and with the next row's; without a row, what is left."""
        while self.step < len(self.audit):
            letter = self.audit[self.step]
            self.step += 1
            if letter == ord("I"):
                yield self.step, "I", ROLES[self._symbol()], ""
                continue
            if letter == ord("D"):
                yield self.step, "D", role, text
            else:
                symbol = self._symbol()
                yield self.step, chr(letter), role if letter == ord("K") else ROLES[symbol], text
            return

    def counts(self) -> list[int]:
        """gaps, blank, duplicate, truncated, illegal, cost."""
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        faults = [int((codes % 4 == k).sum()) for k in (1, 2, 3)]
        initials = codes // 4
        legal = sum(int(((initials[:-1] == a) & (initials[1:] == b)).sum()) for a, b in LEGAL)
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return [gaps, *faults, max(len(codes) - 1, 0) - legal, self.cost]


def _stream(batches: Iterable[pa.RecordBatch], take: Callable, close: Callable) -> Iterator[tuple]:
    """What ``take(conversation, edit)`` gives for each edit and ``close(conversation)`` at each end."""
    now: _Conversation | None = None
    for batch in batches:
        for conv, _, turn, code, half, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    yield from _ended(now, take, close)
                now = _Conversation(conv)
            if half == 0:
                now.note(code, turn)
                continue
            now.settle()
            for edit in now.edits(role, text):
                yield from take(now, edit)
    if now is not None:
        yield from _ended(now, take, close)


def _ended(now: _Conversation, take: Callable, close: Callable) -> Iterator:
    now.settle()
    for edit in now.edits(None, None):
        yield from take(now, edit)
    yield from close(now)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or weight > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(turns: DataFrame, names: dict, present: Column | None, made: list[tuple[str, str]], run) -> DataFrame:
    marked = _marked(turns, **names, present=present)
    kind = marked.schema["conv"].dataType.simpleString()
    types = {"string": pa.string(), "bigint": pa.int64()}

    def of_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        own = pa.schema([("conv_id", first.schema.field(0).type), *((n, types[k]) for n, k in made)])

        def again() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        yield from _batched(run(again()), own)

    return marked.mapInArrow(of_batches, ", ".join([f"conv_id {kind}", *(f"{n} {k}" for n, k in made)]))


def repair_turns(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", present: Column | None = None,
) -> DataFrame:
    """One row for each edit: ``conv_id``, ``step`` (from 1), ``edit`` (K, R, D or I), ``role``, ``text``.

    The repaired conversation is its rows in the order of ``step`` without the deleted ones,
    which show what was deleted. Rows are taken by turn, null turns first, then by role and
    text. A null role or text is one space, and so blank; a null id is an id like any other.
    A row seen before, in another turn too, is a duplicate. Rows for which ``present`` is false
    are not there. Other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        def take(now, edit):
            yield (now.conv, *edit)

        return _stream(batches, take, lambda now: ())

    names = {"id_col": id_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col}
    made = [("step", "bigint"), ("edit", "string"), ("role", "string"), ("text", "string")]
    return _mapped(turns, names, present, made, run)


def repair_audit(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", present: Column | None = None,
) -> DataFrame:
    """One row for each id of ``turns``: faults, cost, audit and a checksum of the repaired turns.

    Rows are read as by :func:`repair_turns`, whose edits are counted and hashed as they come. An
    id without present rows has zeros, an empty audit and the checksum of nothing.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        def take(now, edit):
            if edit[1] != "D":
                if now.made == 1:
                    now.digest = hashlib.sha256()
                else:
                    now.digest.update(b"\n")
                now.digest.update(f"{edit[2]}:{edit[3]}".encode())
            return ()

        def close(now):
            digest = now.digest if now.made else hashlib.sha256()
            yield (now.conv, *now.counts(), now.audit.decode(), digest.hexdigest())

        return _stream(batches, take, close)

    names = {"id_col": id_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col}
    made = [*((n, "bigint") for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
            ("audit", "string"), ("repaired_sha256", "string")]
    return _mapped(turns, names, present, made, run)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with the contract's faults, by a checksum of ``conv_id:turn``; dropped rows stay with
    ``here`` false, so that their conversation is known."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", space(F.col("role")).alias("role"), space(F.col("text")).alias("text"))
    kind = F.crc32(F.concat(space(F.col("conv_id")), F.lit(":"), space(F.col("turn")))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (kind != 0).alias("here"), F.explode(copies).alias("copy"),
    ).drop("copy")
