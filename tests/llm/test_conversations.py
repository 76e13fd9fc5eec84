from __future__ import annotations

import hashlib
import random
import re
import zlib

from gridloom.llm import catalog, conversations
from gridloom.llm.conversations import align_folded, align_lengths
from tests.conftest import rows
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(letters: str):
    """(cost, audit) over all scripts with at most three insertions in a row."""
    best = None

    def go(i, made, cost, audit, inserted):
        nonlocal best
        if (best and cost > best[0]) or not re.fullmatch("s?(ua)*u?", made):
            return
        if i == len(letters) and re.fullmatch("(s?(ua)+)?", made):
            best = min(best or (cost, audit), (cost, audit))
        if i < len(letters):
            go(i + 1, made, cost + 2, audit + "D", 0)
            if letters[i] != "x":
                extra = 5 * letters[i].isupper()
                go(i + 1, made + letters[i].lower(), cost + extra, audit + "K", 0)
                for symbol in "ua":
                    go(i + 1, made + symbol, cost + extra + 1, audit + "R", 0)
        if inserted < 3:
            for symbol in "ua":
                go(i, made + symbol, cost + 5, audit + "I", inserted + 1)

    go(0, "", 0, "", 0)
    return best[0], best[1].encode()


def test_alignment_equals_all_scripts():
    rng = random.Random(5)
    for _ in range(300):
        letters = "".join(rng.choice("suaouaxSUAO") for _ in range(rng.randint(0, 6)))
        assert align_lengths(letters.encode()) == brute(letters) == align_folded(letters.encode()), letters


def test_folded_columns_equal_all_lengths():
    rng = random.Random(6)
    for _ in range(60):
        letters = "".join(rng.choice("suauauauauaxSUAO") for _ in range(rng.randint(0, 70))).encode()
        assert align_lengths(letters) == align_folded(letters), letters


def test_query_equals_sql(spark):
    con = duck(SF)
    difference, n = compare(spark, con, catalog.op13_repair, catalog.ORACLES["op13_repair"], SF)
    assert difference is None and n == 100


def plain(turns):
    """The audit rows by hand-written rules, from damaged (conv, turn, role, text)."""
    out = {}
    for conv, turn, role, text in turns:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or " ", text or (" " if text is None else "")))
    for conv, found in out.items():
        found.sort()
        seen, letters, kinds = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in found:
            body = text.strip(" \t\n\v\f\r")
            kind = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            initial = role[0] if role[0] in "sua" else "o"
            letters += "x" if kind in ("blank", "duplicate") else initial.upper() if kind else initial
            if kind:
                kinds[kind] += 1
        initials = [r[2][0] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns_ = {r[1] for r in found if r[0]}
        gaps = max(turns_) - min(turns_) + 1 - len(turns_) if turns_ else 0
        cost, audit = brute(letters)
        made, goal = [], conversations.target(len(audit) - audit.count(b"D")).decode()
        at = 0
        for letter in audit.decode():
            row = None if letter == "I" else found[at]
            at += row is not None
            if letter != "D":
                name = {"u": "user", "a": "assistant"}.get(goal[len(made)])
                made.append((row[2] if letter == "K" else name) + ":" + (row[3] if row else ""))
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out[conv] = (conv, gaps, *kinds.values(), illegal, cost, audit.decode(), digest, made)
    return out


def odd_turns():
    rng = random.Random(9)
    texts = ["Yes.", "No!", "cut", "", " \t", None, "Why?", "é.", "a\nb. "]
    turns = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0, 1, 2, 5]), rng.choice(["user", "assistant", "system", None, "tool", "umpire"]),
              rng.choice(texts)) for _ in range(24)]
    return turns + [(7, 1, "user", "x." * 100_000), (7, 2, "assistant", "Fine."), (8, None, "user", "Twice."), (8, None, "user", "Twice.")]


def test_audit_of_odd_rows(spark):
    turns = odd_turns()
    frame = spark.createDataFrame([(*t, 1, "x", "y") for t in turns], SCHEMA + ", at int, conv string, here string")
    want = {k: v[:-1] for k, v in plain(turns).items()}
    got = {r.conv_id: tuple(r) for r in conversations.repair_audit(frame).collect()}
    assert got == want
    assert conversations.repair_audit(frame.limit(0)).count() == 0


def test_repaired_turns(spark):
    turns = odd_turns()
    frame = spark.createDataFrame(turns, SCHEMA)
    want = plain(turns)
    made = {}
    for r in sorted(conversations.repair_turns(frame).collect(), key=lambda r: r.step):
        made.setdefault(r.conv_id, [])
        if r.edit != "D":
            made[r.conv_id].append(f"{r.role}:{r.text}")
    assert made == {k: v[-1] for k, v in want.items()}


def test_long_conversation(spark):
    n = 3000
    frame = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, if(id % 100 = 7, '', '.')) AS text")
    row = conversations.repair_audit(frame).first()
    assert row.truncated == 30 and row.illegal == 0 and row.cost == 30 * 4  # with a neighbour: two deletions
    assert len(row.audit) >= n


def test_damage(spark):
    turns = [(c, t, "assistant", "One. Two?") for c in (None, 3, 11) for t in (None, *range(60))]
    got = rows(conversations.damage(spark.createDataFrame(turns, SCHEMA)).filter("here"), "conv_id", "turn", "role", "text")
    want = []
    for c, t, role, text in turns:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else "One Two" if kind == 2 else text)
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_all_rows_dropped(spark):
    frame = spark.createDataFrame([(1, 1, "user", "Hi."), (2, 1, "user", "Hi.")], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_audit(frame, present=frame.conv_id == 2).collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2][6] == "D"
