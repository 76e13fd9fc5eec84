from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import catalog, pii
from gridloom.llm.bilstm_crf import BiLstmCrf

SF = "/root/testdata/sf0.01"
# The rules as they are stated, without any shortcut.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def stated(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.one_of(
    st.text("ab1.@-+ é", max_size=40), st.text("0125.", max_size=30), st.text("4 -0123", max_size=40),
    st.text("+()12. -3", max_size=40), st.text("a@b.c1 4111111111111111+1 (269) 555-3296", max_size=80),
))
def test_rules_as_stated(text):
    assert pii.base_spans(text) == stated(text)


def test_planted():
    text = "é x.y@mail.example.com, 4111 1111-1111 1111; +1 (269) 555-3296 at 10.0.0.255 or 10.0.0.256."
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in pii.base_spans(text)] == [
        ("email", "x.y@mail.example.com"), ("card", "4111 1111-1111 1111"), ("phone", "+1 (269) 555-3296"), ("ip", "10.0.0.255"),
    ]


def test_gradients():
    net, rng = BiLstmCrf.new(9, 3, 3, 1), np.random.default_rng(0)
    for k in ("moves", "first", "last", "bias"):
        net.parts()[k][:] = rng.normal(0, 0.3, net.parts()[k].shape)
    windows, states = rng.integers(0, 9, (4, 7)), rng.integers(0, 3, (4, 7))
    _, grads = net.loss(windows, states)
    for k, part in net.parts().items():
        for _ in range(5):
            at = tuple(rng.integers(0, d) for d in part.shape)
            old, values = part[at], []
            for shift in (1e-5, -1e-5):
                part[at] = old + shift
                values.append(net.loss(windows, states)[0])
            part[at] = old
            assert (values[0] - values[1]) / 2e-5 == pytest.approx(grads[k][at], abs=1e-6)


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(2)
    net = BiLstmCrf.new(5, 2, 3)
    for k in ("moves", "first", "last"):
        net.parts()[k][:] = rng.normal(0, 1, net.parts()[k].shape)
    scores = rng.normal(0, 1.5, (40, 5, 3))
    paths = np.array(np.meshgrid(*[range(3)] * 5)).reshape(5, -1).T
    found, leaves = net.decode(scores), net.may_leave(scores)
    for row in range(40):
        values = [
            scores[row, range(5), p].sum() + net.first[p[0]] + net.last[p[-1]] + net.moves[p[:-1], p[1:]].sum() for p in paths
        ]
        assert found[row].tolist() == paths[int(np.argmax(values))].tolist()
        assert leaves[row] or not found[row].any()


@pytest.mark.parametrize("length", [0, 1, 47, 48, 49, 384, 385, 5000])
def test_windows_cover(length):
    covered = np.zeros(length, bool)
    for s in pii.window_starts(length):
        covered[s : s + pii.WINDOW] = True
    assert covered.all()


@pytest.fixture(scope="module")
def found(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    return docs, catalog.op5_pii(spark, SF).collect()


def test_query_keeps_the_rules_spans(found):
    docs, got = found
    assert sorted(r.doc_id for r in got) == sorted(docs)
    named = lambda spans: [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
    for r in got:
        base, spans = named(stated(docs[r.doc_id])), [s for s in r.spans.split(",") if s]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(spans)
        places = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert places == sorted(places)
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == sum(s.startswith(kind + ":") for s in spans)


def test_network_finds_held_out_spans(spark):
    texts = sorted({r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect() if re.search("[0-9@]", r.text)})
    model = pii.fit(texts[::2])
    want = hit = added = 0
    for text, spans in zip(texts[1::2], model.spans(texts[1::2])):
        base = pii.base_spans(text)
        want, hit = want + len(base), hit + len(set(base) & set(spans))
        added += sum(not any(s[0] < b[2] and b[0] < s[2] for b in base) for s in spans)
    assert want > 50 and hit > 0.9 * want and added < 0.2 * want


def test_odd_rows(spark):
    mail = "abc.42@mail8.example.com"
    docs = [(1, f"write to {mail} now", "s"), (1, f"write to {mail} now", "s"), (None, mail, "s"), (3, None, None), (4, "", "s"),
            (5, "é " * 40_000 + "10.1.2.3 " + "a" * 50_000 + "@", "s"), (6, "퟿😀" + mail, "s")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, spans string")
    got = pii.personal_data(frame).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(docs) and by_id[1].n_email == 1 and f"email:9:{9 + len(mail)}" in by_id[1].spans
    assert by_id[3].spans == by_id[4].spans == "" and "ip:80000:80008" in by_id[5].spans and "email:2:26" in by_id[6].spans
    nothing = spark.createDataFrame([(1, "no data 12")], "doc_id bigint, text string")
    assert pii.personal_data(nothing).first().spans == ""
    assert pii.personal_data(frame.limit(0)).count() == 0
