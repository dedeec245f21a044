import hashlib
import random
import re

import numpy as np
import pytest

from sparkmart.llm import pii as P


def naive(t):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for k, pattern, ok in ((2, r"[0-9]([\x20-]?[0-9])+", lambda d: 16 <= len(d) <= 19 and P.luhn(d)),
                           (3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda d: 8 <= len(d) <= 15)):
        out += [(k, *m.span()) for m in re.finditer(pattern, t) if ok(re.sub("[^0-9]", "", m.group()))]
    return out


def test_base_spans_are_the_patterns():
    r = random.Random(7)
    for _ in range(20_000):
        t = "".join(r.choices("ab@@..-1203456789+ ( )%_\né", k=r.randint(0, 40)))
        assert P.base_spans(t) == naive(t)
    t = "4111 1111-1111 1111, a.b@c.de. +49 (30) 123456 1.2.3.4 1.2.3.400 😀 x@y.z"
    assert P.base_spans(t) == naive(t) and len(naive(t)) == 4


def test_base_spans_take_linear_time():
    assert P.base_spans("1" * 300_000 + "a" * 300_000 + "." * 1_000 + "@" * 3_000) == []


def test_gradients():
    t = P.Tagger.start()
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    t.p["trans"][:] = np.random.default_rng(0).normal(0, 0.3, t.p["trans"].shape)
    r = np.random.default_rng(1)
    x, y = r.integers(0, P.SYMBOLS, (3, 7)), r.integers(0, P.TAGS, (3, 7))
    _, g = t.gradients(x, y)
    for k, v in t.p.items():
        i = np.unravel_index(np.argmax(np.abs(g[k])), v.shape)
        old, e = v[i], 1e-3
        v[i] = old + e
        up = t.gradients(x, y)[0]
        v[i] = old - e
        down = t.gradients(x, y)[0]
        v[i] = old
        assert g[k][i] == pytest.approx((up - down) / (2 * e), abs=1e-3)


@pytest.fixture(scope="module")
def tagger():
    r = random.Random(1)
    words = ["".join(r.choices("aeiourstlnmdchp", k=r.randint(2, 9))) for _ in range(900)]
    return P.fit([" ".join(r.choices(words, k=120)) for _ in range(300)])


def test_held_out_tags(tagger):
    r = random.Random(8)
    words = ["".join(r.choices("aeiourstlnmdchp", k=r.randint(2, 9))) for _ in range(900)]
    x, y = P.examples([" ".join(r.choices(words, k=120)) for _ in range(50)], seed=99)
    tags = tagger.decode(x)
    assert (tags == y)[y > 0].mean() > 0.85 and (tags == y)[y == 0].mean() > 0.97


def test_added_spans_and_reconciliation(tagger):
    text = "please write to john.doe [at] example [dot] com today"
    assert [text[a:b] for k, a, b in tagger.spans([text])[0] if k == 0] == ["john.doe [at] example [dot] com"]
    # wherever the windows fall, the span is found once and whole
    for n in range(0, 70, 7):
        pad = "some words go here and there "[:29] * 9
        t = pad[:200 + n] + " " + text
        got = [s for s in tagger.spans([t])[0] if s[0] == 0]
        assert len(got) <= 1 and all("example" in t[a:b] for _, a, b in got)
    assert tagger.spans(["no data in these words", "", "It is 12 o clock, 7 days"]) == [[], [], []]


class Marker(P.Tagger):
    """Tags each window rightly: all but accented letters is an address."""

    def decode(self, x):
        y = np.where((x == 97) | (x == P.PAD), 0, 2)
        y[:, 1:][(y[:, 1:] > 0) & (y[:, :-1] == 0)] = 1
        return y


@pytest.mark.parametrize("item", [
    "john.doe [at] example [dot] com", "john.smith [at] mail [dot] example [dot] com",
    "john.smith [at] " + " [dot] ".join(["department", "faculty", "university", "example", "com"]),
    "john.smith [at] " + " [dot] ".join(["department"] * 30)])
def test_long_spans_are_whole_at_every_offset(item):
    # a window's edge falls on every place of spans of 31, 44, 76 and 516 characters
    texts = ["é" * n + item + "é" * m for n in range(P.STRIDE, 3 * P.STRIDE) for m in (0, 5, 200)]
    got = Marker({}).spans(texts)
    for t, spans in zip(texts, got):
        assert len(spans) == 1 and [t[a:b] for _, a, b in spans] == [item]


def test_network_finds_long_addresses_at_every_offset(tagger):
    item = "john.smith.miller [at] organisation [dot] example"
    pad = "some words go here and there " * 9
    texts = [pad[:200 + n] + " please write to " + item + " today or some other day" for n in range(64)]
    for t, spans in zip(texts, tagger.spans(texts)):
        got = [s for s in spans if s[0] == 0]
        assert len(got) == 1 and "organisation" in t[got[0][1]:got[0][2]]


def test_base_spans_stay(tagger):
    r = random.Random(3)
    for _ in range(200):
        t = "".join(r.choices("ab@.-120345+ ()", k=r.randint(0, 150)))
        spans = tagger.spans([t])[0]
        assert set(P.base_spans(t)) <= set(spans) and spans == sorted(spans)
        extra = [s for s in spans if s not in P.base_spans(t)]
        assert all(b <= c or d <= a for _, a, b in extra for _, c, d in P.base_spans(t))


def test_query(docs):
    rows = [(i, f"write {i} to a{i}@b.org or 10.0.0.{i}") for i in range(1, 30)]
    rows += [(90, None), (91, ""), (92, "é" * 50_000 + " +1 (555) 123-4567"), (93, "x"), (93, "x"), (None, "1.2.3.4")]
    got = P.personal_data(docs(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        base = naive(t or "")
        r, text = by[i], P.written_spans(base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
    assert P.personal_data(docs([])).collect() == []
