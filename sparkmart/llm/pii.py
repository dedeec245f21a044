"""Personal data by a character BiLSTM with CRF transitions.

Base spans (e-mail and IP addresses, card and phone numbers by their patterns) are
always found. A character-level bidirectional LSTM with a conditional random field
over begin/inside/outside tags, trained here in numpy from labelled spans, adds what
the patterns miss: obfuscated addresses ("name [at] host [dot] org"), phone numbers
without a country code, cards and addresses with other separators.

Labelled spans are the base spans of a bounded sample of documents (``SAMPLE``, those
with the smallest hashes of their ids), and planted ones: random addresses and numbers,
plain and rewritten, put into text of the sample. Numbers that only look like cards
(wrong check digit) and the like stay outside, as labels of what not to find.

Whole texts are decoded in windows of ``WINDOW`` characters that overlap by half.
All labelled spans have a digit, an ``@`` or a bracketed "at"; a span without one is
never accepted, so windows without one need no decoding. Windows are decoded one by
one, then reconciled over the whole text: a span that a window's edge may have cut, and
that no other window holds, is decoded again in a window around it, which is widened
until the span ends inside; of spans that overlap, the one found by more windows stays,
then the longer, then the earlier; spans that overlap a base span, or can't be of their
kind (an address of three numbers, a card with a wrong check digit), are dropped.

Cases: null counts as the empty text (no spans); repeated rows have equal spans;
without documents to learn from, the planted spans are put into plain filler; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import io
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Most documents that a fit reads; windows that it makes of them.
SAMPLE, WINDOWS = 2_000, 4_000
WINDOW, STRIDE = 64, 32
EMBED, HIDDEN, EPOCHS, BATCH, RATE = 12, 24, 8, 64, 0.01
#: Windows decoded at once.
AT_ONCE = 1_024

TAGS = 1 + 2 * len(KINDS)  # 0 outside, 2k + 1 begins and 2k + 2 goes on with kind k
TRIGGER = re.compile(r"[0-9@]|[\[(]\s*at\s*[\])]", re.IGNORECASE)

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# runs of digits are taken whole, which changes no match and keeps the time linear
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        back = _LOCAL.match(text[done:at][::-1])
        tail = _DOMAIN.match(text, at + 1)
        if back and tail:
            yield at - back.end(), tail.end()
            done = tail.end()
            at = text.find("@", done)
        else:
            # what comes before a mark can't belong to an address after it
            done, at = at + 1, text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind and start."""
    out: list[Span] = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3
                                                            for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def _alphabet() -> np.ndarray:
    """A small number for each code point: printable ASCII, and some classes."""
    table = np.full(0x110000, 96, np.int64)  # other signs
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = 97
    table[32:127] = np.arange(95)
    table[[9, 10, 11, 12, 13]] = 98
    return table


SYMBOLS, PAD = 100, 99
_TABLE: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_alphabet())
    return _TABLE[0][np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, seed: int = 11) -> Tagger:
        r = np.random.default_rng(seed)
        n = lambda *s: (r.normal(0, 1, s) / np.sqrt(s[0])).astype(np.float32)
        p = {"embed": r.normal(0, 0.3, (SYMBOLS, EMBED)).astype(np.float32), "out": n(2 * HIDDEN, TAGS),
             "out_b": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32),
             "first": np.zeros(TAGS, np.float32), "last": np.zeros(TAGS, np.float32)}
        for d in "fb":
            b = np.zeros(4 * HIDDEN, np.float32)
            b[HIDDEN:2 * HIDDEN] = 1  # remember at first
            p |= {f"x{d}": n(EMBED, 4 * HIDDEN), f"h{d}": n(HIDDEN, 4 * HIDDEN), f"b{d}": b}
        # a kind goes on only after its own begin or inside tag
        for k in range(len(KINDS)):
            for t in range(TAGS):
                if t not in (2 * k + 1, 2 * k + 2):
                    p["trans"][t, 2 * k + 2] = -30
            p["first"][2 * k + 2] = 0  # a window may begin inside a span
        return cls(p)

    def to_bytes(self) -> bytes:
        f = io.BytesIO()
        np.savez(f, **self.p)
        return f.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tagger:
        with np.load(io.BytesIO(raw)) as z:
            return cls({k: z[k] for k in z.files})

    def _run(self, e: np.ndarray, d: str, keep: bool):
        """Hidden states of one direction over e (time, row, size)."""
        t, rows, _ = e.shape
        x = e @ self.p[f"x{d}"] + self.p[f"b{d}"]
        h, c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
        out, kept = np.zeros((t, rows, HIDDEN), np.float32), []
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = x[k] + h @ self.p[f"h{d}"]
            s = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before = c
            c = f * c + i * g
            w = np.tanh(c)
            if keep:
                kept.append((k, i, f, o, g, before, w, h))
            h = o * w
            out[k] = h
        return out, kept

    def emissions(self, x: np.ndarray, keep: bool = False):
        e = self.p["embed"][x.T]
        hf, kf = self._run(e, "f", keep)
        hb, kb = self._run(e, "b", keep)
        h = np.concatenate([hf, hb], 2)
        return h @ self.p["out"] + self.p["out_b"], (e, h, kf, kb)

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags of each window (row, time)."""
        z, _ = self.emissions(x)
        t, rows, _ = z.shape
        best, back = z[0] + self.p["first"], np.zeros((t, rows, TAGS), np.int8)
        for k in range(1, t):
            s = best[:, :, None] + self.p["trans"]
            back[k] = s.argmax(1)
            best = s.max(1) + z[k]
        tags = np.zeros((t, rows), np.int64)
        tags[-1] = (best + self.p["last"]).argmax(1)
        for k in range(t - 1, 0, -1):
            tags[k - 1] = back[k][np.arange(rows), tags[k]]
        return tags.T

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean negative log-likelihood of the tags, and its gradients."""
        p = self.p
        z, (e, h, kf, kb) = self.emissions(x, keep=True)
        t, rows, _ = z.shape
        y = y.T
        a, b = np.zeros_like(z), np.zeros_like(z)
        a[0] = z[0] + p["first"]
        for k in range(1, t):
            a[k] = _lse(a[k - 1][:, :, None] + p["trans"], 1) + z[k]
        b[-1] = p["last"]
        for k in range(t - 2, -1, -1):
            b[k] = _lse(p["trans"] + (b[k + 1] + z[k + 1])[:, None, :], 2)
        log_all = _lse(a[-1] + p["last"], 1)
        r = np.arange(rows)
        gold = p["first"][y[0]] + p["last"][y[-1]] + z[np.arange(t)[:, None], r, y].sum(0) \
            + p["trans"][y[:-1], y[1:]].sum(0)
        loss = float((log_all - gold).mean())
        dz = np.exp(a + b - log_all[:, None])
        g = {"first": dz[0].sum(0), "last": dz[-1].sum(0), "trans": np.zeros_like(p["trans"])}
        for k in range(t - 1):
            g["trans"] += np.exp(a[k][:, :, None] + p["trans"] + (b[k + 1] + z[k + 1])[:, None, :]
                                 - log_all[:, None, None]).sum(0)
        np.subtract.at(g["trans"], (y[:-1], y[1:]), 1)
        np.subtract.at(g["first"], y[0], 1)
        np.subtract.at(g["last"], y[-1], 1)
        dz[np.arange(t)[:, None], r, y] -= 1
        g["out"] = np.tensordot(h, dz, ((0, 1), (0, 1)))
        g["out_b"] = dz.sum((0, 1))
        dh = dz @ p["out"].T
        de = np.zeros_like(e)
        for d, kept, part in (("f", kf, dh[:, :, :HIDDEN]), ("b", kb, dh[:, :, HIDDEN:])):
            dx = np.zeros((t, rows, 4 * HIDDEN), np.float32)
            gh = np.zeros_like(p[f"h{d}"])
            nh, nc = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
            for k, i, f, o, q, before, w, h0 in reversed(kept):
                u = part[k] + nh
                c = nc + u * o * (1 - w * w)
                s = np.concatenate([c * q * i * (1 - i), c * before * f * (1 - f), u * w * o * (1 - o),
                                    c * i * (1 - q * q)], 1)
                dx[k] = s
                gh += h0.T @ s
                nh, nc = s @ p[f"h{d}"].T, c * f
            g[f"h{d}"], g[f"b{d}"] = gh, dx.sum((0, 1))
            g[f"x{d}"] = np.tensordot(e, dx, ((0, 1), (0, 1)))
            de += dx @ p[f"x{d}"].T
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], x.T, de)
        return loss, {k: v / rows for k, v in g.items()}

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """The spans of each whole text, base ones and added ones."""
        found: list[Counter] = [Counter() for _ in texts]
        cuts: list[list[Span]] = [[] for _ in texts]
        rows, owner = [], []

        def work():
            tags = self.decode(np.stack(rows))
            for (k, start, size, total), t in zip(owner, tags):
                for kind, a, b in _runs(t[:size]):
                    cut = (a == 0 and start > 0) or (b == size and start + size < total)
                    if cut:
                        cuts[k].append((kind, start + a, start + b))
                    else:
                        found[k][kind, start + a, start + b] += 1
            rows.clear()
            owner.clear()

        for k, text in enumerate(texts):
            if not (marks := [m.start() for m in TRIGGER.finditer(text)]):
                continue
            codes = _codes(text)
            last = max(0, -(-(len(text) - WINDOW) // STRIDE))
            wanted = sorted({w for m in marks for w in range(max(0, (m - WINDOW) // STRIDE + 1), m // STRIDE + 1)
                             if w <= last} | {min(last, m // STRIDE) for m in marks})
            for w in wanted:
                part = codes[w * STRIDE:w * STRIDE + WINDOW]
                rows.append(np.concatenate([part, np.full(WINDOW - len(part), PAD)]))
                owner.append((k, w * STRIDE, len(part), len(text)))
                if len(rows) >= AT_ONCE:
                    work()
        if rows:
            work()
        self._widen(texts, found, [(k, *c, STRIDE) for k in range(len(texts)) for c in _joined(cuts[k], found[k])])
        return [_reconciled(t, base_spans(t), c) for t, c in zip(texts, found)]

    def _widen(self, texts: list[str], found: list[Counter], open_: list[tuple]) -> None:
        """Add to ``found`` what is cut: text, kind, start, end, windows that saw
        it, characters to read on both sides, which double each time."""
        while open_:
            by_width: dict[int, list[tuple]] = {}
            for x in open_:
                _, _, a, b, _, more = x
                by_width.setdefault(-(-(b - a + 2 * more) // STRIDE) * STRIDE, []).append(x)
            open_ = []
            for width, group in sorted(by_width.items()):
                step = max(1, AT_ONCE * WINDOW // width)
                for at in range(0, len(group), step):
                    rows, owner = [], []
                    for k, kind, a, b, n, more in group[at:at + step]:
                        start = max(0, min(a - (width - (b - a)) // 2, len(texts[k]) - width))
                        part = _codes(texts[k][start:start + width])
                        rows.append(np.concatenate([part, np.full(width - len(part), PAD)]))
                        owner.append((k, kind, a, b, n, more, start, len(part)))
                    for (k, kind, a, b, n, more, start, size), t in zip(owner, self.decode(np.stack(rows))):
                        for c, x, y in _runs(t[:size]):
                            if c != kind or start + x >= b or start + y <= a:
                                continue
                            if (x == 0 and start > 0) or (y == size and start + size < len(texts[k])):
                                open_.append((k, kind, min(a, start + x), max(b, start + y), n, 2 * more))
                            else:
                                found[k][kind, start + x, start + y] += n


def _joined(cuts: list[Span], found: Counter) -> list[tuple]:
    """kind, start, end, windows: the cut spans that no found one holds, those that
    overlap or touch as one."""
    out: list[tuple] = []
    whole: dict[int, list[tuple[int, int]]] = {}
    for kind, a, b in sorted(found, key=lambda x: x[1]):
        # of spans by start, only those that end later than all before
        if not (w := whole.setdefault(kind, [])) or b > w[-1][1]:
            w.append((a, b))
    for kind, a, b in sorted(cuts):
        w = whole.get(kind, [])
        i = bisect_right(w, a, key=lambda x: x[0]) - 1
        if i >= 0 and w[i][1] >= b:
            continue
        if out and out[-1][0] == kind and a <= out[-1][2]:
            out[-1] = (kind, out[-1][1], max(b, out[-1][2]), out[-1][3] + 1)
        else:
            out.append((kind, a, b, 1))
    return out


def _runs(tags: np.ndarray):
    """(kind, start, end) of the spans of a window."""
    at = 0
    while at < len(tags):
        t = tags[at]
        if not t:
            at += 1
            continue
        kind, end = int(t - 1) // 2, at + 1
        while end < len(tags) and tags[end] == 2 * kind + 2:
            end += 1
        yield kind, at, end
        at = end


#: An address around its mark: what the network finds is cut down to it.
_SHAPE = re.compile(r"[^\s@]+\s?(?:@|[\[(]\s*at\s*[\])])\s?[^\s@]+?(?:\s?(?:\.|[\[(]\s*dot\s*[\])])\s?[A-Za-z0-9-]+)+", re.I)


def _plausible(kind: int, item: str) -> bool:
    """An added span must be able to be of its kind."""
    numbers = re.findall("[0-9]+", item)
    digits = sum(map(len, numbers))
    if kind == 1:
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    if kind == 2:
        return 16 <= digits <= 19 and luhn("".join(numbers))
    if kind == 3:
        return 8 <= digits <= 15
    return kind == 0


def _reconciled(text: str, base: list[Span], found: Counter) -> list[Span]:
    taken = [(a, b) for _, a, b in base]
    added = []
    cut: Counter = Counter()
    for (kind, a, b), n in found.items():
        if kind:
            cut[kind, a, b] += n
        elif m := _SHAPE.search(text, a, b):
            cut[kind, *m.span()] += n
    for (kind, a, b), n in sorted(cut.items(), key=lambda x: (-x[1], x[0][1] - x[0][2], x[0][1], x[0][0])):
        if _plausible(kind, text[a:b]) and all(b <= x or y <= a for x, y in taken):
            taken.append((a, b))
            added.append((kind, a, b))
    return sorted([*base, *added])


def written_spans(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _planted(rng: np.random.Generator) -> tuple[str, int]:
    """A random item and its kind (-1: looks like one, but is none)."""
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    pick = lambda *x: x[rng.integers(len(x))]
    kind = rng.integers(0, 6)
    if kind == 0:
        at, dot = pick(("@", "."), ("@", "."), (" [at] ", " [dot] "), ("(at)", "."), (" @ ", "."), ("[at]", "."),
                       (" (at) ", " (dot) "))
        user = word(rng.integers(3, 9)) + pick("", digits(2), "." + word(5), "_" + word(3))
        return user + at + word(rng.integers(4, 9)) + pick("", digits(1)) + dot + pick("com", "org", "net", "example.com"), 0
    if kind == 1:
        return pick(".", ".", "[.]", " . ").join(str(x) for x in rng.integers(0, 256, 4)), 1
    if kind in (2, 5):
        body = digits(15)
        check = next(c for c in "0123456789" if luhn(body + c))
        if kind == 5:  # a wrong check digit
            return body + str((int(check) + rng.integers(1, 10)) % 10), -1
        n = body + check
        sep = pick("", " ", "-", ".", "/")
        # without separators only the check digit tells a card, which base spans cover
        return sep.join(n[i:i + 4] for i in range(0, 16, 4)), 2 if sep else -1
    if kind == 3:
        cc, a, b, c = digits(2), digits(3), digits(3), digits(4)
        return pick(f"+{cc} ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{cc} {a} {b}{c}",
                    f"+{cc}{a}{b}{c}", f"{a}.{b}.{c}"), 3
    return pick(digits(rng.integers(1, 6)), digits(rng.integers(7, 20)), f"{digits(1)}.{digits(1)}",
                f"version {digits(1)}.{digits(1)}", f"{digits(2)}:{digits(2)}", f"20{digits(2)}-{digits(2)}-{digits(2)}",
                "".join(rng.choice(list("0123456789abcdef"), 40)), f"@{word(6)}", f"${digits(3)}.{digits(2)}"), -1


def examples(texts: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags: around base spans and other triggers of the texts, and
    planted items in their text."""
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if len(t) > 20] or ["some plain words stand here and there. " * 8]
    xs, ys = [], []

    def add(text: str, spans: list[Span], start: int) -> None:
        part = _codes(text[start:start + WINDOW])
        y = np.zeros(WINDOW, np.int64)
        for kind, a, b in spans:
            a, b = a - start, b - start
            if a < WINDOW and b > 0:
                y[max(a, 0):min(b, WINDOW)] = 2 * kind + 2
                if a >= 0:
                    y[a] = 2 * kind + 1
        xs.append(np.concatenate([part, np.full(WINDOW - len(part), PAD)]))
        ys.append(y)

    for t in texts:
        if len(xs) >= WINDOWS // 2:
            break
        spans = [s for s in base_spans(t) if s[0] != 2]  # a bare card's check digit can't be learnt
        marks = [m.start() for m in TRIGGER.finditer(t)]
        for m in rng.permutation(marks)[:2]:
            add(t, spans, max(0, int(m) - int(rng.integers(0, WINDOW))))
    while len(xs) < WINDOWS:
        t = texts[rng.integers(len(texts))]
        at = int(rng.integers(0, len(t) - 20))
        before, after = t[at:at + WINDOW].split(" "), t[at + 20:at + 20 + WINDOW]
        before = re.sub("[0-9@+]", "", " ".join(before[1:]))
        item, kind = _planted(rng)
        text = f"{before}{rng.choice([' ', ' ', chr(10), ': ', ' ('])}{item}{rng.choice([' ', ' ', '. ', ', ', ')'])}" \
               + re.sub("[0-9@+]", "", after)
        a = text.index(item)
        add(text, [(kind, a, a + len(item))] if kind >= 0 else [], max(0, a - int(rng.integers(0, WINDOW))))
    return np.stack(xs), np.stack(ys)


def fit(texts: list[str], seed: int = 3, epochs: int = EPOCHS) -> Tagger:
    x, y = examples(texts, seed)
    tagger, rng = Tagger.start(), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    s = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    step, steps = 0, epochs * -(-len(x) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            pick = order[at:at + BATCH]
            _, g = tagger.gradients(x[pick], y[pick])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for k, v in g.items():
                v = v * min(1.0, 5 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.999 * s[k] + 0.001 * v * v
                tagger.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)) \
                    .astype(np.float32)
    return tagger


def train(docs: DataFrame, sample: int = SAMPLE) -> Tagger:
    """Fit in one task on the ``sample`` documents, at most, that have a digit or an
    ``@`` and the smallest hashes of their ids."""
    chosen = docs.where(F.col("text").rlike("[0-9@]")).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id") \
        .limit(sample).distinct()
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` ids

    def run(pdf):
        import pandas as pd
        texts = pdf.sort_values(["doc_id", "text"])["text"].tolist()
        return pd.DataFrame({"model": [fit([t for t in texts if t]).to_bytes()]})

    out = rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(run, "model binary").collect()
    return Tagger.from_bytes(bytes(out[0].model)) if out else fit([])


def find(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end; end exclusive) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # of a fixed size

    def run(batches):
        import pyarrow as pa
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        named = lambda s: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in s]
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([named(base_spans(t)) for t in texts], pa.list_(span)),
                 pa.array([named(s) for s in shared.value.spans(texts)], pa.list_(span))],
                names=["doc_id", "base", "spans"])

    kind = "array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def _text_of(spans: str) -> str:
    # the spans come by kind as listed, then start
    return f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, the digest of the base
    spans, and all spans, for each row of ``docs``."""
    found = find(docs, train(docs))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(_text_of("base")), 256).alias("base_sha256"),
                        F.expr(_text_of("spans")).alias("spans"))
