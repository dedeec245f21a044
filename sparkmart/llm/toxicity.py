"""Toxicity by subword-bag embeddings and a linear softmax.

A word is a run of letters, lower-cased, between two marks (digits and ``@$*!``
between letters stand for letters, as in m0r0n); its vector is the mean of the vectors of its character n-grams (three to six characters, marks
included, hashed into ``buckets``). A span of ``span`` words is the mean of its
words, where a word that comes again adds nothing (so one repeated word can't
carry a span), and goes through a linear softmax; embeddings and softmax are trained
jointly, in numpy, by Adagrad. A misspelling that was never seen shares most of
its n-grams with the word it stands for, and so its vector.

A document is judged by its worst span, so a rude paragraph is not thinned by a
long text around it, and by the evidence of its distinct words: how far each would
lift a span over half the bias, summed, over the root of how many there are (chance
adds up with length). A logistic of the two is fitted on a quarter of the labelled rows with embeddings from the
others; then the embeddings are fitted on all. Labels belong to documents, so
training alternates: after the first pass a toxic document answers for its worst
span and for the spans already held toxic only; a clean one answers for all.

Fitting reads a bounded sample of the labelled rows (``labelled``, those with the
smallest hashes of their ids), in one task. Scoring reads every whole text, as
arrays of characters; it needs the product of embeddings and softmax only, one
number for each bucket, which all tasks get (``buckets`` floats, fixed in size).

Cases: null and empty texts score by the bias, as a span without evidence; texts
without letters likewise; very long texts are worked off in pieces; labels that are
null are not learnt; without labels of both classes the score is the share of toxic
labels (0 if there are none); with too few to hold a quarter back the worst span
alone decides; repeated rows score alike, and of rows that share a doc_id and a label
one text (the first in order) is learnt; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import functools
import io
import unicodedata
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import filled

#: Most labelled rows that a fit reads.
LABELLED = 6_000
SPAN, BUCKETS_LOG2, DIM, SMALLEST, LARGEST = 16, 17, 8, 3, 6
EPOCHS, BATCH, RATE = 3, 512, 0.5
#: A small sample is gone over more often, in smaller batches, for as many steps.
STEPS, SMALL_BATCH = 400, 32
THRESHOLD = 0.7
#: The part of the labelled rows on which evidence is weighed, its penalty and steps.
POOL_PART, POOL_PENALTY, POOL_STEPS = 4, 3e-4, 50
#: Characters that are worked off at once, cut between words.
STEP = 1 << 20


#: What may stand for a letter inside a word, besides digits and combining marks.
STAND_INS = "@$*!"


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For each code point: 2 a letter, 1 what may stand for one, 0 anything else."""
    def kind(c: int) -> int:
        if 0xD800 <= c < 0xE000:
            return 0
        x = chr(c)
        return 2 if x.isalpha() else int(x in STAND_INS or unicodedata.category(x) in ("Nd", "Mn", "Mc"))

    return np.fromiter(map(kind, range(0x110000)), np.uint8, 0x110000)


def _codes(text: str) -> np.ndarray:
    """The letters of the text, lower-cased, with one space around each word."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    kind = _kinds()[c]
    doubt = kind == 1
    if doubt.any():  # they count in runs with a letter on both sides
        edge = np.flatnonzero(~doubt)
        at = np.flatnonzero(doubt)
        after = np.searchsorted(edge, at)
        kind[at] = np.minimum(kind[edge[after - 1]], kind[edge[after]])
    c = np.where(kind == 2, c, np.uint32(32))
    gap = c == 32
    keep = np.ones(len(c), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    return c[keep]


def _pieces(codes: np.ndarray):
    """Cut between words, so that memory doesn't grow with the text."""
    gaps = np.flatnonzero(codes == 32)
    at = 0
    while at < len(codes) - 1:
        end = gaps[max(np.searchsorted(gaps, at + STEP, "right") - 1, np.searchsorted(gaps, at, "right"))]
        yield codes[at:end + 1]
        at = end


def _ngrams(codes: np.ndarray):
    """(word, bucket) of the n-grams, one pair of arrays for each length."""
    gaps = np.flatnonzero(codes == 32)
    word = np.cumsum(codes == 32) - 1
    after = np.append(gaps, len(codes) + LARGEST)[word + 1]  # the end of the word that begins or goes on here
    place = np.arange(len(codes))
    h = codes.astype(np.uint32)
    for n in range(2, LARGEST + 1):
        h = h[:len(codes) - n + 1] * np.uint32(0x01000193) ^ codes[n - 1:]
        if n < SMALLEST or not len(h):
            continue
        inside = place[:len(h)] + n - 1 <= after[:len(h)]
        x = h[inside] * np.uint32(0x9E3779B1)
        yield word[:len(h)][inside], (x ^ x >> np.uint32(15)) >> np.uint32(32 - BUCKETS_LOG2)


def _word_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    gaps = np.flatnonzero(codes == 32)
    if len(gaps) < 2:
        return np.zeros(0, np.uint64)
    inside = np.arange(gaps[-1]) - np.repeat(gaps[:-1], np.diff(gaps))
    powers = np.cumprod(np.full(int(inside.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    return np.add.reduceat(codes[:gaps[-1]].astype(np.uint64) * powers[inside], gaps[:-1])


@dataclass
class Model:
    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray
    #: Weights of worst span and evidence, and a constant.
    pool: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, embeddings=self.embeddings, softmax=self.softmax, bias=self.bias, pool=self.pool)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Model:
        with np.load(io.BytesIO(raw)) as z:
            return cls(z["embeddings"], z["softmax"], z["bias"], z["pool"])

    def scorer(self) -> Scorer:
        return Scorer((self.embeddings @ (self.softmax[1] - self.softmax[0])).astype(np.float32),
                      float(self.bias[1] - self.bias[0]), self.pool)


@dataclass
class Scorer:
    """The log-odds that each bucket adds, and the bias."""

    odds: np.ndarray
    bias: float
    pool: np.ndarray
    span: int = SPAN

    def word_odds(self, codes: np.ndarray) -> np.ndarray:
        n = int((codes == 32).sum()) - 1
        total, count = np.zeros(n), np.zeros(n)
        for word, bucket in _ngrams(codes):
            total += np.bincount(word, self.odds[bucket], n)[:n]
            count += np.bincount(word, minlength=n)[:n]
        return total / np.maximum(count, 1)

    def evidence(self, text: str | None) -> np.ndarray:
        """Log-odds of the worst span, and the evidence of the distinct words."""
        parts = [(self.word_odds(p), _word_hashes(p)) for p in _pieces(_codes(text or ""))]
        words = np.concatenate([np.zeros(0), *(p[0] for p in parts)])
        if not len(words):
            return np.array([self.bias, 0.0])
        same = np.concatenate([p[1] for p in parts])
        order = np.argsort(same, kind="stable")
        before = np.full(len(words), -1)
        again = same[order[1:]] == same[order[:-1]]
        before[order[1:][again]] = order[:-1][again]
        size = min(self.span, len(words))
        starts = np.arange(0, len(words) - size + 1, max(1, self.span // 2))
        if starts[-1] + size < len(words):  # the rest is read with the words before it
            starts = np.append(starts, len(words) - size)
        place = starts[:, None] + np.arange(size)
        worst = np.where(before[place] < starts[:, None], words[place], 0).sum(1).max() / size
        once = words[before < 0]
        lift = np.maximum(once / self.span + self.bias / 2, 0).sum()
        return np.array([worst + self.bias, lift / np.sqrt(len(once) + self.span)])

    def score(self, text: str | None) -> float:
        z = float(self.pool[:-1] @ self.evidence(text) + self.pool[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _table(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram buckets of each word: their ends and the buckets."""
    pairs = list(_ngrams(_codes(" ".join(vocabulary))))
    word, bucket = (np.concatenate(x) for x in zip(*pairs))
    order = np.argsort(word, kind="stable")
    return np.cumsum(np.bincount(word, minlength=len(vocabulary))), bucket[order]


def fit(texts: list[str], toxic: list[int], seed: int = 7, epochs: int = EPOCHS) -> Model:
    rng = np.random.default_rng(seed)
    b = 1 << BUCKETS_LOG2
    model = Model(rng.uniform(-1 / DIM, 1 / DIM, (b, DIM)).astype(np.float32), np.zeros((2, DIM), np.float32),
                  np.zeros(2, np.float32))
    known, spans, lengths, owner = {}, [], [], []
    for k, text in enumerate(texts):
        ids = [known.setdefault(w, len(known)) for w in _codes(text or "").tobytes().decode("utf-32-le").split()]
        for at in range(0, len(ids), SPAN):
            part = ids[at:at + SPAN] if len(ids) - at >= SPAN // 2 else ids[-SPAN:]
            spans.append(np.unique(part))
            lengths.append(len(part))
            owner.append(k)
    y = np.array(toxic, np.int64)
    rate = y.mean() if len(y) else 0.0
    if not spans or rate in (0.0, 1.0):
        model.bias[1] = np.clip(np.log(max(rate, 1e-12) / max(1 - rate, 1e-12)), -27, 27)
        return model
    ends, buckets = _table(list(known))
    begins = np.concatenate([[0], ends[:-1]])
    owner, lengths = np.array(owner), np.array(lengths)
    label = y[owner]
    odds = np.zeros(len(spans))
    model.softmax[:] = rng.normal(0, 0.1, model.softmax.shape)
    seen_e = np.full(b, 1e-4, np.float32)
    batch = int(np.clip(len(spans) // 64, SMALL_BATCH, BATCH))
    epochs = max(epochs, -(-STEPS * batch // len(spans)))
    seen_w, seen_b = np.full((2, DIM), 1e-2, np.float32), np.full(2, 1e-2, np.float32)
    for epoch in range(epochs):
        use = np.ones(len(spans), bool)
        if epoch:
            top = np.full(len(y), -np.inf)
            np.maximum.at(top, owner, odds)
            use = (label == 0) | (odds >= top[owner]) | (odds > 0)
        order = rng.permutation(np.flatnonzero(use))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            sizes = np.array([len(spans[i]) for i in pick])
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            own, place = np.unique(np.concatenate([spans[i] for i in pick]), return_inverse=True)
            count = ends[own] - begins[own]
            cut = np.concatenate([[0], np.cumsum(count)[:-1]])
            rows = np.arange(count.sum()) + np.repeat(begins[own] - cut, count)
            used, spot = np.unique(buckets[rows], return_inverse=True)
            vec = np.add.reduceat(model.embeddings[used][spot], cut) / count[:, None]
            mean = np.add.reduceat(vec[place], firsts) / lengths[pick][:, None]
            z = mean @ model.softmax.T + model.bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            odds[pick] = z[:, 1] - z[:, 0]
            d = p
            d[np.arange(len(pick)), label[pick]] -= 1
            dw, db, dmean = d.T @ mean, d.sum(0), d @ model.softmax
            dvec = np.zeros_like(vec)
            np.add.at(dvec, place, np.repeat(dmean / lengths[pick][:, None], sizes, axis=0))
            de = np.zeros((len(used), DIM), np.float32)
            np.add.at(de, spot, np.repeat((dvec / count[:, None]).astype(np.float32), count, axis=0))
            seen_e[used] += (de ** 2).mean(1)
            model.embeddings[used] -= RATE * de / np.sqrt(seen_e[used])[:, None]
            seen_w += dw ** 2
            seen_b += db ** 2
            model.softmax -= RATE * dw / np.sqrt(seen_w)
            model.bias -= RATE * db / np.sqrt(seen_b)
    return model


def _weigh(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the columns of ``x`` and a constant: a logistic, by Newton's method."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = POOL_PENALTY * len(x) * np.array([1.0] * x.shape[1] + [1e-3])
    w = np.zeros(z.shape[1])
    for _ in range(POOL_STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(penalty + 1e-9),
                             z.T @ (y - p) - penalty * w)
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] / scale) @ mean)


def fit_pooled(texts: list[str], toxic: list[int], seed: int = 7) -> Model:
    """``fit`` on all rows, with the pool's weights from rows held back meanwhile."""
    y = np.array(toxic, np.int64)
    back = np.arange(len(y)) % POOL_PART == 0
    model = fit(texts, toxic, seed)
    if len(y) and all(0 < y[part].sum() < part.sum() for part in (back, ~back)):
        part = fit([t for t, b in zip(texts, back) if not b], y[~back].tolist(), seed).scorer()
        model.pool = _weigh(np.array([part.evidence(t) for t, b in zip(texts, back) if b]), y[back])
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """Fit on the ``labelled`` rows, at most, with the smallest hashes of their ids."""
    chosen = labels.where(~held_out() & F.col("toxic").isNotNull()).select("doc_id", "toxic").distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "toxic").agg(F.min(filled("text")).alias("text"))  # at most ``labelled`` rows

    def run(pdf):
        import pandas as pd
        pdf = pdf.sort_values(["order", "doc_id", "toxic"])
        return pd.DataFrame({"model": [fit_pooled(pdf["text"].tolist(), pdf["toxic"].tolist()).to_bytes()]})

    out = rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"),
                      F.xxhash64("doc_id").alias("order"), F.lit(1).alias("one")) \
        .groupBy("one").applyInPandas(run, "model binary").collect()
    return Model.from_bytes(bytes(out[0].model)) if out else fit([], [])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A column with the score of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model.scorer())  # of a fixed size

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd
        s = shared.value
        return pd.Series([s.score(t) for t in texts], dtype="float64")

    return score(F.col(text_col))


def toxicity(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    model = train(docs, labels, labelled)
    s = docs.select("doc_id", held_out().alias("held_out"), scores(docs, model).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
