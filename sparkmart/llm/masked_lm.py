"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word of a document is predicted from the ``REACH`` words on both sides of it;
the sum of the conditional log-probabilities is the document's score (its pseudo-
log-likelihood). The network gives the probability of each word in up to three steps,
each conditioned on the window: of its class, of its group in the class and of its
place in the group. The most frequent words are classes of their own; the others are
classed by their last two letters. No two numbered words share group and place, so
the window can tell any two apart; a place has one vector in all groups of a class.
Groups and places start from the corpus counts, which the network corrects.

Counting, training and scoring all read every document:

1. Words are counted over the corpus (partial counts per task, summed by a shuffle).
   The ``VOCABULARY`` most frequent ones get numbers; the rarer words of a class have
   one number, and each has its share of it by its own count.
2. Documents become word numbers, written to the shared folder with the rarer words.
3. The network (an embedding for each place of the window, tanh, softmax over the
   classes) is trained in numpy, data-parallel: the corpus is split by hash into
   ``ROUNDS`` parts; in each round every task starts from the shared weights, goes
   once over its share of the part, and the results are averaged by weight in a tree
   of groups. So each document is learnt once and the work follows the input.
4. Every task scores its documents with the shared weights. The shares of rarer words
   come from the table of all counts, in a join on the word.

What tasks are sent is of fixed size: the numbered words and the weights. Updates
don't depend on the order of tasks, but on how files are split.

Cases: null and empty texts have no words and score 0; a word that was never counted
(in another table, say) counts as one more rare word; repeated rows score alike; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import io
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written

#: Words with numbers; words that are classes; classes by ending.
VOCABULARY, OWN, ENDINGS = 60_000, 40, 24
#: Groups of a class of words.
GROUPS = 64
#: Words with an embedding, buckets for the others, its size, words on each side.
INPUTS, BUCKETS, DIM, REACH = 2_048, 64, 16, 2
ROUNDS, BATCH, RATE = 2, 8_192, 0.1
#: Distinct words that a task holds before it passes counts on; models summed in a task.
HELD, GROUP = 500_000, 64

CLASSES, PAD = OWN + ENDINGS, INPUTS + BUCKETS


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


@functools.lru_cache(maxsize=1 << 14)
def _crc(end: str) -> int:
    return zlib.crc32(end.encode("utf-8", "replace"))


def ending(word: str) -> int:
    return _crc(word[-2:]) % ENDINGS


@dataclass
class Lexicon:
    """Numbered words, and by number (the last ``ENDINGS`` numbers are rare
    words, by ending): the input, the class, the group and the place in it, and the
    log of one occurrence's share (0 but for rare words). By class of an ending: the
    logs of the groups' shares by the counts, and in each group of the places', and
    how many places the class has."""

    number: dict[str, int]
    input: np.ndarray
    klass: np.ndarray
    group: np.ndarray
    place: np.ndarray
    share: np.ndarray
    groups: np.ndarray
    places: np.ndarray
    rooms: np.ndarray

    def numbers(self, text: str | None) -> tuple[np.ndarray, list[str]]:
        """The numbers of a text's words, and its rare words."""
        each, top, rare = words(text), len(self.number), []
        found = list(map(self.number.get, each))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            rare.append(each[at])
            found[at] = top + ending(each[at])
        return np.array(found, np.uint16), rare


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n over all documents."""
    def run(batches):
        import pyarrow as pa

        def out(c):
            return pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.string()),
                                               pa.array(list(c.values()), pa.int64())], names=["word", "n"])

        c: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                c.update(words(text.as_py()))
                if len(c) > HELD:
                    yield out(c)
                    c.clear()
        yield out(c)

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame, vocabulary: int = VOCABULARY) -> Lexicon:
    """From the counts of all words; the driver holds ``vocabulary`` of them."""
    top = [(r.word, r.n) for r in counts.orderBy(F.desc("n"), "word").limit(vocabulary).collect()]
    by_ending = F.pmod(F.crc32(F.encode(F.expr("right(word, 2)"), "utf-8")), F.lit(ENDINGS)).alias("e")
    rest = np.zeros(ENDINGS)
    for r in counts.groupBy(by_ending).agg(F.sum("n").alias("n")).collect():
        rest[r.e] = r.n
    n = len(top)
    klass = np.array([i if i < OWN else OWN + ending(w) for i, (w, _) in enumerate(top)]
                     + [OWN + e for e in range(ENDINGS)], np.int64)
    for w, c in top:
        rest[ending(w)] -= c
    # one more rare word stands for those never counted
    own = np.array([c for _, c in top] + list(rest + 1), np.float64)
    group, place = np.zeros(n + ENDINGS, np.int64), np.zeros(n + ENDINGS, np.int64)
    for e in range(ENDINGS):
        its = np.flatnonzero(klass == OWN + e)
        group[its], place[its] = np.arange(len(its)) % GROUPS, np.arange(len(its)) // GROUPS
    places = np.zeros((ENDINGS, GROUPS, int(place.max()) + 1))
    its = np.flatnonzero(klass >= OWN)
    places[klass[its] - OWN, group[its], place[its]] = own[its]
    groups = places.sum(2)
    with np.errstate(divide="ignore"):
        logs = [np.log(x).astype(np.float32) for x in (
            groups / groups.sum(1, keepdims=True), places / np.maximum(groups, 1)[:, :, None])]
    share = np.concatenate([np.zeros(n), -np.log(rest + 1)])
    inputs = np.array([i if i < INPUTS else INPUTS + _crc(w[-2:]) % BUCKETS
                       for i, (w, _) in enumerate(top)] + [INPUTS + e % BUCKETS for e in range(ENDINGS)], np.int64)
    return Lexicon({w: i for i, (w, _) in enumerate(top)}, inputs, klass, group, place, share, *logs,
                   np.array([int(place[klass == OWN + e].max()) + 1 for e in range(ENDINGS)]))


def number_documents(docs: DataFrame, lex: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (unique), doc_id, part (a hash, for the rounds), numbers (16-bit,
    compressed), rare (the words without a number)."""
    shared = docs.sparkSession.sparkContext.broadcast(lex)  # of a fixed size

    def run(batches):
        import pyarrow as pa
        lex = shared.value
        for batch in batches:
            each = [lex.numbers(t.as_py()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([zlib.compress(x.tobytes(), 1) for x, _ in each], pa.binary()),
                 pa.array([rare for _, rare in each], pa.list_(pa.string()))],
                names=["row", "doc_id", "part", "numbers", "rare"])

    text = F.col(text_col).cast("string")
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("part"), text.alias("text")) \
        .mapInArrow(run, "row long, doc_id long, part long, numbers binary, rare array<string>")


def rare_shares(numbered: DataFrame, counts: DataFrame) -> DataFrame:
    """row, log_n: the sum of the logs of the counts of a document's rare words;
    those never counted count once. Decimals, so that the order doesn't matter. A task
    holds the counts of its words and reads the documents' past them, unsorted."""
    return numbered.select("row", F.explode("rare").alias("word")).join(counts.hint("shuffle_hash"), "word") \
        .groupBy("row").agg(F.sum(F.log("n").cast("decimal(20,12)")).cast("double").alias("log_n"))


def _by_class(around: list[np.ndarray], numbers: np.ndarray, lex: Lexicon):
    """The order of words by class, and in it: the inputs around them, their numbers, their classes."""
    klass = lex.klass[numbers]
    order = np.argsort(klass.astype(np.uint16), kind="stable")
    return order, [x.take(order) for x in around], numbers.take(order), klass.take(order)


def _slopes(z: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """What the log-loss at one row of each column, a mean of ``n``, asks of the logits; in place."""
    z -= z.max(0)
    np.exp(z, out=z)
    z *= 1 / (n * z.sum(0))
    z[at, np.arange(len(at))] -= np.float32(1 / n)
    return z


def _log_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-softmax of each column at one of its rows; overwrites ``z``."""
    z -= z.max(0)
    out = z[at, np.arange(len(at))]
    np.exp(z, out=z)
    return out - np.log(z.sum(0))


def _sums(x: np.ndarray, d: np.ndarray, rows: int) -> np.ndarray:
    """The rows of ``d`` (given by columns) added up by ``x``."""
    return np.stack([np.bincount(x, c, rows) for c in d], 1).astype(np.float32)


@dataclass
class Network:
    """``embed``: a vector for each place of the window and input; ``hidden``:
    its bias; ``out``, ``bias``: the softmax over the classes; ``groups``,
    ``places``: for each class of an ending, the softmaxes over both."""

    embed: np.ndarray
    hidden: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    groups: np.ndarray
    places: np.ndarray

    @classmethod
    def start(cls, places: int, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.1, (2 * REACH, PAD + 1, DIM)).astype(np.float32), np.zeros(DIM, np.float32),
                   rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32), np.zeros(CLASSES, np.float32),
                   np.zeros((ENDINGS, GROUPS, DIM), np.float32), np.zeros((ENDINGS, places, DIM), np.float32))

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.hidden, self.out, self.bias, self.groups, self.places]

    def to_bytes(self, weight: float = 1.0) -> bytes:
        f = io.BytesIO()
        np.savez(f, *self.arrays(), weight)
        return f.getvalue()

    @staticmethod
    def from_bytes(raw: bytes) -> tuple[Network, float]:
        with np.load(io.BytesIO(raw)) as z:
            return Network(*(z[f"arr_{i}"] for i in range(6))), float(z["arr_6"])

    def _forward(self, around: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The states, and the logits over the classes. All with a column for each
        word, so that softmaxes run along words and not over a few numbers at a time."""
        a = self.hidden + self.embed[0].take(around[0], 0)
        for k in range(1, len(around)):
            a += self.embed[k].take(around[k], 0)
        a = np.ascontiguousarray(np.tanh(a, out=a).T)
        z = self.out @ a
        z += self.bias[:, None]
        return a, z

    def _endings(self, a: np.ndarray, numbers: np.ndarray, klass: np.ndarray, lex: Lexicon):
        """For each ending: its words (which are in order of class), their states, groups,
        places, and the logits over the groups and over the places of the own group."""
        cuts = np.searchsorted(klass, np.arange(OWN, CLASSES + 1))
        for e in range(ENDINGS):
            if cuts[e] < cuts[e + 1]:
                at, n = slice(cuts[e], cuts[e + 1]), lex.rooms[e]
                h, g, p = a[:, at], lex.group[numbers[at]], lex.place[numbers[at]]
                zg, zp = self.groups[e] @ h, self.places[e, :n] @ h
                zg += lex.groups[e][:, None]
                zp += lex.places[e, :, :n].T.take(g, 1)
                yield e, at, h, g, p, zg, zp

    def log_words(self, around: list[np.ndarray], numbers: np.ndarray, lex: Lexicon) -> np.ndarray:
        """log p(number | window) of each place."""
        order, around, numbers, klass = _by_class(around, numbers, lex)
        a, z = self._forward(around)
        logs = _log_at(z, klass)
        for _, at, _, g, p, zg, zp in self._endings(a, numbers, klass, lex):
            logs[at] += _log_at(zg, g) + _log_at(zp, p)
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def learner(self) -> Learner:
        # words of a group come seldom, so what they change first must not be held back
        return Learner(self, [np.full_like(a, 1e-3 if k < 4 else 1e-6) for k, a in enumerate(self.arrays())])


@dataclass
class Learner:
    net: Network
    seen: list[np.ndarray]

    def step(self, around: list[np.ndarray], numbers: np.ndarray, lex: Lexicon) -> None:
        """One Adagrad step on the mean log-loss of a batch."""
        n, net = len(numbers), self.net
        _, around, numbers, klass = _by_class(around, numbers, lex)
        a, p = net._forward(around)
        _slopes(p, klass, n)
        da = net.out.T @ p
        dg, dp = np.zeros_like(net.groups), np.zeros_like(net.places)
        for e, at, h, *rows, zg, zp in net._endings(a, numbers, klass, lex):
            for z, k, w, d in ((zg, rows[0], net.groups, dg), (zp, rows[1], net.places, dp)):
                _slopes(z, k, n)
                da[:, at] += w[e, :len(z)].T @ z
                d[e, :len(z)] = z @ h.T
        da *= 1 - a * a
        de = np.stack([_sums(x, da, PAD + 1) for x in around])
        for w, s, g in zip(net.arrays(), self.seen, (de, da.sum(1), p @ a.T, p.sum(1), dg, dp)):
            s += g * g
            w -= RATE * g / np.sqrt(s)


def _places(raw: list[bytes], lex: Lexicon) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of documents side by side, with padding between: the inputs around each
    word, the words' numbers, and the documents' lengths."""
    each = [np.frombuffer(zlib.decompress(r), np.uint16) for r in raw]
    sizes = np.array([len(x) for x in each], np.int64)
    numbers = np.concatenate([np.zeros(0, np.uint16), *each]).astype(np.int64)
    row = np.full(len(numbers) + REACH * (len(each) + 1), PAD, np.int64)
    at = np.arange(len(numbers)) + REACH * (1 + np.repeat(np.arange(len(each)), sizes))
    row[at] = lex.input[numbers]
    steps = [o for o in range(-REACH, REACH + 1) if o]
    return [row[at + o] for o in steps], numbers, sizes


def _some(column, most: int = 1 << 21):
    """Runs of compressed documents of some size together."""
    run, size = [], 0
    for x in column:
        run.append(x.as_py())
        size += len(run[-1])
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def _train_round(numbered: DataFrame, lex, net: bytes) -> DataFrame:
    """task, model: the weights after each task's share of the documents."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        own, task, seen = Network.from_bytes(net)[0], TaskContext.get().partitionId(), 0
        learner, rng = own.learner(), np.random.default_rng(task)
        for batch in batches:
            for some in _some(batch.column(0)):
                around, numbers, _ = _places(some, lex.value)
                order = rng.permutation(len(numbers))
                for at in range(0, len(order), BATCH):
                    pick = order[at:at + BATCH]
                    learner.step([x[pick] for x in around], numbers[pick], lex.value)
                seen += len(numbers)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([own.to_bytes(seen)], pa.binary())],
                                             names=["task", "model"])

    return numbered.select("numbers").mapInArrow(run, "task long, model binary")


def _average(models: DataFrame) -> bytes | None:
    """The mean weights, by the number of words learnt, in a tree of groups."""
    def merge(key, pdf):
        import pandas as pd
        total, weight = None, 0.0
        for raw in pdf.sort_values("task")["model"]:
            net, w = Network.from_bytes(raw)
            part = [a.astype(np.float64) * w for a in net.arrays()]
            total = part if total is None else [x + y for x, y in zip(total, part)]
            weight += w
        mean = Network(*[(x / weight).astype(np.float32) for x in total])
        return pd.DataFrame({"task": [int(key[0])], "model": [mean.to_bytes(weight)]})

    models = written(models, "lm-models")
    while (n := models.count()) > 1:
        models = written(models.withColumn("g", F.floor(F.col("task") / GROUP)).groupBy("g")
                         .applyInPandas(merge, "task long, model binary"), "lm-models")
    return bytes(models.first().model) if n else None


def train(numbered: DataFrame, lex: Lexicon, rounds: int = ROUNDS) -> Network:
    shared = numbered.sparkSession.sparkContext.broadcast(lex)
    net = Network.start(lex.places.shape[2]).to_bytes()
    for r in range(rounds):
        part = numbered.where(F.pmod("part", F.lit(rounds)) == r)
        net = _average(_train_round(part, shared, net)) or net
    return Network.from_bytes(net)[0]


def score_numbers(numbered: DataFrame, counts: DataFrame, lex: Lexicon, net: Network) -> DataFrame:
    """doc_id, n_words, log_prob of each numbered document. ``counts``: of all words."""
    shared = numbered.sparkSession.sparkContext.broadcast((lex, net))

    def run(batches):
        import pyarrow as pa
        lex, net = shared.value
        for batch in batches:
            totals, lengths = [], []
            for some in _some(batch.column(2)):
                around, numbers, sizes = _places(some, lex)
                logs = lex.share[numbers]
                for at in range(0, len(numbers), BATCH):
                    piece = slice(at, at + BATCH)
                    logs[piece] += net.log_words([x[piece] for x in around], numbers[piece], lex)
                sums = np.concatenate([[0.0], np.cumsum(logs)])
                ends = np.cumsum(sizes)
                totals.append(sums[ends] - sums[ends - sizes])
                lengths.append(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate([np.zeros(0, np.int64), *lengths])),
                 pa.array(np.concatenate([np.zeros(0), *totals]))], names=["row", "doc_id", "n_words", "log_prob"])

    s = numbered.select("row", "doc_id", "numbers").mapInArrow(run, "row long, doc_id long, n_words long, log_prob double")
    return s.join(rare_shares(numbered, counts), "row", "left").select(
        "doc_id", "n_words", (F.col("log_prob") + F.coalesce("log_n", F.lit(0.0))).alias("log_prob"))


def pseudo_likelihood(docs: DataFrame, vocabulary: int = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, log_prob and mean_log_prob (null without words) of each
    row of ``docs``, under a model of ``docs``."""
    counts = written(count_words(docs), "word-counts")
    lex = lexicon(counts, vocabulary)
    numbered = written(number_documents(docs, lex), "word-numbers")
    net = train(numbered, lex, rounds)
    s = score_numbers(numbered, counts, lex, net)
    return s.withColumn("mean_log_prob", F.try_divide(F.col("log_prob"), F.col("n_words")))
