"""Masked pseudo-likelihood: every row scored, empty and repeated texts, empty tables."""

import math
import zlib

import pytest

from sparkmart.llm import masked_lm as M
from sparkmart.llm.masked_lm import pseudo_likelihood

SCHEMA = "doc_id long, text string, part string"


def test_every_row_is_scored(spark):
    texts = ["the cat sat on the mat " * 20, "the cat sat on the mat " * 20, "", None, "zxq", "one two  three\nfour"]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in pseudo_likelihood(docs).collect()}
    assert [got[k].n_words for k in range(6)] == [120, 120, 0, 0, 1, 4]
    assert got[0].log_prob == got[1].log_prob < 0
    assert got[2].log_prob == got[3].log_prob == 0 and got[2].mean_log_prob is None
    assert got[0].mean_log_prob > got[4].mean_log_prob


def test_empty(spark):
    assert pseudo_likelihood(spark.createDataFrame([], SCHEMA)).count() == 0


def scored(spark, texts, asked, vocabulary):
    """{text: log_prob} of ``asked`` under a model of ``texts``; the counts and the lexicon."""
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], SCHEMA)
    counts = M.written(M.count_words(docs), "word-counts")
    lex = M.lexicon(counts, vocabulary)
    net = M.train(M.written(M.number_documents(docs, lex), "word-numbers"), lex)
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(asked)], SCHEMA)
    got = M.score_numbers(M.written(M.number_documents(rows, lex), "word-numbers"), counts, lex, net).collect()
    return {asked[r.doc_id]: r.log_prob for r in got}, {r.word: r.n for r in counts.collect()}, lex


FREQUENT = " ".join(f"f{i}" for i in range(45))


def test_window_tells_words_of_one_ending_apart(spark):
    # after the 40th word, of one ending and equally frequent
    texts = [f"{FREQUENT} alpha qqing {FREQUENT} beta zzing {FREQUENT}"] * 40
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], SCHEMA)
    lex = M.lexicon(M.count_words(docs))
    raw = lambda t: zlib.compress(lex.numbers(t)[0].tobytes(), 1)
    around, numbers, _ = M._places([raw(t) for t in texts], lex)
    learner = M.Network.start(lex.places.shape[2]).learner()
    for _ in range(200):
        learner.step(around, numbers, lex)

    def log_prob(text):
        a, n, _ = M._places([raw(f"f43 f44 {text} f0 f1")], lex)
        return learner.net.log_words(a, n, lex)[3]

    assert lex.klass[lex.number["qqing"]] == lex.klass[lex.number["zzing"]] >= M.OWN
    assert log_prob("alpha qqing") > log_prob("alpha zzing") + 0.5
    assert log_prob("beta zzing") > log_prob("beta qqing") + 0.5


def test_words_without_a_number_have_their_own_counts(spark):
    texts = [FREQUENT] * 40 + ["aaing"] * 30 + ["bbing"] + [f"r{i}" for i in range(300)]
    every = sorted({w for t in texts for w in t.split()})
    got, counts, lex = scored(spark, texts, [*every, "ccing"], 45)
    assert "aaing" not in lex.number and counts["aaing"] == 30
    assert got["aaing"] - got["bbing"] == pytest.approx(math.log(30), abs=1e-5)
    assert got["ccing"] == pytest.approx(got["bbing"], abs=1e-5)
    # one more word of each ending stands for those never counted
    unseen = {M.ending(w): math.exp(got[w]) / counts[w] for w in every if w not in lex.number}
    assert len(unseen) <= M.ENDINGS and sum(math.exp(got[w]) for w in every) + sum(unseen.values()) <= 1 + 1e-5


def test_only_the_places_of_a_class_are_worked_out(spark):
    import numpy as np
    texts = [" ".join(f"{a}{b}ing w{a}ed" for a in "abcdefghij" for b in "klmnopqrstuvw") + " " + FREQUENT] * 3
    lex = M.lexicon(M.count_words(spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], SCHEMA)))
    net = M.Network.start(lex.places.shape[2])
    around, numbers, _ = M._places([zlib.compress(lex.numbers(t)[0].tobytes(), 1) for t in texts], lex)
    for _ in range(5):
        learner = net.learner()
        learner.step(around, numbers, lex)
    _, inputs, sorted_numbers, klass = M._by_class(around, numbers, lex)
    a, _ = net._forward(inputs)
    of = {e: zp.shape for e, _, _, _, _, _, zp in net._endings(a, sorted_numbers, klass, lex)}
    assert all(n == lex.rooms[e] for e, (n, _) in of.items()) and len({n for n, _ in of.values()}) > 1
    # against softmaxes over all places, word by word
    log = lambda z, k: z[k] - np.log(np.exp(z - z[np.isfinite(z)].max()).sum()) - z[np.isfinite(z)].max()
    got = net.log_words(around, numbers, lex)
    for i, n in enumerate(numbers):
        h = np.tanh(net.hidden + sum(net.embed[k][x[i]] for k, x in enumerate(around)))
        want, e = log(net.out @ h + net.bias, lex.klass[n]), lex.klass[n] - M.OWN
        if e >= 0:
            want += log(net.groups[e] @ h + lex.groups[e], lex.group[n])
            want += log(net.places[e] @ h + lex.places[e][lex.group[n]], lex.place[n])
        assert got[i] == pytest.approx(want, abs=1e-4)
