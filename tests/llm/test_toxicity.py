import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import toxicity as T

BAD = ["idiot", "moron", "worthless", "pathetic"]


def make(n, seed=1):
    r = random.Random(0)
    vocab = ["".join(r.choices("aeiourstlnm", k=r.randint(2, 8))) for _ in range(600)]
    r = random.Random(seed)
    rows = []
    for i in range(n):
        w = r.choices(vocab, k=r.randint(8, 150))
        if bad := i % 4 == 0:
            for _ in range(max(1, len(w) // 30)):
                w[r.randrange(len(w))] = r.choice(BAD)
        rows.append((i, " ".join(w), int(bad)))
    return rows, vocab


@pytest.fixture(scope="module")
def model():
    rows, _ = make(900)
    return T.fit([t for _, t, _ in rows], [y for _, _, y in rows])


def test_held_out_accuracy_and_misspellings(model):
    s = model.scorer()
    rows, vocab = make(300, seed=2)
    hits = [(s.score(t) >= T.THRESHOLD) == bool(y) for _, t, y in rows]
    assert np.mean(hits) > 0.95
    clean = " ".join(vocab[:40])
    for word in ("idiott", "idi0t idiots", "moronn", "worthles", "patheticc"):
        assert s.score(f"{clean} {word} {clean}") > s.score(clean + " " + clean)
    assert s.score(clean * 100 + " you idiot moron worthless pathetic " + clean * 100) >= T.THRESHOLD


def test_one_word_again_and_again_is_no_evidence(model):
    s = model.scorer()
    assert s.score("the " * 500) < T.THRESHOLD and s.score("Sthe. " * 500) < T.THRESHOLD


def test_scores_without_words_are_the_prior(model):
    s = model.scorer()
    scores = {s.score(t) for t in ("", None, "123 !!", " \n")}
    assert len(scores) == 1 and 0 < scores.pop() < T.THRESHOLD


def test_pooled_evidence_keeps_clean_and_empty_texts():
    rows, vocab = make(900)
    s = T.fit_pooled([t for _, t, _ in rows], [y for _, _, y in rows]).scorer()
    held, _ = make(600, seed=2)
    got = {y: np.mean([s.score(t) >= T.THRESHOLD for _, t, z in held if z == y]) for y in (0, 1)}
    assert got[1] >= 0.9 and got[0] <= 0.01
    assert all(s.score(t) < T.THRESHOLD for t in ("", None, "123 !!", "the " * 500, " ".join(vocab) * 20))
    # insults far from each other add up
    far = " ".join(f"{' '.join(vocab[k:k + 40])} {w}" for k, w in zip(range(0, 160, 40), BAD))
    assert s.score(far) >= T.THRESHOLD


def test_stand_ins_keep_a_word_whole():
    words = lambda t: T._codes(t).tobytes().decode("utf-32-le").split()
    assert words("M0r0n st*pid b@d! 12 $x a-b 4u e\u0301a") == ["m0r0n", "st*pid", "b@d", "x", "a", "b", "u", "e\u0301a"]
    assert words("*@!") == [] and words("a1") == ["a"] and words("") == []


def test_weights_of_evidence_against_a_search():
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 2))
    y = (x @ [2.0, -1.0] + 0.5 + r.logistic(size=400) > 0).astype(int)
    w = T._weigh(x, y)

    def loss(v):
        z = x @ v[:2] + v[2]
        k = (v[:2] * x.std(0))
        return np.logaddexp(0, np.where(y, -z, z)).mean() + T.POOL_PENALTY / 2 * (k ** 2).sum()

    assert all(loss(w) <= loss(w + d) + 1e-7 for d in 0.05 * r.normal(size=(200, 3)))


def test_ids_that_repeat_are_learnt_once(spark, docs):
    one, two = [i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    many = docs([(one, f"text {k}") for k in range(300)] + [(two, "you idiot")])
    labels = spark.createDataFrame([(one, 0), (two, 1)], "doc_id long, toxic int")
    rows = [("text 0", 0), ("you idiot", 1)]
    orders = [T.fit_pooled(*map(list, zip(*r))).to_bytes() for r in (rows, rows[::-1])]
    assert T.train(many, labels).to_bytes() in orders


def test_long_texts_in_pieces_score_alike(model, monkeypatch):
    s = model.scorer()
    text = " ".join(t for _, t, _ in make(40, seed=3)[0])
    whole = s.score(text)
    monkeypatch.setattr(T, "STEP", 50)
    assert s.score(text) == pytest.approx(whole, abs=1e-9)
    assert 0 <= s.score("x" * 100_000) <= 1


def test_labels_of_one_class_or_none():
    assert T.fit(["a b"], [1]).scorer().score("c") > 0.99
    assert T.fit(["a b"], [0]).scorer().score("c") < 0.01
    assert T.fit([], []).scorer().score("c") < 0.01


def test_model_round_trip(model):
    again = T.Model.from_bytes(model.to_bytes())
    assert again.scorer().score("you moron") == model.scorer().score("you moron")


def test_query_never_learns_held_out_labels(spark, docs):
    rows, _ = make(240)
    d = docs([(i, t) for i, t, _ in rows] + [(1000, None), (1001, ""), (5, "again"), (None, "x")]) \
        .withColumn("toxic", F.lit("clash"))
    out = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    true = spark.createDataFrame([(i, 0, y) for i, _, y in rows] + [(1000, 1, None)],
                                 "doc_id long, quality int, toxic int")
    flipped = spark.createDataFrame([(i, 0, 1 - y if out(i) else y) for i, _, y in rows],
                                    "doc_id long, quality int, toxic int")
    a, b = (sorted((tuple(r) for r in T.toxicity(d, x).collect()), key=str) for x in (true, flipped))
    assert a == b and len(a) == 244
    assert all(h == (i is not None and out(i)) and p == int(s >= 0.7) and 0 <= s <= 1 for i, h, s, p in a)
    assert T.toxicity(docs([]), true).collect() == []
