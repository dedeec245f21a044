import random
import re

import pytest

from sparkmart.llm import decontaminate as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def brute(docs, items):
    win = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            win.setdefault(tuple(w[k:k + 13]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, its = words(t), set(), set()
        for n in {len(k) for k in win}:
            for k in range(len(w) - n + 1):
                if found := win.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    its |= {str(x) for x in found if x is not None}
        out.append((i, len(w), len(hit), len(its), sorted(its), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def make():
    r = random.Random(2)
    vocab = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "été", "x9"]
    text = lambda n: " ".join(r.choices(vocab, k=n))
    items = [(i, text(r.choice([13, 20, 40]))) for i in range(12)]
    items += [(20, "short ITEM"), (21, "solo"), (22, ""), (23, None), (24, "..."), (25, items[0][1]), (None, text(15)),
              (0, text(14)), (26, "the of " * 10)]
    docs = [(i, text(r.randint(0, 200))) for i in range(30)]
    for i in range(30, 70):
        w = words(r.choice(items)[1])
        a = r.randint(0, max(0, len(w) - 13))
        docs.append((i, text(r.randint(0, 60)) + " ,. " + ", ".join(w[a:a + r.randint(10, 40)]).upper() + "! " + text(30)))
    docs += [(80, None), (81, ""), (82, "?!"), (83, "...Solo."), (84, "short item"), (85, "short. iTem " * 9),
             (86, "x"), (86, items[3][1]), (87, items[3][1]), (87, items[3][1]), (None, items[4][1]),
             (88, "the of " * 3_000), (89, text(20_000) + " " + items[5][1])]
    return docs, items


@pytest.mark.parametrize("block,shingle", [(50_000, 3), (60, 3), (50_000, 1)])
def test_matches_brute_force(spark, docs, block, shingle):
    d, i = make()
    items = spark.createDataFrame(i, "item_id long, text string")
    got = D.contamination(docs(d), items, block=block, shingle=shingle).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in got), key=str)
    assert got == brute(d, i)


def test_empty_tables_and_filter(spark, docs):
    d, i = make()
    items = spark.createDataFrame(i, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(docs([]), items).collect() == []
    assert {(r.n_hit, r.contaminated) for r in D.contamination(docs(d), none).collect()} == {(0, False)}
    kept = D.drop_contaminated(docs(d), items)
    assert kept.columns == docs(d).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((x[0] or -1) for x in brute(d, i) if not x[5])


@pytest.mark.parametrize("sign", ["\x80", "\x85", "\xa0", "\xad", "\u200b", "\u2028", "\ufeff", "\U000e0001", "😀"])
def test_signs_in_words(spark, docs, sign):
    long = " ".join(f"w{i}" + sign * (i == 7) + "x" for i in range(13))
    i = [(1, long), (2, f"a{sign}b c"), (3, sign)]
    d = [(1, "before " + long + " after"), (2, f"A{sign}B. c"), (3, f"d {sign} e"), (4, "xa0 xad x80 x85"), (5, "a b c")]
    items = spark.createDataFrame(i, "item_id long, text string")
    got = D.contamination(docs(d), items).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in got), key=str)
    assert got == brute(d, i) and [x[5] for x in got] == [True, True, True, False, False]
