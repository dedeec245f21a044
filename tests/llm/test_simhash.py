import random
import re

import pytest
import xxhash

from sparkmart.llm import simhash as S
from sparkmart.llm.components import components


def brute_fp(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, d=3):
    fps = [brute_fp(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= d:
                label[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, f"{fps[k]:016x}", least.get(root(k))) for k, (i, _) in enumerate(rows)), key=str)


def make(n, seed=4):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [r.choices(words, k=60) for _ in range(6)]
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((i + 10, " ".join(w)))
    return rows + [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one two"), (6, "ONE two"), (7, "a b c " * 5_000),
                   (8, "a b c " * 5_000), (8, "a b c " * 5_000), (None, "one"), (None, "É é É")]


@pytest.mark.parametrize("blocks,tile", [(6, 512), (5, 512), (6, 4)])
def test_components_match_brute_force(docs, blocks, tile):
    rows = make(150)
    got = sorted((tuple(r) for r in S.near_duplicates(docs(rows), blocks=blocks, tile=tile).collect()), key=str)
    assert got == brute(rows)


def test_every_close_pair_shares_a_choice_of_blocks():
    r = random.Random(1)
    for blocks in (5, 6, 7):
        masks = S._masks(blocks, 3)
        for _ in range(500):
            x = sum(1 << b for b in r.sample(range(64), 3))
            assert any(x & m % (1 << 64) == 0 for m in masks)


def test_one_of_each_and_empty_table(docs):
    rows = make(40)
    d = docs(rows)
    kept = S.one_of_each(d)
    assert kept.columns == d.columns
    want = sorted({c for i, _, c in brute(rows) if c is not None})
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == want
    assert S.near_duplicates(docs([])).collect() == [] and S.one_of_each(docs([])).collect() == []


def test_components_of_chains_stars_and_self_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (500, 500), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {500: 500}
