"""The Jaccard join against all pairs of shingle sets of strings."""

import random
import re

import pyarrow.parquet as pq
import pytest

from sparkmart.llm import jaccard_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _plain(rows):
    """Rows expected, by union-find over all pairs of sets that share a shingle."""
    sets = [_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders: dict[str, list[int]] = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(i, j) for h in holders.values() for j in h for i in h if i < j}
    for i, j in pairs:
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def _got(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, df.collect()))


def _family(rng, size, words, edits):
    """Copies of one text with ``edits`` words changed, so that similarities lie
    on both sides of the threshold."""
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    for _ in range(size):
        t = list(base)
        for _ in range(rng.randint(0, edits)):
            t[rng.randrange(len(t))] = f"e{rng.randint(0, 10 ** 6)}"
        yield " ".join(t[:len(t) - rng.randint(0, words // 10)])


def test_table_against_all_pairs(docs):
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    assert _got(jaccard_groups.linked(docs(rows))) == _plain(rows)


@pytest.mark.parametrize("tile", [2, 32])
def test_families_around_the_threshold(docs, monkeypatch, tile):
    """Many near copies, texts that share a common passage, and chains."""
    monkeypatch.setattr(jaccard_groups, "TILE", tile)
    rng = random.Random(tile)
    texts = []
    for size, words, edits in ((60, 80, 6), (25, 40, 3), (25, 200, 9), (15, 12, 1), (10, 6, 1), (10, 5, 1)):
        texts += _family(rng, size, words, edits)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randint(0, 999)}" for _ in range(k)) for k in range(0, 40, 2)]
    chain = [f"c{i}" for i in range(60)]
    texts += [" ".join(chain[k:k + 40]) for k in range(0, 20, 2)]
    rng.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    plain = _plain(rows)
    assert 10 < len({c for _, _, c in plain}) < len(rows) - 50
    assert _got(jaccard_groups.linked(docs(rows))) == plain


def test_links_that_the_min_hashes_miss_are_found(docs, monkeypatch):
    """Without any star the matrix alone finds every link."""
    monkeypatch.setattr(jaccard_groups, "_min_hashes", lambda tokens: [int(tokens.sum())])
    rng = random.Random(9)
    rows = list(enumerate([*_family(rng, 30, 50, 4), *_family(rng, 20, 30, 2)]))
    assert _got(jaccard_groups.linked(docs(rows))) == _plain(rows)


def test_few_shared_ids_are_joined_by_a_shuffle_too(docs, monkeypatch):
    monkeypatch.setattr(jaccard_groups, "BROADCAST", 0)
    rng = random.Random(2)
    rows = list(enumerate(_family(rng, 20, 40, 3)))
    assert _got(jaccard_groups.linked(docs(rows))) == _plain(rows)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  TWO\n"), (6, "one two three"),
            (7, "É one two"), (8, "é one two"), (9, "a b c d e"), (10, "a b c d e"), (11, "x " * 30_000),
            (12, "x " * 31_000), (13, " one two"), (14, "a b c d"), (15, "a b c d e f")]
    assert _got(jaccard_groups.linked(docs(rows))) == _plain(rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark, docs):
    text = "some words that come more than once here"
    rows = [(5, text), (5, text), (None, text), (None, "only here and without an id at all"), (2, text + " too")]
    got = sorted(map(tuple, jaccard_groups.linked(docs(rows)).collect()), key=repr)
    assert got == sorted([(5, 4, 2), (5, 4, 2), (None, 4, 2), (None, 4, None), (2, 5, 2)], key=repr)
    clash = spark.createDataFrame([(5, text, 1, "x", 2, [1])],
                                  "doc_id long, text string, n int, label string, gid int, tokens array<int>")
    assert _got(jaccard_groups.linked(clash)) == [(5, 4, 5)]
    assert jaccard_groups.linked(docs([])).collect() == []


def test_first_shingles_are_dealt_once_and_sets_that_share_enough_stay(spark, docs):
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base), " ".join(base[:-1] + ["end"]), " ".join(base), " ".join(f"x{k}" for k in range(60)), None]
    each = jaccard_groups._each(docs(list(enumerate(texts))).select("doc_id", "text"), 5, 80)
    rows = each.collect()
    may = jaccard_groups._may_link(jaccard_groups.written(each, "each"))
    assert {r.hi for r in may.collect()} == {rows[0].hi, rows[1].hi}
    plan = may._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("hashpartitioning(token") == 1


def test_sets_are_shuffled_by_group_and_not_for_each_pair(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_groups, "BROADCAST", 0)
    rng, J = random.Random(5), jaccard_groups
    rows = list(enumerate([*_family(rng, 30, 50, 4), *_family(rng, 20, 30, 2)]))
    sets = J.written(J._sets(docs(rows).select("doc_id", "text"), 5), "sets")
    sketch = spark.sparkContext.broadcast(J._sketch(sets))
    stars = J.written(J._stars(sets, sketch, 80), "stars").limit(0)  # the matrix finds them all
    members = J.written(J._grouped(sets, J.components(stars)), "members")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = J._found(members, sketch, 80)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(gid" in plan
        assert "hashpartitioning(a#" not in plan and "hashpartitioning(b#" not in plan
        plan = J._held(members, sketch, 80)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(token") == 1
        links = {frozenset(r) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    lists = [_set(t) for _, t in rows]
    want = {frozenset((i, j)) for i in range(len(rows)) for j in range(i)
            if 100 * len(lists[i] & lists[j]) >= 80 * len(lists[i] | lists[j])}
    assert links and links <= want
