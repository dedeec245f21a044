"""URL verdicts: rules, subdomains, trust over links, nulls, empty tables."""

import numpy as np

from sparkmart.llm.link_trust import spread, verdicts
from sparkmart.llm.queries import RULES

SCHEMA = "page_id long, url string, html string, host string"


def test_rules_and_trust(spark):
    pages = spark.createDataFrame([
        (1, "http://a.org/x", '<a href="http://b.net/">b</a>', "clash"),
        (2, "https://Example.org/es/q?z", '<a href="http://good.net/">g</a>', None),
        (3, "http://b.net/p?x", "", None),
        (4, None, None, None),
        (5, "no scheme", "", None),
        (6, "http://Sub.com/fr/z#f", "", None),
        (7, "http://com/de/y", "", None),
        (8, "http://bad.net/", '<a href="https://example.org/">e</a>', None),
        (3, "http://b.net/p?x", "", None)], SCHEMA)
    got = sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in verdicts(pages, RULES).collect())
    assert got == [
        (1, "a.org", "/x", "org/", "allow"), (2, "example.org", "/es/q", "example.org/es/", "block"),
        (3, "b.net", "/p", "", "allow"), (3, "b.net", "/p", "", "allow"), (4, "", "", "", "allow"),
        (5, "", "", "", "allow"), (6, "sub.com", "/fr/z", "com/fr/", "allow"),
        (7, "com", "/de/y", "com/de/", "block"), (8, "bad.net", "/", "", "block")]


def test_empty(spark):
    assert verdicts(spark.createDataFrame([], SCHEMA), RULES).count() == 0


def test_ranks_against_a_dense_power_iteration(spark):
    r = np.random.default_rng(3)
    n = 12
    w = np.where(r.random((n, n)) < 0.25, r.integers(1, 4, (n, n)), 0).astype(float)
    w[3] = w[:, 7] = 0
    seeds = [("trust", 0, 3.0), ("trust", 1, 1.0), ("distrust", 2, 2.0)]
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", float(w[i, j])) for i in range(n) for j in range(n) if w[i, j]],
                                  "src string, dst string, w double")
    got = {x.host: (x.trust, x.distrust) for x in spread(edges, spark.createDataFrame(
        [(k, f"h{i}", m) for k, i, m in seeds], "walk string, host string, n double"), tolerance=1e-3).collect()}
    for side, (walk, m) in enumerate([("trust", w), ("distrust", w.T)]):
        s = np.zeros(n)
        for k, i, c in seeds:
            s[i] += c * (k == walk)
        s /= s.sum()
        p = m / np.maximum(m.sum(1, keepdims=True), 1)
        rank = s.copy()
        for _ in range(400):
            rank = 0.15 * s + 0.85 * rank @ p
        assert np.allclose([got.get(f"h{i}", (0, 0))[side] for i in range(n)], rank, atol=1e-3)


def test_a_long_chain_to_a_blocked_host_is_blocked_all_along(spark):
    chain = [(k, f"http://c{k}.net/", f'<a href="http://c{k + 1}.net/">' if k < 30 else
              '<a href="http://example.org/">', None) for k in range(31)]
    rows = spark.createDataFrame([*chain, (99, "http://example.org/es/" + "x" * 100_000, "y" * 200_000, None)], SCHEMA)
    got = {x.page_id: x.verdict for x in verdicts(rows, [("block", "example.org/es/")]).collect()}
    assert set(got.values()) == {"block"} and len(got) == 32


def test_rules_of_one_length_tie_towards_block(spark):
    rows = spark.createDataFrame([(1, "http://a.bc/", "", None), (2, "ftp://x.a.bc/y", "", None)], SCHEMA)
    got = [(x.rule, x.verdict) for x in verdicts(rows, [("allow", "a.bc/"), ("block", "a.bc/"), ("allow", "bc/")]).collect()]
    assert got == [("a.bc/", "block")] * 2


def test_rounds_over_few_edges_have_few_tasks(spark, monkeypatch):
    """Each task of a round leaves files, in each of some hundred rounds."""
    from sparkmart.llm import link_trust
    seen, plain = [], link_trust.written

    def written(df, name):
        if name == "ranks":
            seen.append(df.rdd.getNumPartitions())
        return plain(df, name)

    monkeypatch.setattr(link_trust, "written", written)
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0)], "src string, dst string, w double")
    seeds = spark.createDataFrame([("trust", "a", 1.0)], "walk string, host string, n double")
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {r.host: r.trust for r in link_trust.spread(edges, seeds, tolerance=0.5).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert seen and max(seen) <= link_trust.LEAST_TASKS
    assert got["a"] > got["b"] > got["c"] > 0
