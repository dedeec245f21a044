import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import exact_dedup as X

ROWS = [(1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, "a "), (7, "x" * 200_000), (8, "x" * 200_000),
        (9, "y"), (9, "y"), (None, "z"), (None, "w"), (10, "w"), (11, "é"), (12, "é")]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity,bits", [(100_000, 64), (1, 64), (3, 2), (100_000, 1)])
def test_matches_brute_force_even_when_keys_collide(docs, capacity, bits):
    got = X.exact_duplicates(docs(ROWS), capacity=capacity, key_bits=bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)


def test_buckets_fit_and_cover_disjoint_key_ranges(spark):
    d = spark.range(2_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    index = X.build_index(d, capacity=100)
    rows = index.directory.collect()
    assert len(rows) <= 2 ** index.depth and sum({r.bucket: r["keys"] for r in rows}.values()) == 2_000
    assert all(r["keys"] <= 100 for r in rows)
    for r in rows:  # a bucket is the cells that share its first local_depth bits
        assert r.prefix >> (index.depth - r.local_depth) == r.bucket >> (index.depth - r.local_depth)
    assert index.entries.count() == 2_000


def test_drop_duplicates_keeps_columns_that_clash(docs):
    d = docs(ROWS).withColumn("key", F.lit("k")).withColumn("kept", F.lit(5)).withColumn("group_size", F.lit("g"))
    got = X.drop_duplicates(d)
    assert got.columns == d.columns
    rows = got.collect()
    assert {r.key for r in rows} == {"k"} and {r.kept for r in rows} == {5}
    assert sorted((r.doc_id or -1) for r in rows) == sorted([2, 3, 5, 6, 8, 9, 9, -1, 10, 11, 12])


def test_hot_text_and_empty_table(spark, docs):
    d = spark.range(3_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same")
                                  .otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = {r.doc_id: r for r in X.exact_duplicates(d, capacity=64).collect()}
    assert got[0].group_size == 1_000 and got[0].keep_id == 2_997 and got[2_997].kept and got[1].kept
    assert X.exact_duplicates(docs([])).collect() == []
