"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``label`` for every node of ``links``; the label is the smallest
    node that can be reached.

    Alternating stars: each round hangs a node's larger neighbours, then its
    smaller ones, on the smallest of them, until every component is one star.
    Smallest neighbours are pre-aggregated and joined back, so a node with very
    many links is split by the skew join. A self link gives a component of one;
    links with a null end are ignored; no link, no row.
    """
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    alone = ends.where(F.col(a) == F.col(b)).select(F.col(a).alias("node")).distinct()
    edges = written(ends.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before, now = None, _mark(edges)
    while now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "small-star")
        before, now = now, _mark(edges)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node")).distinct()
    roots = roots.unionByName(alone.join(edges.select(F.col("u").alias("node")), "node", "left_anti")).distinct()
    return stars.unionByName(roots.select("node", F.col("node").alias("label")))
