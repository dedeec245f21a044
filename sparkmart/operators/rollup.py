"""Rollups with a distinct count, without expanding the rows.

``GROUP BY ROLLUP`` with ``COUNT(DISTINCT x)`` makes a copy of every row for each
level. Here the rows are reduced once to (keys, x), and each level is reduced from
the one below it: dropping the last key leaves (fewer keys, x), still without
repeats, so the distinct count of a level is a plain count of its rows. Every
step is an aggregate with map-side combine over ever fewer rows; Spark reuses the
exchange of a step for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_distinct(rows: DataFrame, keys: list[str], distinct: str, measure: str) -> DataFrame:
    """For each level of ``ROLLUP (keys)``: the keys (null where rolled up), level
    (how many keys are kept), total (the sum of ``measure``), n (distinct values
    of ``distinct``, nulls not counted). No rows, no level."""
    out = None
    fine = rows.select(*keys, distinct, F.col(measure).alias("total"))
    types = dict(rows.select(*keys).dtypes)
    for level in range(len(keys), -1, -1):
        kept = keys[:level]
        fine = fine.groupBy(*kept, distinct).agg(F.sum("total").alias("total"))
        sums = fine.groupBy(*kept).agg(F.sum("total").alias("total"), F.count(distinct).alias("n"),
                                       F.count("*").alias("rows")).filter("rows > 0")
        sums = sums.select(*kept, *[F.lit(None).cast(types[k]).alias(k) for k in keys[level:]],
                           F.lit(level).alias("level"), F.col("total").cast("decimal(38,2)").alias("total"), "n")
        out = sums if out is None else out.unionByName(sums)
    return out
