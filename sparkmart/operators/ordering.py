"""Sorting and positions without a single-partition window.

``with_position`` numbers rows of a total order (1..n) the distributed way:
range-partition by the sort keys (sampled split points, so a hot key range is
spread), number rows inside each range partition, and add the row counts of
all earlier partitions. The offsets table has one row per partition, so it
is bounded by the partition count and safe to broadcast.

Range bounds are sampled at run time, so the range-partitioned rows are
materialized once (a reliable checkpoint in the shared checkpoint folder)
and both the numbering and the counts read that one copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import ensure_checkpoint_dir


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based rank of each row in ``order`` (must be total)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    s = df.repartitionByRange(n, *cols).withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    local = s.withColumn("__rn", F.row_number().over(Window.partitionBy("__pid").orderBy(*cols)))
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(
            Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = local.join(F.broadcast(offs.select("__pid", "__off")), "__pid")
    return out.withColumn(name, (F.col("__off") + F.col("__rn")).cast("bigint")) \
        .drop("__pid", "__rn", "__off")


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """Global top-k: each partition keeps its best k, then one merge
    (TakeOrderedAndProject); no full sort."""
    return df.orderBy(*order).limit(k)


def rank_within_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                       name: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """RANK() OVER (PARTITION BY group ORDER BY order) without putting a
    whole group in one task.

    Rows are range-partitioned on (group, order): equal keys always land in
    the same partition, so ties never straddle a boundary and a hot group
    is spread over several partitions. Each partition ranks its rows
    locally; the rank is then shifted by the number of rows of the same group
    in earlier partitions (a prefix sum over the small per-(partition, group)
    count table, whose partition count per group is at most the number of
    partitions).
    """
    gcols = [F.col(c) for c in group]
    ocols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(df.sparkSession)
    s = (df.repartitionByRange(n, *gcols, *ocols).withColumn("__pid", F.spark_partition_id())
         .checkpoint(eager=True))
    local = s.withColumn("__r", F.rank().over(Window.partitionBy("__pid", *group).orderBy(*ocols)))
    counts = s.groupBy("__pid", *group).agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    # null group keys are a group like any other
    to = [f"__g{i}" for i in range(len(group))]
    offs = offs.select(F.col("__pid").alias("__q"), *[F.col(c).alias(t) for c, t in zip(group, to)], "__off")
    same = F.col("__pid") == F.col("__q")
    for c, t in zip(group, to):
        same = same & F.col(c).eqNullSafe(F.col(t))
    return local.join(offs, same).withColumn(name, (F.col("__off") + F.col("__r")).cast("int")) \
        .drop("__pid", "__r", "__off", "__q", *to)
