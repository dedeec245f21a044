"""Join operators for the star.

Broadcast policy: no dimension is forced to broadcast (stores come from user
files and have no bound). The planner broadcasts only under
``spark.sql.autoBroadcastJoinThreshold`` from (runtime, with AQE) statistics
and otherwise shuffles (sort-merge), so the same plan holds at any scale.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_bounded(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join to a side that is small as a rule. Sizes known from files or, with
    AQE, at run time decide on a broadcast; nothing is forced."""
    return big.join(small, on, how)


def join_dim(df: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join to a dimension whose size grows with the data: planner's choice."""
    return df.join(dim, on, how)


def attach(df: DataFrame, dim: DataFrame, key: str | Sequence[str],
           cols: Sequence[str], bounded: bool = False) -> DataFrame:
    """Attach descriptive columns of a dimension after reduction.

    Reports aggregate on integer keys and only then look names up, so the big
    side of the join is the (already small) aggregate, not the fact.
    """
    keys = [key] if isinstance(key, str) else list(key)
    d = dim.select(*keys, *cols)
    return join_bounded(df, d, keys) if bounded else join_dim(df, d, keys)


def semi_filter(df: DataFrame, ref: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``df`` whose key exists in ``ref`` (FK check, EXISTS).
    A left-semi join emits each left row at most once, whatever the
    multiplicity of the key on the right."""
    return df.join(ref.select(F.col(right_key).alias(left_key)), left_key, "left_semi")


def anti_filter(df: DataFrame, ref: DataFrame, left_key: str, right_key: str,
                key_type: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``ref`` (NOT EXISTS).

    ``key_type`` casts both keys to one type (INT order id vs VARCHAR fact id).
    """
    lk, rk = F.col(left_key), F.col(right_key)
    if key_type:
        lk, rk = lk.cast(key_type), rk.cast(key_type)
    r = ref.select(rk.alias("__k"))
    return df.join(r, lk == F.col("__k"), "left_anti")
