"""First-wins de-duplication on a key (INSERT IGNORE semantics).

The winner per key is the row with the smallest ordinal. It is found with
``min`` over a struct (ordinal first, payload after): an aggregate with
map-side partial combine, so a key that holds a third of all rows is reduced
on every mapper before the shuffle, and nothing is collected per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_first_wins(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """Keep, per ``keys``, the row with the smallest ``ordinal`` tuple.

    With a file as input, ``ordinal`` is its read position (for example
    ``_metadata.file_path`` and ``_metadata.row_index`` captured right after the
    scan); ties on the ordinal are broken by the remaining columns.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys and c not in ordinal]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(ordinal)],
                      *[F.col(c) for c in payload])
    best = df.groupBy(*keys).agg(F.min(packed).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.__o{i}").alias(c) for i, c in enumerate(ordinal)],
                       *[F.col(f"__best.{c}").alias(c) for c in payload]).select(*df.columns)


def with_file_ordinal(df: DataFrame) -> DataFrame:
    """Capture the read position right after a file scan, before any shuffle.

    (file, split start, id within the split) orders rows as they stand in
    their files for every file format: ids grow with the read order inside a
    split, and splits of one file are ordered by their start offset.
    """
    return (df.withColumn("_file", F.col("_metadata.file_path"))
            .withColumn("_block", F.col("_metadata.file_block_start"))
            .withColumn("_row", F.monotonically_increasing_id()))


FILE_ORDINAL = ["_file", "_block", "_row"]
