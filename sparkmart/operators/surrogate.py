"""``sale_id``: a surrogate key of the fact that is the same on every run.

The id is made of the month, 40 bits of a hash of the row's content, and the row's
place in the chain of rows of that month that share the hash:

    sale_id = (month number * 2**40 + hash) * 2**8 + chain

No counter is shared between tasks or runs. Rows with one month and hash are
ordered by content, so a rebuild gives every row its id again, and a load finds
the chains it extends in the months of its own rows. With 10**10 rows a month a
chain of more than a few rows is as good as impossible; one that outgrew its 256
places would stop the load instead of giving an id twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN = 1 << 8    # places of a chain
HASHES = 1 << 40  # hashes of a month

#: What the hash is taken over, in this order.
CONTENT = ("order_id", "line_number", "order_date", "product_id", "customer_id", "quantity")


def sale_base(content: tuple[str, ...] = CONTENT, date: str = "order_date", hashes: int = HASHES) -> Column:
    """The id of a row at the head of its chain."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in content]))
    hashed = F.conv(F.substring(digest, 1, 10), 16, 10).cast("long") % hashes
    month = (F.year(date) * 12 + F.month(date)).cast("long")
    return (month * HASHES + hashed) * CHAIN


def chained(base: Column | str, place: Column) -> Column:
    """The id at a place (0, 1, ...) of the chain that starts at ``base``."""
    full = F.raise_error(F.lit("a chain of sale ids is full")).cast("long")
    return F.when(place < CHAIN, (F.col(base) if isinstance(base, str) else base) + place).otherwise(full)


def apart(*columns: str) -> Column:
    """What stands for the base of a row without one: below all bases, and spread by
    ``columns``, so that such rows are dealt to all tasks and match no chain."""
    return -1 - F.abs(F.xxhash64(*columns) % (1 << 62))


def with_sale_id(fact: DataFrame, content: tuple[str, ...] = CONTENT, date: str = "order_date",
                 hashes: int = HASHES) -> DataFrame:
    """``fact`` with its ``sale_id``. Rows of equal content are as many rows of one
    chain; a row without a date has no id."""
    undated = F.when(F.col("__base").isNull(), F.xxhash64(*content))  # spread over many tasks
    w = Window.partitionBy("__base", undated).orderBy(*content)
    return fact.withColumn("__base", sale_base(content, date, hashes)) \
        .withColumn("sale_id", F.when(F.col("__base").isNotNull(), chained("__base", F.row_number().over(w) - 1))) \
        .drop("__base")
