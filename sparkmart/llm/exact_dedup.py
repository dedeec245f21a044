"""Exact deduplication by an extendible-hash index on shared files.

Each text has a 64-bit hash key. The directory maps the top ``depth`` bits of a
key to a bucket; a bucket with more than ``capacity`` distinct keys is split by
one more bit, and the directory doubles until every bucket fits. The index is a
table on the shared folder, dealt out by bucket, so one owner task writes each
contiguous key range. A key that stands for several texts holds a chain of
entries, one for each text, told apart by comparing the texts' bytes.

Everything is DataFrame code. Copies are combined before the shuffle, so a text
that makes up a third of the input reaches its owner as one row for each map
task; the look-up is an ordinary equi-join, whose hot keys Spark splits.

Cases: a null text counts as the empty text; an empty text is a text like any
other; rows with the same doc_id and text are equal and share their result (all
of them are kept if any is); a null doc_id is never the largest unless all of
the group are null; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import filled, written

#: Distinct keys in a bucket of the index.
CAPACITY = 100_000
#: Bits of a key. Fewer only make collisions likelier (used in tests).
KEY_BITS = 64


@dataclass(frozen=True)
class Index:
    """``entries``: bucket, key, chain, chains, keep_id, group_size, text_sha256;
    ``directory``: prefix, bucket, local_depth, keys; ``depth``: global depth."""

    entries: DataFrame
    directory: DataFrame
    depth: int
    key_bits: int
    collisions: int


def _key(text: Column, key_bits: int) -> Column:
    h = F.xxhash64(text)
    # the top bits carry the directory, so a shorter key clears the low ones
    return h if key_bits >= 64 else F.shiftleft(F.shiftright(h, 64 - key_bits), 64 - key_bits)


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def build_directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Directory of ``keys`` (one row for each distinct key): the rows and the
    global depth. Cells of the deepest level that may be needed are counted
    once; every level above is the sum of its cells."""
    total = keys.count()
    # uniform keys fill a bucket at log2(total / capacity); three levels of room
    deepest = max(0, total // max(capacity, 1)).bit_length() + (3 if total > capacity else 0)
    deepest = min(deepest, 62)
    cells = keys.groupBy(_prefix(F.col("key"), deepest).alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("level")) \
        .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {deepest} - level)"))
    sums = levels.groupBy("level", "prefix").agg(F.sum("n").alias("keys"))
    # a cell belongs to the shallowest bucket that is not overfull
    fits = levels.join(sums, ["level", "prefix"]) \
        .where((F.col("keys") <= capacity) | (F.col("level") == deepest)) \
        .groupBy("cell").agg(F.min_by(F.struct("level", "prefix", "keys"), "level").alias("b"))
    directory = fits.select(
        F.col("cell").alias("prefix"),
        F.expr(f"shiftleft(b.prefix, {deepest} - b.level)").alias("bucket"),
        F.col("b.level").alias("local_depth"), F.col("b.keys").alias("keys"))
    return written(directory, "dedup-directory"), deepest


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> Index:
    rows = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    # equality on the text compares its bytes; the key only says where to look
    texts = rows.groupBy(_key(F.col("text"), key_bits).alias("key"), "text") \
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    found = written(texts.select("key", "keep_id", "group_size",
                                 F.sha2(F.col("text"), 256).alias("text_sha256")), "dedup-texts")
    directory, depth = build_directory(found.select("key").distinct(), capacity)
    chain = Window.partitionBy("key")
    entries = found \
        .withColumn("chain", F.row_number().over(chain.orderBy("keep_id", "text_sha256")) - 1) \
        .withColumn("chains", F.count("*").over(chain)) \
        .withColumn("prefix", _prefix(F.col("key"), depth)) \
        .join(directory.select("prefix", "bucket"), "prefix") \
        .select("bucket", "key", "chain", "chains", "keep_id", "group_size", "text_sha256")
    entries = written(entries.repartition("bucket").sortWithinPartitions("bucket", "key", "chain"),
                      "dedup-index")
    collisions = entries.where("chains > 1").count()
    return Index(entries, directory, depth, key_bits, collisions)


def look_up(docs: DataFrame, index: Index, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``docs`` with key, keep_id, group_size, kept and text_sha256."""
    own = ["keep_id", "group_size", "kept", "text_sha256"]
    d = docs.drop(*own, "key").withColumn("key", _key(filled(text_col), index.key_bits))
    e = index.entries.select("key", "chain", "chains", *[c for c in own if c != "kept"])
    if not index.collisions:
        out = d.join(e.drop("chain", "chains"), "key")
    else:
        # in a chain the text decides; elsewhere one entry holds every row of the key
        longer = e.where("chains > 1").withColumnRenamed("text_sha256", "entry_sha256")
        texts = d.select("key", filled(text_col).alias("_t")).join(
            longer.select("key").distinct(), "key", "left_semi").distinct()
        numbered = texts.withColumn("entry_sha256", F.sha2("_t", 256)).join(
            longer, ["key", "entry_sha256"])
        chained = d.withColumn("_t", filled(text_col)).join(
            numbered.withColumnRenamed("entry_sha256", "text_sha256").drop("chain", "chains"),
            ["key", "_t"]).drop("_t")
        single = d.join(e.where("chains = 1").drop("chain", "chains"), "key")
        out = single.unionByName(chained.select(*single.columns))
    kept = F.col(id_col).eqNullSafe(F.col("keep_id"))
    return out.withColumn("kept", kept).select(*d.columns, *own)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, id_col, text_col, capacity, key_bits)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return look_up(d, index).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_duplicates(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    index = build_index(docs, capacity=capacity)
    own = ["keep_id", "group_size", "kept", "text_sha256"]
    held = {c: f"_held_{c}" for c in [*own, "key"] if c in docs.columns}
    back = {v: k for k, v in held.items()}
    out = look_up(docs.withColumnsRenamed(held), index).where("kept")
    return out.drop(*own, "key").withColumnsRenamed(back).select(*docs.columns)
