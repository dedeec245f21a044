"""Structured Streaming fact loader: staged transactions -> enriched fact.

Micro-batches are bounded by bytes (``maxBytesPerTrigger`` over staged files of at
most ``RECORDS_PER_FILE`` rows), so a day of any size comes in as many batches as it
takes. Each batch is enriched with the dimensions, validated and written once:

    loaded/batch_id=<n>/route=<fact|reject>/sale_month=<yyyymm>/
    manifest/batch_id=<n>/        one row: metrics, and the dates of loaded rows

``foreachBatch`` is at-least-once and a driver may stop anywhere, so a batch counts
only once its manifest row is there. Readers take committed batches alone and give
their schema, whatever a stopped batch left behind; a replayed batch overwrites
its own directory.

A transaction is loaded once per key (``TransactionKey``): repeats within a batch
are reduced to the first on the mappers, and a left join with the keys already
loaded finds re-deliveries, whatever else about them has changed. The loaded
rows by month are the index for that: of them only the key and id columns are
read, in the months of the batch and, if a key may come again under another
date, in row groups that reach into the batch's range of keys.

Every row of the fact gets a ``sale_id`` (see ``operators/surrogate.py``). The date
dimension is the set of dates in the manifest; its key is the deterministic
yyyymmdd date key, so get-or-create needs no state.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.dates import calendar_columns
from sparkmart.operators.quality import enrich_with_flags, reject_reason
from sparkmart.operators.surrogate import CHAIN, apart, chained, sale_base
from sparkmart.sources.testdata import PLANNED_TASKS

RECORDS_PER_FILE = 1_000_000  # most rows of a staged file
BYTES_PER_TRIGGER = 512 << 20  # staged bytes of a micro-batch

MANIFEST = T.StructType([
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("rows_duplicate", T.LongType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("dates", T.ArrayType(T.DateType())),
    T.StructField("batch_id", T.LongType()),
])


@dataclass(frozen=True)
class TransactionKey:
    """What makes two deliveries the same transaction. ``dated``: a key never
    comes again under another date, so only the batch's months are looked at."""

    column: str = "order_id"
    dated: bool = False


@dataclass
class StreamPaths:
    root: str
    source: str = field(init=False)
    loaded: str = field(init=False)
    manifest: str = field(init=False)
    checkpoint: str = field(init=False)

    def __post_init__(self):
        self.source = os.path.join(self.root, "incoming")
        self.loaded = os.path.join(self.root, "loaded")
        self.manifest = os.path.join(self.root, "manifest")
        self.checkpoint = os.path.join(self.root, "_checkpoint")


def loaded_schema(feed: T.StructType, key: TransactionKey) -> T.StructType:
    """Columns of the loaded table; the key has the feed's type."""
    return T.StructType([
        T.StructField("key", feed[key.column].dataType),
        T.StructField("sale_id", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("line_number", feed["line_number"].dataType),
        T.StructField("order_date", T.DateType()),
        T.StructField("date_id", T.IntegerType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("total_sale", T.DecimalType(18, 2)),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("route", T.StringType()),
        T.StructField("sale_month", T.IntegerType()),
    ])


def stage_files(tx: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, rows: int = 0) -> None:
    """Land transactions for the stream in files that cover a date range each
    (a day with very many rows is split by order as well) and hold at most
    ``records_per_file`` rows. ``rows``: how many come at most, if known; tasks that
    sort many are counted from them."""
    tasks = -(-rows // RECORDS_PER_FILE)
    (tx.repartitionByRange(*[tasks] * (tasks > PLANNED_TASKS), "order_date", "order_id")
     .sortWithinPartitions("order_date", "order_id")
     .write.mode("append").option("maxRecordsPerFile", records_per_file).parquet(path))


def _prepare(spark: SparkSession, paths: StreamPaths, schema: T.StructType) -> None:
    """The table folders, so that the first batch reads like any other."""
    spark.createDataFrame([], schema).write.mode("ignore") \
        .partitionBy("batch_id", "route", "sale_month").parquet(paths.loaded)
    spark.createDataFrame([], MANIFEST).write.mode("ignore").partitionBy("batch_id").parquet(paths.manifest)


def read_manifest(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """One row per committed batch: rows in, loaded, rejected and duplicate (in
    the batch or loaded before), duration, dates of loaded rows."""
    return spark.read.schema(MANIFEST).parquet(paths.manifest).filter(F.col("batch_id").isNotNull())


def read_loaded(spark: SparkSession, paths: StreamPaths, schema: T.StructType) -> DataFrame:
    """Rows of committed batches, facts and rejects."""
    done = read_manifest(spark, paths).select("batch_id")
    return spark.read.schema(schema).parquet(paths.loaded).join(done, "batch_id", "left_semi")


def _month(c: str) -> Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _known(loaded: DataFrame, batch: DataFrame, batch_id: int, key: TransactionKey) -> DataFrame:
    """key, sale_id of facts of earlier batches that a row of ``batch`` may repeat or
    share an id base with. A batch starts when all earlier ones are committed, so
    they need no look into the manifest."""
    k = key.column
    edge = [F.min(_month("order_date")), F.max(_month("order_date"))]
    if not key.dated:
        edge += [F.min(k), F.max(k)]
    lo, hi, *ids = batch.agg(*edge).first()
    facts = loaded.filter((F.col("route") == "fact") & (F.col("batch_id") < batch_id))
    if lo is None:
        return facts.select("key", "sale_id").limit(0)
    month = F.col("sale_month").between(lo, hi)
    known = facts.filter(month).select("key", "sale_id")
    if not key.dated:
        known = known.unionByName(facts.filter(~month & F.col("key").between(*ids)).select("key", "sale_id"))
    return known


def with_chain_ids(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``rows`` with the sale_id of facts, after the places that ``known`` (sale_id)
    has in their chains. Rows that get none (all but a few of a re-delivery) are dealt
    by their key, not as one group."""
    is_fact = F.col("route") == "fact"
    rows = rows.withColumn("chain", F.coalesce(F.when(is_fact, sale_base()), apart(key)))
    tops = known.groupBy((F.col("sale_id") - F.col("sale_id") % CHAIN).alias("chain")) \
        .agg(F.max(F.col("sale_id") % CHAIN).alias("top"))
    place = F.row_number().over(Window.partitionBy("chain").orderBy(key))
    return rows.join(tops, "chain", "left").withColumn(
        "sale_id", F.when(is_fact, chained("chain", F.coalesce("top", F.lit(-1)) + place)))


def make_batch_writer(spark: SparkSession, paths: StreamPaths, schema: T.StructType, key: TransactionKey,
                      customers: DataFrame, products: DataFrame, date_from: str, date_to: str):
    # reduced once, not in every batch
    customers = customers.select("customer_id").distinct().checkpoint(eager=True)
    out = [f.name for f in schema.fields if f.name != "batch_id"]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        t0 = time.time()
        known = _known(spark.read.schema(schema).parquet(paths.loaded), batch, batch_id, key)
        others = [c for c in batch.columns if c != key.column]
        first = batch.groupBy(key.column) \
            .agg(F.min(F.struct(*others)).alias("first"), F.count("*").alias("copies")) \
            .select(F.col(key.column), *[F.col(f"first.{c}").alias(c) for c in others], "copies")
        seen = known.select(F.col("key").alias(key.column), F.lit(True).alias("seen"))
        # first of the joins: the rows are dealt by key already
        e = enrich_with_flags(first.join(seen, key.column, "left"), customers, products) \
            .withColumn("parse_reason", F.lit(None).cast("string")) \
            .withColumn("reason", reject_reason(date_from, date_to))
        e = e.withColumn("route", F.when(F.col("seen"), "duplicate").when(F.col("reason").isNotNull(), "reject")
                         .otherwise("fact"))
        e = with_chain_ids(e, known, key.column)
        rows = e.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in out if c not in ("key", "unit_price",
                                                                                              "sale_month")],
                        F.col(key.column).alias("key"), F.col("product_price").alias("unit_price"),
                        _month("order_date").alias("sale_month"), "copies") \
            .hint("rebalance", "route", "sale_month")  # a file per month; AQE splits a large one
        took = Observation()
        is_fact = F.col("route") == "fact"
        counted = rows.observe(took, F.sum("copies").alias("rows_in"), F.count_if(is_fact).alias("rows_loaded"),
                               F.count_if(F.col("route") == "reject").alias("rows_rejected"),
                               F.collect_set(F.when(is_fact, F.col("order_date"))).alias("dates"))
        counted.filter(F.col("route") != "duplicate").select(*out).write.mode("overwrite") \
            .partitionBy("route", "sale_month").parquet(os.path.join(paths.loaded, f"batch_id={batch_id}"))
        m = took.get
        rows_in = m["rows_in"] or 0
        row = (rows_in, m["rows_loaded"], m["rows_rejected"], rows_in - m["rows_loaded"] - m["rows_rejected"],
               int(1000 * (time.time() - t0)), sorted(m["dates"]))
        # the batch counts from here on
        spark.createDataFrame([row], T.StructType(MANIFEST.fields[:-1])).coalesce(1).write.mode("overwrite") \
            .parquet(os.path.join(paths.manifest, f"batch_id={batch_id}"))
    return write_batch


def run_fact_stream(spark: SparkSession, paths: StreamPaths, feed: T.StructType, customers: DataFrame,
                    products: DataFrame, date_from: str, date_to: str, key: TransactionKey = TransactionKey(),
                    bytes_per_trigger: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Process every file staged by now (``availableNow``), then stop.

    Restarting with the same checkpoint processes only files not seen yet.
    Returns the manifest rows of this run's batches.
    """
    schema = loaded_schema(feed, key)
    _prepare(spark, paths, schema)
    before = read_manifest(spark, paths).agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]
    src = spark.readStream.schema(feed).option("maxBytesPerTrigger", bytes_per_trigger).parquet(paths.source)
    writer = make_batch_writer(spark, paths, schema, key, customers, products, date_from, date_to)
    src.writeStream.foreachBatch(writer).option("checkpointLocation", paths.checkpoint) \
        .trigger(availableNow=True).start().awaitTermination()
    return read_manifest(spark, paths).filter(F.col("batch_id") > before)


def read_fact(spark: SparkSession, paths: StreamPaths, feed: T.StructType,
              key: TransactionKey = TransactionKey()) -> DataFrame:
    return read_loaded(spark, paths, loaded_schema(feed, key)).filter(F.col("route") == "fact").drop("reason", "route")


def read_rejects(spark: SparkSession, paths: StreamPaths, feed: T.StructType,
                 key: TransactionKey = TransactionKey()) -> DataFrame:
    return read_loaded(spark, paths, loaded_schema(feed, key)).filter(F.col("route") == "reject") \
        .select("order_id", "line_number", "order_date", "product_id", "customer_id", "quantity", "reason")


def read_dim_date(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """A calendar row for each date of a loaded fact."""
    d = read_manifest(spark, paths).select(F.explode("dates").alias("d")).distinct()
    return d.select(*calendar_columns(F.col("d")))
