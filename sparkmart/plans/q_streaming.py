"""Streaming queries. Each run lands the transaction feed of
the test data as files in a fresh folder under the shared checkpoint
directory, streams it with ``availableNow`` and returns what the sinks hold.
The oracle is the same enrichment written as one batch query.

An order of the test data has many lines and no number tells them apart, so a
transaction is a whole line there; the keys on re-delivery take the first
line of each order, as the transactions table has one row per order id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmart.plans.oracle_sql import with_star
from sparkmart.plans.registry import register
from sparkmart.session import scratch_path
from sparkmart.sources.testdata import DATE_RANGE, read_table, star
from sparkmart.streaming.fact_stream import (
    BYTES_PER_TRIGGER, RECORDS_PER_FILE, StreamPaths, TransactionKey, read_dim_date, read_fact, read_manifest,
    read_rejects, run_fact_stream, stage_files,
)

LINE = TransactionKey("line_id", dated=True)  # the same line never has another date
ORDER = TransactionKey("order_id")
FACT_COLS = ["order_id", "order_date", "date_id", "customer_id", "product_id", "store_id",
             "quantity", "unit_price", "total_sale"]

SQL_FACT = with_star("""
SELECT f.order_id, f.order_date, f.date_id, f.customer_id, f.product_id, f.store_id,
       f.quantity, f.unit_price, f.total_sale
FROM fact f WHERE EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)""")


def _run(spark, sf_dir, name, deliveries=None, restarts=0, key=LINE, records_per_file=RECORDS_PER_FILE, batches=1):
    """Stage the feed (optionally in deliveries, each a function of the
    transactions and followed by a stream run on the same checkpoint);
    (paths, schema of the feed). A batch has at most its share of what is staged."""
    s = star(spark, sf_dir)
    paths = StreamPaths(scratch_path(spark, name))
    tx = s.transactions
    rows = read_table(spark, sf_dir, "lineitem").count()  # from the Parquet footers
    # dimensions are built once before the stream starts (as the ETL writes
    # them first); micro-batches then join the materialised tables
    cust = s.dim_customer.select("customer_id").checkpoint(eager=True)
    prod = s.dim_product.select("product_id", "product_price", "store_id").checkpoint(eager=True)
    for part in [*(deliveries or [lambda t: t]), *[None] * restarts]:
        if part is not None:
            stage_files(part(tx), paths.source, records_per_file, rows)
        bound = BYTES_PER_TRIGGER
        if batches > 1:
            staged = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths.source)
            bound = min(bound, max(1, staged.agg(F.sum("length")).first()[0] // batches))
        run_fact_stream(spark, paths, tx.schema, cust, prod, *DATE_RANGE, key=key, bytes_per_trigger=bound)
    return paths, tx.schema


def _between(lo=None, hi=None):
    """The transactions of a date range."""
    def part(tx):
        d = F.col("order_date")
        if lo is not None:
            tx = tx.filter(d >= F.lit(lo).cast("date"))
        return tx if hi is None else tx.filter(d < F.lit(hi).cast("date"))
    return part


MICRO_BATCHES = 8  # batches that the feed is dealt into, if no batch gets over the loader's bounds


@register("stream_micro_batch", SQL_FACT, "2.9")
def stream_micro_batch(spark, sf_dir):
    """The feed in several batches bounded by bytes; their number does not grow
    with the feed until the loader's own bounds make more of them."""
    rows = read_table(spark, sf_dir, "lineitem").count()
    per_file = min(RECORDS_PER_FILE, max(1, rows // (2 * MICRO_BATCHES)))
    paths, feed = _run(spark, sf_dir, "stream-micro-batch", records_per_file=per_file, batches=MICRO_BATCHES)
    return read_fact(spark, paths, feed, LINE).select(*FACT_COLS)


@register("stream_dim_join", SQL_FACT, "2.9")
def stream_dim_join(spark, sf_dir):
    paths, feed = _run(spark, sf_dir, "stream-dim-join")
    return read_fact(spark, paths, feed, LINE).select(*FACT_COLS)


# The order of an order's lines; whole-line ties are equal in every column that is loaded.
_LINES = ["line_number", "product_id", "quantity", "customer_id"]


def _one_line(pick):
    """One line of each order: the first (``F.min``) or the last (``F.max``)."""
    def part(tx):
        best = tx.groupBy("order_id", "order_date").agg(pick(F.struct(*_LINES, "line_id")).alias("b"))
        return best.select(*[F.col(f"b.{c}").alias(c) if c not in ("order_id", "order_date") else F.col(c)
                             for c in tx.columns])
    return part


@register("stream_incremental_dedupe", with_star("""
SELECT f.order_id, f.order_date, f.date_id, f.customer_id, f.product_id, f.store_id,
       f.quantity, f.unit_price, f.total_sale
FROM (
  SELECT CAST(t.order_id AS VARCHAR) AS order_id, t.order_date,
         CAST(year(t.order_date) * 10000 + month(t.order_date) * 100 + day(t.order_date) AS INTEGER) AS date_id,
         t.customer_id, t.product_id, p.store_id, t.quantity, p.product_price AS unit_price,
         CAST(p.product_price * t.quantity AS DECIMAL(18,2)) AS total_sale,
         ROW_NUMBER() OVER (PARTITION BY t.order_id
                            ORDER BY t.line_number, t.product_id, t.quantity, t.customer_id) AS first,
         ROW_NUMBER() OVER (PARTITION BY t.order_id
                            ORDER BY t.line_number DESC, t.product_id DESC, t.quantity DESC, t.customer_id DESC) AS last
  FROM tx t JOIN dim_product p ON p.product_id = t.product_id) f
WHERE CASE WHEN f.order_date < DATE '1998-07-01' THEN f.first = 1 ELSE f.last = 1 END
  AND EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)"""), "2.9")
def stream_incremental_dedupe(spark, sf_dir):
    """The second delivery brings a year of orders again, with another line each:
    what was loaded first stays."""
    paths, feed = _run(spark, sf_dir, "stream-dedupe", key=ORDER, deliveries=[
        lambda t: _one_line(F.min)(_between(hi="1998-07-01")(t)),
        lambda t: _one_line(F.max)(_between(lo="1997-07-01")(t))])
    return read_fact(spark, paths, feed, ORDER).select(*FACT_COLS)


@register("stream_resume", SQL_FACT, "2.9")
def stream_resume(spark, sf_dir):
    # first slice, restart with new files, then a restart with nothing new
    paths, feed = _run(spark, sf_dir, "stream-resume", restarts=1,
                       deliveries=[_between(hi="1998-01-01"), _between(lo="1998-01-01")])
    return read_fact(spark, paths, feed, LINE).select(*FACT_COLS)


@register("stream_date_get_or_create", with_star("""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_id, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT order_date AS d FROM fact f
      WHERE EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = f.customer_id)) t"""), "2.9")
def stream_date_get_or_create(spark, sf_dir):
    paths, _ = _run(spark, sf_dir, "stream-dates", deliveries=[_between(hi="1998-07-01"), _between(lo="1997-07-01")])
    return read_dim_date(spark, paths)


@register("stream_validate_route", with_star("""
SELECT 'fact' AS route, CAST(NULL AS VARCHAR) AS reason, COUNT(*) AS n_rows FROM tx t
WHERE EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = t.customer_id)
  AND EXISTS (SELECT 1 FROM dim_product p WHERE p.product_id = t.product_id)
  AND t.quantity > 0 AND t.order_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
HAVING COUNT(*) > 0
UNION ALL
SELECT 'reject', reason, COUNT(*) FROM (
  SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = t.customer_id)
              THEN 'unknown customer_id'
              WHEN NOT EXISTS (SELECT 1 FROM dim_product p WHERE p.product_id = t.product_id)
              THEN 'unknown product_id'
              WHEN t.quantity <= 0 THEN 'quantity not positive'
              WHEN t.order_date NOT BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
              THEN 'order_date out of range' END AS reason
  FROM tx t) r
WHERE reason IS NOT NULL GROUP BY reason"""), "2.9")
def stream_validate_route(spark, sf_dir):
    paths, feed = _run(spark, sf_dir, "stream-route")
    good = read_fact(spark, paths, feed, LINE).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 0") \
        .select(F.lit("fact").alias("route"), F.lit(None).cast("string").alias("reason"), "n_rows")
    bad = read_rejects(spark, paths, feed, LINE).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")) \
        .select(F.lit("reject").alias("route"), "reason", "n_rows")
    return good.unionByName(bad)


@register("stream_metrics", with_star("""
SELECT COUNT(*) FILTER (WHERE delivery = 1) + COUNT(*) FILTER (WHERE delivery = 2) AS rows_in,
       COUNT(*) FILTER (WHERE ok AND (delivery = 1 OR order_date >= DATE '1998-07-01')) AS rows_loaded,
       COUNT(*) FILTER (WHERE NOT ok) AS rows_rejected,
       COUNT(*) FILTER (WHERE ok AND delivery = 2 AND order_date < DATE '1998-07-01') AS rows_duplicate,
       TRUE AS each_batch_adds_up
FROM (
  SELECT d.delivery, t.order_date,
         EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = t.customer_id)
         AND EXISTS (SELECT 1 FROM dim_product p WHERE p.product_id = t.product_id) AND t.quantity > 0 AS ok
  FROM tx t JOIN (SELECT 1 AS delivery UNION ALL SELECT 2) d
    ON CASE d.delivery WHEN 1 THEN t.order_date < DATE '1998-07-01' ELSE t.order_date >= DATE '1997-07-01' END) r"""),
          "2.9")
def stream_metrics(spark, sf_dir):
    """Rows in, loaded, rejected and duplicate, summed over the manifest's row of
    each micro-batch."""
    paths, _ = _run(spark, sf_dir, "stream-metrics", deliveries=[_between(hi="1998-07-01"), _between(lo="1997-07-01")])
    kinds = ("rows_loaded", "rows_rejected", "rows_duplicate")
    whole = F.col("rows_in") == sum((F.col(c) for c in kinds), F.lit(0))
    return read_manifest(spark, paths).agg(
        *[F.sum(c).alias(c) for c in ("rows_in", *kinds)], F.bool_and(whole).alias("each_batch_adds_up"))
