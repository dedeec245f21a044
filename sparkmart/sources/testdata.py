"""The retail star over the driver's TPC-H-like test tables.

Mapping (one product has one supplier and one store, as in the DDL):
  order_id      lineitem.l_orderkey (text in the fact)
  order_date    orders.o_orderdate as DATE
  customer_id   orders.o_custkey
  product_id    part.p_partkey; price = p_retailprice as decimal(10,2)
  supplier      supplier whose s_suppkey = p_partkey mod (number of suppliers)
  store         the supplier's nation; location = its region
  quantity      lineitem.l_quantity as int
Every column is derived lazily; Catalyst prunes what a query does not use.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.dates import calendar_columns, date_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# Rows of the fact that one task joins and aggregates, and the number of tasks from
# which they are counted that way.
ROWS_PER_TASK = 500_000
PLANNED_TASKS = 16

# The calendar the test data lives in (orders run 1995-01-01 .. 2001-08-01);
# the DIM_DATE range rule uses it, as 2019..2024 is used on the real feed.
DATE_RANGE = ("1995-01-01", "2001-12-31")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@dataclass
class Star:
    """A star: the fact table plus its dimensions (all lazy DataFrames)."""

    fact: DataFrame
    dim_product: DataFrame
    dim_store: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    transactions: DataFrame | None = None


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(n.n_nationkey.cast("int").alias("store_id"),
                    n.n_name.alias("store_name"),
                    r.r_name.alias("location")))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    s = read_table(spark, sf_dir, "supplier")
    # One number from the Parquet footers; as a literal it avoids a scalar
    # subquery inside the join condition (re-planned in every branch).
    n_supp = s.count()
    return (p.join(s, (p.p_partkey % n_supp) == s.s_suppkey)
            .select(p.p_partkey.alias("product_id"),
                    p.p_name.alias("product_name"),
                    p.p_retailprice.cast("decimal(10,2)").alias("product_price"),
                    s.s_suppkey.alias("supplier_id"),
                    s.s_name.alias("supplier_name"),
                    s.s_nationkey.cast("int").alias("store_id")))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(c.c_custkey.alias("customer_id"),
                    c.c_name.alias("customer_name"),
                    c.c_mktsegment.alias("segment"))


def calendar(spark: SparkSession, start: str = DATE_RANGE[0],
             end: str = DATE_RANGE[1]) -> DataFrame:
    """DIM_DATE over a fixed calendar range.

    Its size is bounded by the range (366 rows a year), so it is always safe
    to broadcast, and no pass over the fact is needed to build it.
    """
    n_days = (F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")))
    days = spark.range(0, 1).select(F.explode(F.sequence(F.lit(0), n_days)).alias("i"))
    d = F.date_add(F.lit(start).cast("date"), F.col("i"))
    return days.select(*calendar_columns(d))


def line_identity(li: DataFrame) -> "F.Column":
    """128-bit identity of a source order line (two 64-bit hashes of the
    whole line). No column subset of a line is unique, the full line is;
    128 bits keep collisions negligible even at 10^12 lines."""
    cols = [F.col(c) for c in li.columns]
    return F.struct(F.xxhash64(*cols).alias("h1"),
                    F.xxhash64(F.lit("line"), *reversed(cols)).alias("h2"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction feed: one row per order line."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    rows = li.count()  # from the Parquet footers
    li = spread(li.withColumn("line_id", line_identity(li)), rows, "l_orderkey")
    o = spread(o, rows, "o_orderkey")  # as many tasks as the lines, so the join needs no other exchange
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(li.l_orderkey.alias("order_id"),
                    o.o_orderdate.cast("date").alias("order_date"),
                    li.l_partkey.alias("product_id"),
                    o.o_custkey.alias("customer_id"),
                    li.l_quantity.cast("int").alias("quantity"),
                    li.l_linenumber.alias("line_number"),
                    "line_id"))


def spread(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df`` of about ``rows`` rows, dealt by ``key`` to tasks of ``ROWS_PER_TASK`` rows.

    AQE merges shuffle partitions up to a size in compressed bytes. A stage that
    sorts, joins, aggregates and ranks what it reads holds several hundred bytes
    a row at once, some 40 times that size, so tasks are counted from rows here. Few
    rows are left to the planner, which may broadcast the other side.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    return df.repartition(tasks, key) if tasks > PLANNED_TASKS else df


def build_fact(tx: DataFrame, product: DataFrame, rows: int = 0) -> DataFrame:
    """Transactions (about ``rows``) enriched with price and store: FACT_SALES rows.

    The product side is joined on its key only; AQE chooses broadcast or
    sort-merge from runtime sizes (the product table grows with the data, so
    it is never forced to broadcast).
    """
    p = product.select("product_id", "product_price", "store_id")
    j = spread(tx, rows, "product_id").join(p, "product_id")
    return j.select(
        F.col("order_id").cast("string").alias("order_id"),
        "order_date",
        date_key("order_date").alias("date_id"),
        "customer_id",
        "product_id",
        "store_id",
        "quantity",
        F.col("product_price").alias("unit_price"),
        (F.col("product_price") * F.col("quantity")).cast("decimal(18,2)").alias("total_sale"),
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    prod = dim_product(spark, sf_dir)
    tx = transactions(spark, sf_dir)
    return Star(
        # from the Parquet footers
        fact=build_fact(tx, prod, read_table(spark, sf_dir, "lineitem").count()),
        dim_product=prod,
        dim_store=dim_store(spark, sf_dir),
        dim_customer=dim_customer(spark, sf_dir),
        dim_date=calendar(spark),
        transactions=tx,
    )
