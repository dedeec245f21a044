"""End-to-end ETL run: CSV files -> star (dimensions + streamed fact) -> reports.

    python -m sparkmart.pipeline --customers c.csv --products p.csv \
        --transactions t.csv --out /shared/star [--reports]

Steps, as the loader of the reference does them but as Spark jobs:
1. read the three CSV inputs (by position, reject reasons instead of aborts);
2. build DIM_STORE (ids by first appearance), DIM_PRODUCT (store looked up by
   name), DIM_CUSTOMER (first row wins, gender check); full refresh;
3. stage the transaction files that are new (first row wins per order id) and
   stream them in micro-batches bounded by bytes into FACT_SALES through the idempotent loader; DIM_DATE grows
   with the batches' dates;
4. print processed rows, seconds and rows per second.
Re-running against the same output folder is idempotent: dimensions are
overwritten, and the stream resumes from its checkpoint.
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.affinity import product_affinity
from sparkmart.operators.dedupe import FILE_ORDINAL, dedupe_first_wins
from sparkmart.operators.dims import build_dim_customer, build_dim_product, build_dim_store
from sparkmart.schemas import FACT_SALES, TRANSACTIONS
from sparkmart.session import ensure_checkpoint_dir
from sparkmart.sources import csv as C
from sparkmart.sources.testdata import Star
from sparkmart.streaming.fact_stream import (
    StreamPaths, TransactionKey, read_dim_date, read_fact, read_rejects, run_fact_stream, stage_files,
)

# Fixed value: the DIM_DATE range rule of the reference schema.
DATE_RANGE = ("2019-01-01", "2024-12-31")
KEY = TransactionKey("order_id")  # an order id is loaded once, whatever else changes
#: Rows of the staged feed.
FEED = T.StructType([*TRANSACTIONS.fields, T.StructField("line_number", T.IntegerType())])
REJECTS = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("reason", T.StringType())])
INPUTS = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                       T.StructField("length", T.LongType())])


def build_dimensions(spark: SparkSession, customers_csv: str, products_csv: str, out: str) -> dict:
    prods = C.read_products(spark, products_csv)
    stores = build_dim_store(prods, FILE_ORDINAL)
    dims = {
        "dim_store": stores,
        "dim_product": build_dim_product(prods, stores, FILE_ORDINAL),
        "dim_customer": build_dim_customer(C.read_customers(spark, customers_csv), FILE_ORDINAL),
    }
    for name, df in dims.items():
        df.write.mode("overwrite").parquet(os.path.join(out, name))
    return {name: spark.read.parquet(os.path.join(out, name)) for name in dims}


def _new_inputs(spark: SparkSession, transactions_csv: str, staged: str) -> DataFrame:
    """Input files (path, modification time, length) that are not in the list of
    those staged; their contents are not read for it."""
    spark.createDataFrame([], INPUTS).write.mode("ignore").parquet(staged)
    files = spark.read.format("binaryFile").load(transactions_csv).select(*INPUTS.names)
    return files.join(spark.read.schema(INPUTS).parquet(staged), INPUTS.names, "left_anti")


def stage_transactions(spark: SparkSession, transactions_csv: str, paths: StreamPaths) -> None:
    """Parse the input files that are new or have changed and land them for the
    stream, first row per order id; lines rejected while parsing or as repeated
    order ids go to ``parse_rejects``. A run that stops before the files are
    listed stages them again, and the loader finds their orders loaded."""
    staged, rejected = (os.path.join(paths.root, n) for n in ("staged_inputs", "parse_rejects"))
    spark.createDataFrame([], REJECTS).write.mode("ignore").parquet(rejected)
    spark.createDataFrame([], FEED).write.mode("ignore").parquet(paths.source)
    new = _new_inputs(spark, transactions_csv, staged).checkpoint(eager=True)
    files = [r.path for r in new.select("path").toLocalIterator()]  # names of one delivery
    if not files:
        return
    # the staging table: parsed once, so file ordinals are fixed for both uses
    t = C.read_transactions(spark, files).checkpoint(eager=True)
    good = t.filter(F.col("reject_reason").isNull())
    first = dedupe_first_wins(good, ["order_id"], FILE_ORDINAL)
    stage_files(first.select(*[F.col(f.name).cast(f.dataType) for f in TRANSACTIONS.fields],
                             F.lit(1).alias("line_number")), paths.source)
    dup = good.join(first.select("order_id", *FILE_ORDINAL), ["order_id", *FILE_ORDINAL], "left_anti") \
        .withColumn("reject_reason", F.lit("duplicate order_id"))
    t.filter(F.col("reject_reason").isNotNull()).unionByName(dup) \
        .select(F.col("order_id").cast("string"), F.col("reject_reason").alias("reason")) \
        .write.mode("append").parquet(rejected)
    new.write.mode("append").parquet(staged)


def run_etl(spark: SparkSession, customers_csv: str, products_csv: str, transactions_csv: str,
            out: str, date_range: tuple[str, str] = DATE_RANGE) -> dict:
    t0 = time.time()
    ensure_checkpoint_dir(spark)
    dims = build_dimensions(spark, customers_csv, products_csv, out)
    paths = StreamPaths(out)
    stage_transactions(spark, transactions_csv, paths)
    done = run_fact_stream(spark, paths, FEED, dims["dim_customer"], dims["dim_product"], *date_range, key=KEY)
    m = done.agg(F.count("*").alias("batches"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in
                                                  ("rows_in", "rows_loaded", "rows_rejected", "rows_duplicate")]).first()
    secs = time.time() - t0
    return {"processed_rows": m.rows_in, "seconds": round(secs, 3),
            "rows_per_second": round(m.rows_in / secs, 1) if secs > 0 else None, **m.asDict()}


def read_output_star(spark: SparkSession, out: str) -> Star:
    paths = StreamPaths(out)
    fact = read_fact(spark, paths, FEED, KEY).select("sale_id", *FACT_SALES.names)
    rd = lambda n: spark.read.parquet(os.path.join(out, n))
    return Star(fact=fact, dim_product=rd("dim_product"), dim_store=rd("dim_store"),
                dim_customer=rd("dim_customer"), dim_date=read_dim_date(spark, paths))


def rejects(spark: SparkSession, out: str) -> DataFrame:
    """Every line that did not reach the fact, with its reason."""
    parsed = spark.read.schema(REJECTS).parquet(os.path.join(out, "parse_rejects"))
    return parsed.unionByName(read_rejects(spark, StreamPaths(out), FEED, KEY).select("order_id", "reason"))


#: What ``--reports`` prints, whole: (module of reports, star, year) -> rows.
REPORTS = {
    "q01_top_products_by_day_type": lambda R, s, y: R.q01_top_products_by_day_type(s),
    "q02_store_quarter_growth": lambda R, s, y: R.q02_store_quarter_growth(s, year=y),
    "q03_supplier_contribution": lambda R, s, y: R.q03_supplier_contribution(s),
    "q04_seasonal_sales": lambda R, s, y: R.q04_seasonal_sales(s),
    "q05_monthly_volatility": lambda R, s, y: R.q05_monthly_volatility(s),
    "q06_product_affinity": lambda R, s, y: product_affinity(s.fact, s.dim_product),
    "q07_revenue_rollup": lambda R, s, y: R.q07_revenue_rollup(s),
    "q08_half_year": lambda R, s, y: R.q08_half_year(s),
    "q09_revenue_spikes": lambda R, s, y: R.q09_revenue_spikes(s),
    "q10_store_quarter_view": lambda R, s, y: R.q10_store_quarter_view(s),
    "q10b_view_one_year": lambda R, s, y: R.q10_store_quarter_view(s, year=y),
}


def main(argv: list[str] | None = None) -> None:
    from sparkmart.plans import reports as R
    from sparkmart.session import get_spark
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--customers", required=True)
    ap.add_argument("--products", required=True)
    ap.add_argument("--transactions", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--reports", action="store_true")
    ap.add_argument("--year", type=int, default=2019, help="year of the quarterly-growth report and of the one-year view")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    m = run_etl(spark, a.customers, a.products, a.transactions, a.out)
    print(f"Total records processed: {m['processed_rows']}")
    print(f"Total execution time: {m['seconds']} seconds")
    print(f"Average rate: {m['rows_per_second']} records/second")
    if a.reports:
        star = read_output_star(spark, a.out)
        for name, report in REPORTS.items():
            print(f"== {name}")
            df = report(R, star, a.year)
            df.show(df.count(), truncate=False)


if __name__ == "__main__":
    main()
