"""CSV inputs of the ETL: customers, products, transactions.

Fields are read by position with an explicit all-text schema (the header line
is skipped, never inferred) and parsed with built-in expressions; a line that
does not parse gets a reject reason instead of stopping the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.dates import standardize_date
from sparkmart.functions.numeric import parse_int, parse_long, parse_price
from sparkmart.operators.dedupe import with_file_ordinal
from sparkmart.schemas import CUSTOMERS_CSV, PRODUCTS_CSV, TRANSACTIONS_CSV

_CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    s = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    return (spark.read.schema(s)
            .option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"')
            .option("columnNameOfCorruptRecord", _CORRUPT)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .csv(path))


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """customer_id, customer_name, gender (+ file ordinal, reject reason)."""
    raw = with_file_ordinal(_read(spark, path, CUSTOMERS_CSV))
    cid = parse_long("customer_id")
    return raw.select(
        cid.alias("customer_id"),
        F.trim("customer_name").alias("customer_name"),
        F.trim("gender").alias("gender"),
        "_file", "_block", "_row",
        F.when(F.col(_CORRUPT).isNotNull(), "bad field count")
        .when(cid.isNull(), "bad customer_id").alias("reject_reason"))


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Quote-aware product lines; ``$`` stripped from the price; the file's
    store id is kept as ``source_store_id`` but not used as the key."""
    raw = with_file_ordinal(_read(spark, path, PRODUCTS_CSV))
    pid = parse_long("product_id")
    sid = parse_long("supplier_id")
    price = parse_price("product_price")
    clean = lambda c: F.trim(F.regexp_replace(F.col(c), '"', ""))
    return raw.select(
        pid.alias("product_id"),
        clean("product_name").alias("product_name"),
        price.alias("product_price"),
        sid.alias("supplier_id"),
        clean("supplier_name").alias("supplier_name"),
        parse_long("source_store_id").alias("source_store_id"),
        clean("store_name").alias("store_name"),
        "_file", "_block", "_row",
        F.when(F.col(_CORRUPT).isNotNull(), "bad field count")
        .when(pid.isNull(), "bad product_id")
        .when(price.isNull(), "bad price")
        .when(sid.isNull(), "bad supplier_id").alias("reject_reason"))


def read_transactions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """order_id, order_date (mixed layouts), product_id, quantity,
    customer_id; lines without exactly five fields are rejected."""
    raw = with_file_ordinal(_read(spark, path, TRANSACTIONS_CSV))
    return parse_transaction_fields(raw)


def parse_transaction_fields(raw: DataFrame) -> DataFrame:
    oid = parse_long("order_id")
    pid = parse_long("product_id")
    qty = parse_int("quantity")
    cid = parse_long("customer_id")
    d = standardize_date("order_date")
    bad_count = F.col(_CORRUPT).isNotNull() if _CORRUPT in raw.columns else F.lit(False)
    extra = [c for c in ("_file", "_block", "_row") if c in raw.columns]
    return raw.select(
        oid.alias("order_id"), d.alias("order_date"), pid.alias("product_id"),
        qty.alias("quantity"), cid.alias("customer_id"), *extra,
        F.when(bad_count, "bad field count")
        .when(oid.isNull(), "bad order_id")
        .when(d.isNull(), "bad order_date")
        .when(pid.isNull(), "bad product_id")
        .when(qty.isNull(), "bad quantity")
        .when(cid.isNull(), "bad customer_id").alias("reject_reason"))


def write_csv(df: DataFrame, path: str) -> None:
    """Write text columns as CSV with a header line in every file; fields
    holding a comma or quote are quoted (the products file's convention)."""
    (df.write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))
