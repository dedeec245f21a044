"""Dimension and fact building (the ETL's transform step)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.dates import calendar_columns, date_key
from sparkmart.operators.dedupe import dedupe_first_wins
from sparkmart.operators.ordering import with_position
from sparkmart.schemas import GENDERS

STORE_LOCATION = "Location"  # fixed value: the loader's constant location text


def build_dim_store(products: DataFrame, ordinal: list[str]) -> DataFrame:
    """One store per distinct store name; ids 1..k by first appearance.

    Stores come from user files and have no bound, so they are numbered over
    range partitions, not in one window.
    """
    first = [F.min(F.struct(*[F.col(c) for c in ordinal])).alias("__first")]
    names = products.filter(F.col("store_name").isNotNull()).groupBy("store_name").agg(*first) \
        .select("store_name", *[F.col(f"__first.{c}").alias(f"__o{i}") for i, c in enumerate(ordinal)])
    # two names never stand in one row of a file
    numbered = with_position(names, [f"__o{i}" for i in range(len(ordinal))], "store_id")
    return numbered.select(F.col("store_id").cast("int").alias("store_id"), "store_name",
                           F.lit(STORE_LOCATION).alias("location"))


def build_dim_product(products: DataFrame, stores: DataFrame, ordinal: list[str]) -> DataFrame:
    """Products with the store key looked up by store name (NULL if none);
    first row wins on a repeated product id."""
    p = products.filter(F.col("reject_reason").isNull()) if "reject_reason" in products.columns \
        else products
    p = dedupe_first_wins(p.select("product_id", "product_name", "product_price", "supplier_id",
                                   "supplier_name", "store_name", *ordinal),
                          ["product_id"], ordinal)
    j = p.join(stores.select("store_name", "store_id"), "store_name", "left")
    return j.select("product_id", "product_name", "product_price", "supplier_id",
                    "supplier_name", "store_id")


def gender_ok(c: str = "gender"):
    """CHECK (gender IN ('Male','Female')): NULL passes, as in SQL."""
    return F.col(c).isNull() | F.col(c).isin(*GENDERS)


def build_dim_customer(customers: DataFrame, ordinal: list[str],
                       check_col: str = "gender", allowed=GENDERS) -> DataFrame:
    """First row per customer id wins; rows failing the allowed-values
    check (NULL passes) are dropped, as an ignored insert would be."""
    c = customers.filter(F.col("reject_reason").isNull()) if "reject_reason" in customers.columns \
        else customers
    c = dedupe_first_wins(c, ["customer_id"], ordinal)
    ok = F.col(check_col).isNull() | F.col(check_col).isin(*allowed)
    return c.filter(ok & F.col("customer_name").isNotNull()) \
        .select("customer_id", "customer_name", check_col)


def build_dim_date(dates: DataFrame, col: str = "order_date") -> DataFrame:
    """Calendar rows for the distinct dates of accepted facts."""
    d = dates.select(F.col(col).alias("d")).filter(F.col("d").isNotNull()).distinct()
    return d.select(*calendar_columns(F.col("d")))


def enrich(tx: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Stream/batch tuple enrichment: transaction x customer x product.

    Customer existence is a semi-join (only the key is needed); product
    brings price and store. Both are planner-chosen joins: neither dimension
    has a size bound, so neither is forced to broadcast.
    """
    t = tx.join(customers.select("customer_id"), "customer_id", "left_semi")
    p = products.select("product_id", "product_price", "store_id")
    return t.join(p, "product_id")


def fact_columns(enriched: DataFrame) -> DataFrame:
    """FACT_SALES columns from an enriched transaction."""
    return enriched.select(
        F.col("order_id").cast("string").alias("order_id"),
        "order_date",
        date_key("order_date").alias("date_id"),
        "customer_id", "product_id", "store_id", "quantity",
        F.col("product_price").alias("unit_price"),
        (F.col("product_price") * F.col("quantity")).cast("decimal(18,2)").alias("total_sale"),
        *[c for c in ("line_id", "line_number") if c in enriched.columns])
