"""Explicit schemas. Inputs are never schema-inferred."""

from pyspark.sql import types as T

# Raw CSV inputs, read by position (header line skipped).
CUSTOMERS_CSV = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCTS_CSV = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("product_price", T.StringType()),
    T.StructField("supplier_id", T.StringType()),
    T.StructField("supplier_name", T.StringType()),
    T.StructField("source_store_id", T.StringType()),
    T.StructField("store_name", T.StringType()),
])

TRANSACTIONS_CSV = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("customer_id", T.StringType()),
])

# Star tables.
DIM_CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("gender", T.StringType()),
])

DIM_STORE = T.StructType([
    T.StructField("store_id", T.IntegerType(), False),
    T.StructField("store_name", T.StringType(), False),
    T.StructField("location", T.StringType()),
])

DIM_PRODUCT = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("product_price", T.DecimalType(10, 2), False),
    T.StructField("supplier_id", T.LongType(), False),
    T.StructField("supplier_name", T.StringType(), False),
    T.StructField("store_id", T.IntegerType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("day_of_month", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("day_name", T.StringType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
])

TRANSACTIONS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("quantity", T.IntegerType(), False),
])

FACT_SALES = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("date_id", T.IntegerType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DecimalType(10, 2), False),
    T.StructField("total_sale", T.DecimalType(18, 2)),
])

# The allowed gender codes of DIM_CUSTOMER.
GENDERS = ("Male", "Female")
