"""Validation and rejects: T4 orphans, T5 quantity, T12 range rule."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sparkmart.operators.quality import constraint_violations, enrich_with_flags, reject_reason, valid_tuple
from sparkmart.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_STORE, FACT_SALES, TRANSACTIONS
from sparkmart.session import scratch_path


def test_t4_t5_rejects(spark):
    tx = spark.createDataFrame(
        [(1, dt.date(2019, 1, 5), 10, 100, 2), (2, dt.date(2019, 1, 5), 99, 100, 2),
         (3, dt.date(2019, 1, 5), 10, 999, 2), (4, dt.date(2019, 1, 5), 10, 100, 0),
         (5, dt.date(2019, 1, 5), 10, 100, -1), (6, dt.date(2030, 1, 1), 10, 100, 1),
         (7, dt.date(2019, 1, 5), 10, 100, None), (8, None, 10, 100, 2)],
        "order_id long, order_date date, product_id long, customer_id long, quantity int")
    cust = spark.createDataFrame([(100,)], "customer_id long")
    prod = spark.createDataFrame([(10, Decimal("5.00"), 1)],
                                 "product_id long, product_price decimal(10,2), store_id int")
    e = enrich_with_flags(tx, cust, prod).withColumn("parse_reason", F.lit(None).cast("string"))
    got = {r.order_id: (r.reason, r.ok) for r in
           e.select("order_id", reject_reason("2019-01-01", "2024-12-31").alias("reason"),
                    valid_tuple().alias("ok")).collect()}
    assert got[1] == (None, True)
    assert got[2][0] == "unknown product_id" and got[3][0] == "unknown customer_id"
    assert got[4][0] == "quantity not positive" and got[5][0] == "quantity not positive"
    assert got[6][0] == "order_date out of range"
    assert got[7][0] == "quantity not positive" and got[8][0] == "order_date out of range"
    assert not any(got[k][1] for k in (2, 3, 4, 5, 7, 8))


def _table(spark, schema, rows, extra=""):
    """Rows of a star table with every column nullable, as files may hold them."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return spark.createDataFrame(rows, extra + cols)


def test_every_rule_of_the_schema_finds_its_violations(spark):
    d, p = dt.date(2019, 1, 5), Decimal("5.00")
    customer = _table(spark, DIM_CUSTOMER, [(1, "a", "Male"), (1, "b", None), (None, None, "Other"), (3, "c", "Female")])
    store = _table(spark, DIM_STORE, [(1, "s", "x"), (2, None, None), (2, "t", "x")])
    product = _table(spark, DIM_PRODUCT, [(10, "p", p, 1, "n", 1), (11, None, None, None, None, None),
                                          (12, "q", p, 1, "n", 77)])
    full = (2019, 1, 1, "January", 5)
    dates = _table(spark, DIM_DATE, [(20190105, d, *full, 7, "Saturday", True), (20190106, d, *full, 1, "Sunday", False),
                                     (20190105, dt.date(2030, 1, 1), *full, 3, "Tuesday", False),
                                     (None, None, None, None, None, None, None, None, None, None)])
    tx = _table(spark, TRANSACTIONS, [(1, d, 10, 1, 2), (1, d, 99, 9, 2), (1, d, None, None, None), (None, None, 10, 1, 1)])
    fact = _table(spark, FACT_SALES, [
        ("1", d, 20190105, 1, 10, 1, 2, p, p), ("2", d, 20200101, 9, 99, 9, 0, Decimal("0.00"), p),
        (None, None, None, None, None, None, None, None, None), ("4", d, 20190105, 1, 10, 1, -2, p, p)]) \
        .withColumn("sale_id", F.when(F.col("order_id") == "4", 1).otherwise(F.col("order_id").cast("long")))
    got = {r.rule: r.violations for r in constraint_violations(
        fact, product, store, dates, customer, tx, "2019-01-01", "2024-12-31").collect()}
    zero = {r for r, n in got.items() if n == 0}
    assert {r: n for r, n in got.items() if n} == {
        "dim_customer primary key": 2, "dim_customer.customer_name not null": 1, "dim_customer.gender allowed": 1,
        "dim_store primary key": 1, "dim_store.store_name not null": 1,
        "dim_product.product_name not null": 1, "dim_product.product_price not null": 1,
        "dim_product.supplier_id not null": 1, "dim_product.supplier_name not null": 1,
        "dim_product.store_id -> dim_store": 1,
        "dim_date primary key": 2, "dim_date.is_weekend generated": 1, "dim_date.date_range": 1,
        **{f"dim_date.{c} not null": 1 for c in ("full_date", "year", "quarter", "month", "month_name", "day_of_month",
                                                 "day_of_week", "day_name")},
        "transactions primary key": 3, "transactions.order_date not null": 1, "transactions.product_id not null": 1,
        "transactions.customer_id not null": 1, "transactions.quantity not null": 1,
        "transactions.product_id -> dim_product": 1, "transactions.customer_id -> dim_customer": 1,
        "fact primary key": 2, "fact.order_id not null": 1, "fact.order_date not null": 1, "fact.quantity not null": 1,
        "fact.unit_price not null": 1, "fact.quantity > 0": 2, "fact.unit_price > 0": 1,
        "fact.date_id -> dim_date": 1, "fact.customer_id -> dim_customer": 1, "fact.product_id -> dim_product": 1,
        "fact.store_id -> dim_store": 1}
    assert zero == {"dim_product primary key"}


def test_rules_read_each_table_once(spark):
    t = {}
    for name, schema in (("customer", DIM_CUSTOMER), ("store", DIM_STORE), ("product", DIM_PRODUCT), ("dates", DIM_DATE),
                         ("tx", TRANSACTIONS), ("fact", FACT_SALES)):
        path = scratch_path(spark, f"dq-{name}")
        _table(spark, schema, [], "sale_id long, " if name == "fact" else "").write.parquet(path)
        t[name] = spark.read.parquet(path)
    plan = constraint_violations(t["fact"], t["product"], t["store"], t["dates"], t["customer"], t["tx"],
                                 "2019-01-01", "2024-12-31")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unit_price#") and sum("Relation [" in line and "unit_price" in line
                                             for line in plan.splitlines()) == 1
    assert sum("Relation [" in line and "order_id" in line and "unit_price" not in line
               for line in plan.splitlines()) == 1


def test_joins_with_parents_carry_flags_only(spark):
    """what a row breaks by itself is found before the joins, which shuffle one number for it."""
    empty = lambda schema, extra="": _table(spark, schema, [], extra)
    plan = constraint_violations(empty(FACT_SALES, "sale_id long, "), empty(DIM_PRODUCT), empty(DIM_STORE), empty(DIM_DATE),
                                 empty(DIM_CUSTOMER), empty(TRANSACTIONS), "2019-01-01", "2024-12-31")
    lines = plan._jdf.queryExecution().analyzed().toString().splitlines()
    below = [lines[i + 1].split(" AS own")[-1] for i, line in enumerate(lines) if "Join LeftOuter" in line]
    assert len(below) == 7
    assert not any(f"{c}#" in line for line in below for c in ("quantity", "unit_price", "order_date", "order_id"))
