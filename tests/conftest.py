import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkmart.session import get_spark  # noqa: E402
from sparkmart.sources.testdata import Star, calendar  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="sparkmart-tests", shuffle_partitions=4,
                  extra={"spark.sql.session.timeZone": "UTC"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sm-test-"))
    yield s


def D(s):
    return dt.date.fromisoformat(s)


def make_star(spark, sales, products=None, stores=None):
    """sales: (order_id, 'YYYY-MM-DD', product_id, quantity); product ->
    (name, price, supplier_id, supplier_name, store_id)."""
    products = products or {}
    stores = stores or {1: "Store A"}
    prod_rows = [(pid, p[0], Decimal(str(p[1])), p[2], p[3], p[4]) for pid, p in products.items()]
    dim_product = spark.createDataFrame(
        prod_rows, "product_id long, product_name string, product_price decimal(10,2), "
                   "supplier_id long, supplier_name string, store_id int")
    dim_store = spark.createDataFrame([(k, v, "Location") for k, v in stores.items()],
                                      "store_id int, store_name string, location string")
    fact_rows = []
    for oid, d, pid, q in sales:
        p = products[pid]
        price = Decimal(str(p[1]))
        day = D(d)
        fact_rows.append((str(oid), day, int(day.strftime("%Y%m%d")), 1, pid, p[4], q, price,
                          (price * q).quantize(Decimal("0.01"))))
    fact = spark.createDataFrame(
        fact_rows, "order_id string, order_date date, date_id int, customer_id long, product_id long, "
                   "store_id int, quantity int, unit_price decimal(10,2), total_sale decimal(18,2)")
    cust = spark.createDataFrame([(1, "C", "Male")], "customer_id long, customer_name string, gender string")
    return Star(fact=fact, dim_product=dim_product, dim_store=dim_store, dim_customer=cust,
                dim_date=calendar(spark, "2018-01-01", "2025-12-31"))


def write_tables(spark, folder, lines, n_products=30, n_suppliers=3):
    """The driver's tables for the star, of one's own rows. lines: (order, 'YYYY-MM-DD',
    product, quantity, customer); customers 0-9 exist."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(folder, f"{name}.parquet"))

    put("region", [(0, "R")], "r_regionkey long, r_name string")
    put("nation", [(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long")
    put("customer", [(i, f"C{i}", "X") for i in range(10)], "c_custkey long, c_name string, c_mktsegment string")
    put("supplier", [(i, f"S{i}", 0) for i in range(n_suppliers)], "s_suppkey long, s_name string, s_nationkey long")
    put("part", [(i, f"P{i}", 10.0 + i) for i in range(n_products)], "p_partkey long, p_name string, p_retailprice double")
    orders = {o: (d, c) for o, d, _, _, c in lines}
    put("orders", [(o, c, dt.datetime.fromisoformat(d)) for o, (d, c) in orders.items()],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    put("lineitem", [(o, p, k, float(q)) for k, (o, _, p, q, _) in enumerate(lines)],
        "l_orderkey long, l_partkey long, l_linenumber long, l_quantity double")
    return str(folder)
