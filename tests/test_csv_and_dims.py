"""CSV readers and dimension builders: T3, T6, T7, T8, T9 (by rule)."""

import os
from decimal import Decimal

from pyspark.sql import functions as F

from sparkmart.operators.dedupe import FILE_ORDINAL, dedupe_first_wins
from sparkmart.operators.dims import build_dim_customer, build_dim_product, build_dim_store
from sparkmart.session import scratch_path
from sparkmart.sources.csv import read_customers, read_products, read_transactions


def _write(spark, name, text):
    path = scratch_path(spark, name)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-00000.csv"), "w") as fh:
        fh.write(text)
    return path


PRODUCTS = """productID,productName,productPrice,supplierID,supplierName,storeID,storeName
7,Garden hose,18.25$,40,Reed and Sons,9,North Quay
13,Clay pot,4.10$,41,Potters Row,3,Mill Lane
24,Wool rug,310.00$,42,Loom House,5,Old Dock
56,Oak stool,75.60$,43,Timber Yard,8,Hill Top
88,Tin kettle (2 l),22.45$,44,"Kettle, Pan and Co.",8,Hill Top
57,Felt mat,12.30$,42,Loom Street,5,Old Dock
90,Broken,abc$,40,X,9,North Quay
7,Garden hose again,1.00$,40,Reed and Sons,9,North Quay
"""


def test_t8_quoted_product_line_and_price(spark):
    p = read_products(spark, _write(spark, "products", PRODUCTS))
    row = p.filter(F.col("product_id") == 88).first()
    assert row.supplier_name == "Kettle, Pan and Co."
    assert row.product_price == Decimal("22.45")
    assert row.store_name == "Hill Top"
    assert p.filter(F.col("product_id") == 90).first().reject_reason == "bad price"


def test_t9_store_ids_by_first_appearance(spark):
    p = read_products(spark, _write(spark, "products", PRODUCTS))
    stores = {r.store_name: r.store_id for r in build_dim_store(p, FILE_ORDINAL).collect()}
    assert stores == {"North Quay": 1, "Mill Lane": 2, "Old Dock": 3, "Hill Top": 4}
    prods = {r.product_id: r for r in build_dim_product(p, build_dim_store(p, FILE_ORDINAL),
                                                        FILE_ORDINAL).collect()}
    assert prods[7].product_name == "Garden hose"          # T3: first row wins
    assert prods[88].store_id == 4 and 90 not in prods


def test_t6_gender_check_and_t3_first_wins(spark):
    text = "id,name,gender\n1,Ann,Male\n2,Bob,Other\n3,Cy,\n1,Ann Two,Female\nx,Bad,Male\n"
    c = read_customers(spark, _write(spark, "customers", text))
    dim = {r.customer_id: r for r in build_dim_customer(c, FILE_ORDINAL).collect()}
    assert set(dim) == {1, 3}
    assert dim[1].customer_name == "Ann" and dim[3].gender is None


def test_t7_field_count_and_parse(spark):
    text = ("order_id,order_date,product_id,quantity,customer_id\n"
            "1,03/04/2019 10:05,2,3,7\n"
            "2,2019-01-05,2,1\n"
            "3,2019-01-05,2,1,7,9\n"
            "4,garbage,2,1,7\n"
            "5,2019-01-06,2,1.0,7\n")
    t = {r.order_id: r for r in read_transactions(spark, _write(spark, "tx", text)).collect()}
    assert t[1].reject_reason is None and str(t[1].order_date) == "2019-04-03"
    assert t[2].reject_reason == "bad field count"
    assert t[3].reject_reason == "bad field count"
    assert t[4].reject_reason == "bad order_date"
    assert t[5].reject_reason == "bad quantity"


def test_ids_beyond_int32(spark):
    text = ("order_id,order_date,product_id,quantity,customer_id\n"
            "2147483648,2019-01-05,3000000000,1,8589934592\n"
            "9,2019-01-05,1,3000000000,1\n")
    t = {r.order_id: r for r in read_transactions(spark, _write(spark, "tx-long", text)).collect()}
    assert t[2**31].reject_reason is None
    assert (t[2**31].product_id, t[2**31].customer_id) == (3_000_000_000, 2**33)
    assert t[9].reject_reason == "bad quantity"


def test_dedupe_first_wins_keeps_first_in_order(spark):
    df = spark.createDataFrame([(7, 0, 1), (7, 1, 9), (8, 0, 5)], "order_id int, ord int, qty int")
    got = {r.order_id: r.qty for r in dedupe_first_wins(df, ["order_id"], ["ord"]).collect()}
    assert got == {7: 1, 8: 5}
