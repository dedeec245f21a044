"""End-to-end ETL on CSV fixtures (T24 completeness, rejects, reports)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from sparkmart import pipeline as PL
from sparkmart.plans import reports as R
from sparkmart.session import scratch_path


def _files(spark):
    root = scratch_path(spark, "pipeline-in")
    os.makedirs(root, exist_ok=True)
    stores = ["North Quay", "Mill Lane", "Old Dock", "Hill Top"]
    with open(os.path.join(root, "products.csv"), "w") as fh:
        fh.write("productID,productName,productPrice,supplierID,supplierName,storeID,storeName\n")
        for i in range(1, 102):
            sup = '"Kettle, Pan and Co."' if i % 10 == 0 else f"Supplier {i % 7}"
            fh.write(f"{i},Product {i},{10 + i}.99$,{i % 7},{sup},{i % 4 + 1},{stores[i % 4]}\n")
    with open(os.path.join(root, "customers.csv"), "w") as fh:
        fh.write("customer_id,customer_name,gender\n")
        for i in range(1, 1501):
            fh.write(f"{i},Customer {i},{'Male' if i % 2 else 'Female'}\n")
    with open(os.path.join(root, "transactions.csv"), "w") as fh:
        fh.write("order_id,order_date,product_id,quantity,customer_id\n")
        day0 = dt.date(2019, 1, 1)
        for i in range(1, 401):
            d = day0 + dt.timedelta(days=i * 3)
            text = d.strftime("%d/%m/%Y 10:05") if i % 2 else d.strftime("%Y-%m-%d")
            fh.write(f"{i},{text},{i % 101 + 1},{i % 5 + 1},{i * 3 % 1500 + 1}\n")
        fh.write("5,2019-02-02,1,1,1\n")          # repeated order id: first wins
        fh.write("401,garbage,1,1,1\n")           # bad date
        fh.write("402,2019-02-02,999,1,1\n")      # unknown product
        fh.write("403,2019-02-02,1,1\n")          # four fields
    return root


def test_pipeline_end_to_end(spark):
    src = _files(spark)
    out = scratch_path(spark, "pipeline-out")
    m = PL.run_etl(spark, os.path.join(src, "customers.csv"), os.path.join(src, "products.csv"),
                   os.path.join(src, "transactions.csv"), out)
    star = PL.read_output_star(spark, out)
    assert star.fact.count() == 400                      # T24: nothing lost
    assert m["processed_rows"] == 401                     # 400 good + unknown product
    reasons = {r.reason: r.n for r in PL.rejects(spark, out).groupBy("reason")
               .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert reasons == {"duplicate order_id": 1, "bad order_date": 1, "unknown product_id": 1,
                       "bad field count": 1}
    assert star.dim_store.count() == 4 and star.dim_product.count() == 101
    assert star.dim_date.count() == star.fact.select("order_date").distinct().count()
    # idempotent re-run: same output, and nothing is staged again
    staged = sorted(os.listdir(os.path.join(out, "incoming")))
    again = PL.run_etl(spark, os.path.join(src, "customers.csv"), os.path.join(src, "products.csv"),
                       os.path.join(src, "transactions.csv"), out)
    assert again["processed_rows"] == 0 and again["batches"] == 0
    assert sorted(os.listdir(os.path.join(out, "incoming"))) == staged
    star = PL.read_output_star(spark, out)   # the re-run replaced the dimension files
    assert star.fact.count() == 400
    q7 = R.q07_revenue_rollup(star).filter(F.col("year") == "Total").first()
    assert q7.total_revenue == star.fact.agg(F.sum("total_sale")).first()[0]


def test_pipeline_cli(spark, capsys):
    src = _files(spark)
    out = scratch_path(spark, "pipeline-cli")
    PL.main(["--customers", os.path.join(src, "customers.csv"),
             "--products", os.path.join(src, "products.csv"),
             "--transactions", os.path.join(src, "transactions.csv"),
             "--out", out, "--reports", "--year", "2019"])
    text = capsys.readouterr().out
    assert "Total records processed: 401" in text
    assert "== q06_product_affinity" in text and "== q10b_view_one_year" in text
    assert "== q02_store_quarter_growth" in text and "== q10_store_quarter_view" in text


def test_a_second_file_adds_to_the_star(spark):
    src = _files(spark)
    out = scratch_path(spark, "pipeline-more")
    args = [spark, os.path.join(src, "customers.csv"), os.path.join(src, "products.csv")]
    tx = os.path.join(src, "tx")
    os.makedirs(tx)
    os.rename(os.path.join(src, "transactions.csv"), os.path.join(tx, "a.csv"))
    PL.run_etl(*args, tx, out)
    with open(os.path.join(tx, "b.csv"), "w") as fh:
        fh.write("order_id,order_date,product_id,quantity,customer_id\n7,2020-01-01,1,99,1\n900,2020-01-01,1,1,1\n")
    m = PL.run_etl(*args, tx, out)
    assert (m["rows_in"], m["rows_loaded"], m["rows_duplicate"]) == (2, 1, 1)
    fact = PL.read_output_star(spark, out).fact
    assert fact.count() == 401 and fact.filter("order_id = '7' AND quantity = 99").count() == 0
    assert fact.select("sale_id").distinct().count() == 401
