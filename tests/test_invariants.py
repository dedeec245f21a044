"""Invariants over the smoke star."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sparkmart.plans import reports as R
from sparkmart.sources.testdata import star

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="smoke data absent")


def test_q3_shares_sum_to_100(spark):
    q3 = R.q03_supplier_contribution(star(spark, SF))
    for r in q3.groupBy("store_name").agg(F.sum("contribution_percentage").alias("s")).collect():
        assert abs(r.s - Decimal(100)) <= Decimal("0.01") * 60


def test_q7_levels_sum_to_total(spark):
    q7 = R.q07_revenue_rollup(star(spark, SF)).collect()
    total = [r.total_revenue for r in q7 if r.year == "Total"][0]
    years = [r for r in q7 if r.year != "Total" and r.store_name == "All Stores"]
    leaves = [r for r in q7 if r.product_name != "All Products"]
    assert abs(sum(r.total_revenue for r in years) - total) <= Decimal("0.01") * len(years)
    assert abs(sum(r.total_revenue for r in leaves) - total) <= Decimal("0.01") * len(leaves)


def test_fact_plus_rejects_is_input(spark):
    s = star(spark, SF)
    n_tx = s.transactions.count()
    n_first = s.transactions.select("order_id").distinct().count()
    rejects = E.queries()["dq_rejects"](spark, SF)
    assert rejects.filter(F.col("reason") == "duplicate order_id").count() == n_tx - n_first
    assert E.queries()["fact_build"](spark, SF).count() == n_tx


def test_stream_equals_batch(spark):
    cols = ["order_id", "order_date", "product_id", "quantity", "total_sale"]
    a = E.queries()["stream_dim_join"](spark, SF).select(*cols)
    b = E.queries()["fact_build"](spark, SF).select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
