"""Physical-plan properties the scale design relies on."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="smoke data absent")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_year_filter_reaches_the_scan(spark):
    p = _plan(E.queries()["q02_store_quarter_growth"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in p and "LessThan(o_orderdate,1998-01-01" in p


def test_scan_reads_only_needed_columns(spark):
    p = _plan(E.queries()["agg_count_star"](spark, SF))
    lineitem_schema = [ln for ln in p.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln]
    assert lineitem_schema and all("l_extendedprice" not in ln for ln in lineitem_schema)


def test_rank_limit_runs_before_the_shuffle(spark):
    p = _plan(E.queries()["win_topk_per_group"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_store_share_uses_no_window(spark):
    p = _plan(E.queries()["q03_supplier_contribution"](spark, SF))
    assert "Window " not in p and "Window(" not in p


@pytest.mark.parametrize("key", ["q07_revenue_rollup", "agg_rollup", "agg_count_distinct"])
def test_rollups_do_not_expand_the_fact(spark, key):
    p = _plan(E.queries()[key](spark, SF))
    fact = [ln for ln in p.splitlines() if "Expand" in ln]
    assert not fact or key == "agg_count_distinct" and "product_id" not in str(fact)


def test_the_view_of_one_year_reads_its_partition(spark):
    p = _plan(E.queries()["view_store_quarterly"](spark, SF))
    filters = [ln for ln in p.splitlines() if "PartitionFilters" in ln]
    assert len(filters) == 2 and all("sale_year" in ln and "1997" in ln for ln in filters)


def test_a_range_of_dates_reads_its_years(spark):
    from sparkmart.session import scratch_path
    from sparkmart.sources import parquet
    from sparkmart.sources.testdata import star
    root = scratch_path(spark, "years")
    s = star(spark, SF)
    parquet.write_star(s, root)
    part = parquet.read_fact(spark, root, "1996-03-01", "1997-02-28")
    p = _plan(part)
    assert "PartitionFilters: [isnotnull(sale_year" in p and "PushedFilters: [IsNotNull(order_date)" in p
    assert {str(f).rsplit("=", 1)[1] for f in {r[0].rsplit("/", 1)[0] for r in
            part.select("_metadata.file_path").distinct().collect()}} == {"1996", "1997"}
    assert part.count() == s.fact.filter("order_date BETWEEN '1996-03-01' AND '1997-02-28'").count()


def test_a_null_in_a_not_null_column_stops_the_write(spark):
    from sparkmart import schemas
    from sparkmart.sources.parquet import conform
    rows = spark.createDataFrame([(1, None, "x")], "store_id int, store_name string, location string")
    with pytest.raises(Exception, match="dim_store.store_name is NULL"):
        conform(rows, schemas.DIM_STORE, "dim_store").collect()
    with pytest.raises(ValueError, match="no column store_name"):
        conform(rows.drop("store_name"), schemas.DIM_STORE, "dim_store")
    named = rows.selectExpr("store_id", "location AS store_name")
    assert conform(named, schemas.DIM_STORE, "dim_store").collect() == [(1, "x", None)]


def test_pairs_are_partitioned_before_the_sum(spark):
    p = _plan(E.queries()["q06_product_affinity"](spark, SF))
    assert "hashpartitioning(i1" in p and "REPARTITION_BY_NUM" in p
