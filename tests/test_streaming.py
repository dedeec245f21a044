"""Streaming loader: T23 overlap + restart, T24 completeness, crashes, replays,
re-deliveries, metrics of many batches, batches bounded by size."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkmart.session import scratch_path
from sparkmart.streaming import fact_stream
from sparkmart.streaming.fact_stream import (
    StreamPaths, TransactionKey, make_batch_writer, read_dim_date, read_fact, read_loaded, read_manifest,
    read_rejects, run_fact_stream, stage_files,
)

SCHEMA = ("order_id long, order_date date, product_id long, customer_id long, quantity int, "
          "line_number int")
RANGE = ("2019-01-01", "2024-12-31")


def _tx(spark, ids, quantity=None, day=None):
    rows = [(i, day or dt.date(2019, 1, 1) + dt.timedelta(days=i % 30), i % 101, i % 1500,
             quantity or 1 + i % 5, 1) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def dims(spark):
    cust = spark.createDataFrame([(i, f"C{i}", "Male") for i in range(1500)],
                                 "customer_id long, customer_name string, gender string")
    prod = spark.createDataFrame([(i, f"P{i}", Decimal("9.99"), 1, "S", 1) for i in range(101)],
                                 "product_id long, product_name string, product_price decimal(10,2), "
                                 "supplier_id long, supplier_name string, store_id int")
    return cust, prod


@pytest.fixture
def feed(spark):
    return spark.createDataFrame([], SCHEMA).schema


@pytest.fixture
def paths(spark):
    return StreamPaths(scratch_path(spark, "stream-test"))


def _run(spark, paths, feed, dims, **kw):
    return run_fact_stream(spark, paths, feed, *dims, *RANGE, **kw).collect()


def _loaded(spark, paths, feed):
    return sorted((r.key, r.quantity) for r in read_fact(spark, paths, feed).select("key", "quantity").collect())


def test_t23_overlap_and_restart(spark, dims, feed, paths):
    stage_files(_tx(spark, range(1, 6)), paths.source)
    _run(spark, paths, feed, dims)
    stage_files(_tx(spark, range(4, 9)), paths.source)
    _run(spark, paths, feed, dims)
    assert _run(spark, paths, feed, dims) == []
    f = read_fact(spark, paths, feed)
    assert f.count() == 8 and f.select("order_id").distinct().count() == 8
    assert f.select("sale_id").distinct().count() == 8


def test_t24_completeness(spark, dims, feed, paths):
    stage_files(_tx(spark, range(400)), paths.source)
    _run(spark, paths, feed, dims)
    f = read_fact(spark, paths, feed)
    assert f.count() == 400
    assert f.agg(F.sum("total_sale")).first()[0] == sum(Decimal("9.99") * (1 + i % 5) for i in range(400))


@pytest.mark.parametrize("day", [None, dt.date(2021, 5, 5)])
def test_order_delivered_again_with_another_quantity_or_date(spark, dims, feed, paths, day):
    stage_files(_tx(spark, range(5, 10), quantity=2), paths.source)
    _run(spark, paths, feed, dims)
    stage_files(_tx(spark, [7, 7, 12], quantity=9, day=day), paths.source)
    m = _run(spark, paths, feed, dims)
    assert _loaded(spark, paths, feed) == [(5, 2), (6, 2), (7, 2), (8, 2), (9, 2), (12, 9)]
    assert [(r.rows_in, r.rows_loaded, r.rows_rejected, r.rows_duplicate) for r in m] == [(3, 1, 0, 2)]


def test_repeats_within_a_batch_and_rejects(spark, dims, feed, paths):
    bad = spark.createDataFrame([(50, dt.date(2019, 1, 2), 999, 1, 1, 1), (51, dt.date(2010, 1, 1), 1, 1, 1, 1),
                                 (52, None, 1, 1, 1, 1), (53, dt.date(2019, 1, 2), 1, 1, -1, 1)], SCHEMA)
    stage_files(_tx(spark, [1, 1, 1, 2]).unionByName(bad), paths.source)
    m = _run(spark, paths, feed, dims)
    assert [(r.rows_in, r.rows_loaded, r.rows_rejected, r.rows_duplicate) for r in m] == [(8, 2, 4, 2)]
    assert sorted(r.reason for r in read_rejects(spark, paths, feed).collect()) == [
        "order_date out of range", "order_date out of range", "quantity not positive", "unknown product_id"]
    assert [str(r.full_date) for r in read_dim_date(spark, paths).orderBy("full_date").collect()] == [
        "2019-01-02", "2019-01-03"]


def test_a_crash_in_the_first_batch_does_not_block_the_load(spark, dims, feed, paths):
    """What a stopped first batch leaves: task files, and whole files without a
    manifest row."""
    stage_files(_tx(spark, range(10)), paths.source)
    fact_stream._prepare(spark, paths, fact_stream.loaded_schema(feed, TransactionKey()))
    left = os.path.join(paths.loaded, "batch_id=0", "_temporary", "0", "task_0")
    os.makedirs(left)
    open(os.path.join(left, "part-00000.parquet"), "w").close()
    rows = spark.createDataFrame([(3, "3")], "key long, order_id string")
    rows.write.parquet(os.path.join(paths.loaded, "batch_id=0", "route=fact", "sale_month=201901"))
    assert _loaded(spark, paths, feed) == []
    _run(spark, paths, feed, dims)
    assert [k for k, _ in _loaded(spark, paths, feed)] == list(range(10))


def test_a_replayed_batch_replaces_itself(spark, dims, feed, paths):
    schema = fact_stream.loaded_schema(feed, TransactionKey())
    fact_stream._prepare(spark, paths, schema)
    write = make_batch_writer(spark, paths, schema, TransactionKey(), *dims, *RANGE)
    write(_tx(spark, range(5)), 0)
    write(_tx(spark, range(3, 8)), 1)
    once = sorted(map(tuple, read_loaded(spark, paths, schema).collect()), key=repr)
    write(_tx(spark, range(3, 8)), 1)  # stopped after the commit, before the engine wrote it down
    assert sorted(map(tuple, read_loaded(spark, paths, schema).collect()), key=repr) == once
    write(_tx(spark, range(5)), 0)
    assert [k for k, _ in _loaded(spark, paths, feed)] == list(range(8))
    assert read_manifest(spark, paths).agg(F.sum("rows_loaded")).first()[0] == 8


def test_a_stopped_batch_runs_again(spark, dims, feed, paths, monkeypatch):
    """The stream stops between the data and the manifest, and starts again."""
    stage_files(_tx(spark, range(20)), paths.source)
    real = fact_stream.make_batch_writer

    def stops(*a):
        write = real(*a)

        def batch(df, n):
            write(df, n)
            raise RuntimeError("stopped")
        return batch

    monkeypatch.setattr(fact_stream, "make_batch_writer", stops)
    with pytest.raises(Exception, match="stopped"):
        _run(spark, paths, feed, dims)
    monkeypatch.setattr(fact_stream, "make_batch_writer", real)
    _run(spark, paths, feed, dims)
    assert [k for k, _ in _loaded(spark, paths, feed)] == list(range(20))
    assert read_manifest(spark, paths).agg(F.sum("rows_in")).first()[0] == 20


def test_a_hot_day_comes_in_several_bounded_batches(spark, dims, feed, paths):
    stage_files(_tx(spark, range(600), day=dt.date(2020, 2, 2)).coalesce(1), paths.source, records_per_file=100)
    m = _run(spark, paths, feed, dims, bytes_per_trigger=1)
    assert len(m) >= 6 and max(r.rows_in for r in m) <= 100
    assert read_fact(spark, paths, feed).count() == 600


@pytest.fixture
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_metrics_of_more_than_a_hundred_batches(spark, dims, feed, paths, one_partition):
    schema = fact_stream.loaded_schema(feed, TransactionKey())
    fact_stream._prepare(spark, paths, schema)
    cust, prod = (d.coalesce(1).checkpoint() for d in dims)
    write = make_batch_writer(spark, paths, schema, TransactionKey("order_id", dated=True), cust, prod, *RANGE)
    for n in range(103):
        write(_tx(spark, [n], day=dt.date(2019 + n % 6, 1 + n % 12, 3)).coalesce(1), n)
    m = read_manifest(spark, paths)
    assert m.count() == 103 and m.agg(F.sum("rows_in"), F.sum("rows_loaded")).first() == (103, 103)
    assert read_fact(spark, paths, feed).count() == 103


def test_ids_chain_over_batches(spark, dims, feed, paths, monkeypatch):
    """Rows of equal hash in one month get the next places of its chain."""
    from sparkmart.operators.surrogate import sale_base
    monkeypatch.setattr(fact_stream, "sale_base", lambda: sale_base(hashes=2))
    for ids in (range(6), range(4, 12), range(12, 14)):
        stage_files(_tx(spark, ids, day=dt.date(2020, 2, 2)), paths.source)
        _run(spark, paths, feed, dims)
    found = [r.sale_id for r in read_fact(spark, paths, feed).select("sale_id").collect()]
    assert len(found) == len(set(found)) == 14
    assert {i % 256 for i in found} == set(range(max(i % 256 for i in found) + 1))


def test_micro_batch_query_returns_the_fact_from_a_fixed_number_of_batches(spark, tmp_path, monkeypatch):
    from conftest import write_tables
    from sparkmart.plans import q_streaming as Q
    lines = [(o, f"199{6 + o % 3}-0{1 + o % 9}-1{o % 10}", (o * 7 + k) % 30, 1 + k, o % 12)
             for o in range(400) for k in range(2)]
    folder = write_tables(spark, tmp_path, lines)
    bounds = []
    run = Q.run_fact_stream
    monkeypatch.setattr(Q, "run_fact_stream", lambda *a, **k: bounds.append((a[1], k)) or run(*a, **k))
    got = Q.stream_micro_batch(spark, folder)
    assert got.columns == Q.FACT_COLS
    assert sorted((r.order_id, r.product_id, r.quantity) for r in got.collect()) == \
        sorted((str(o), p, q) for o, _, p, q, c in lines if c < 10)
    from sparkmart.streaming.fact_stream import read_manifest
    n = read_manifest(spark, bounds[0][0]).count()
    assert 1 < n <= 2 * Q.MICRO_BATCHES + 2



def test_rows_without_an_id_are_no_group_of_their_own(spark, dims):
    """a re-delivery's duplicates were one key of the join with the known chains."""
    tx = _tx(spark, range(2000)).withColumn("route", F.when(F.col("order_id") < 1500, "duplicate").otherwise("fact"))
    known = fact_stream.with_chain_ids(tx.where("route = 'fact'"), spark.createDataFrame([], "sale_id long"), "order_id")
    known = known.select("sale_id").localCheckpoint()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = fact_stream.with_chain_ids(tx, known, "order_id").withColumn("task", F.spark_partition_id())
        rows = out.select("task", "route", "sale_id").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    tasks = {}
    for r in rows:
        tasks[r.task] = tasks.get(r.task, 0) + (r.route == "duplicate")
        assert (r.sale_id is None) == (r.route == "duplicate")
    assert len(rows) == 2000 and len(tasks) > 1 and max(tasks.values()) < 1500
    first = {r.sale_id for r in known.collect()}  # each fact takes the next place of its chain
    assert {r.sale_id for r in rows if r.sale_id is not None} == {x + 1 for x in first} and len(first) == 500


def test_staging_counts_its_tasks_from_the_rows(spark, monkeypatch, paths):
    monkeypatch.setattr(fact_stream, "RECORDS_PER_FILE", 10)
    stage_files(_tx(spark, range(400)), paths.source, 1000, 400)
    staged = spark.read.parquet(paths.source)
    assert staged.count() == 400 and len(staged.inputFiles()) > 16
