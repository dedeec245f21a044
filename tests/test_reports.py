"""Report semantics on hand-made stars: T11-T13, T15-T22."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import make_star
from sparkmart.operators.affinity import event_type_affinity, pair_frequency, product_affinity
from sparkmart.plans import reports as R

P = {i: (f"P{i}", 10.0, 1, "Sup", 1) for i in range(1, 10)}


def test_t11_rank_ties_kept(spark):
    sales = [(i, "2019-01-07", i, 1) for i in range(1, 7)]  # six products, equal revenue, weekday
    out = R.q01_top_products_by_day_type(make_star(spark, sales, P)).collect()
    assert len(out) == 6 and {r.day_type for r in out} == {"Weekday"}


def test_t12_lag_over_a_gap(spark):
    sales = [(1, "2019-02-01", 1, 10), (2, "2019-08-01", 1, 15)]
    out = {r.quarter: r for r in R.q02_store_quarter_growth(make_star(spark, sales, P), year=2019).collect()}
    assert out[1].prev_quarter_revenue is None
    assert out[3].prev_quarter_revenue == Decimal("100.00")
    assert out[3].growth_rate_percentage == Decimal("50.00")


def test_t13_supplier_id_with_two_names(spark):
    prods = {1: ("A", 10.0, 42, "Loom House", 1), 2: ("B", 10.0, 42, "Loom Street", 1)}
    sales = [(1, "2019-01-10", 1, 1), (2, "2019-01-10", 2, 5), (3, "2019-02-10", 1, 2),
             (4, "2019-02-10", 2, 7)]
    out = {(r.supplier_name, r.sales_month): r for r in
           R.q05_monthly_volatility(make_star(spark, sales, prods)).collect()}
    assert out[("Loom House", "2019-02")].prev_month_revenue == Decimal("10.00")
    assert out[("Loom Street", "2019-02")].prev_month_revenue == Decimal("50.00")


def test_t15_t16_population_stddev_and_single_day(spark):
    prods = {1: ("A", 1.0, 1, "S", 1), 2: ("B", 1.0, 1, "S", 1)}
    sales = [(1, "2019-01-01", 1, 1), (2, "2019-01-02", 1, 2), (3, "2019-01-03", 1, 4),
             (4, "2019-01-01", 2, 3)]
    s = R.daily_product_stats(make_star(spark, sales, prods))
    sd = s.select("product_id", (F.sqrt((F.col("sumsq") * F.col("n") - F.col("total") ** 2)
                                        .cast("double")) / F.col("n")).alias("sd")).distinct()
    got = {r.product_id: r.sd for r in sd.collect()}
    assert math.isclose(got[1], 1.247219128924647, rel_tol=1e-12)
    assert got[2] == 0.0
    spikes = R.q09_revenue_spikes(make_star(spark, sales, prods)).collect()
    assert spikes == []  # 4 > 2*7/3 is false; single-day product never spikes
    allrows = {(r.product_name, str(r.order_date)): r
               for r in R.q09_revenue_spikes(make_star(spark, sales, prods), only_high=False).collect()}
    assert allrows[("B", "2019-01-01")].z_score is None
    assert allrows[("A", "2019-01-01")].sales_pattern == "Low Spike"
    assert allrows[("A", "2019-01-02")].sales_pattern == "Normal"


def test_t17_t18_rollup_levels_and_distinct(spark):
    prods = {1: ("A", 10.0, 1, "S1", 1), 2: ("B", 10.0, 2, "S2", 1)}
    sales = [(1, "2019-03-01", 1, 1), (1, "2019-03-01", 2, 1)]  # one order, two suppliers
    out = R.q07_revenue_rollup(make_star(spark, sales, prods)).collect()
    assert len(out) == 7
    by = {(r.year, r.store_name, r.supplier_name, r.product_name): r for r in out}
    assert by[("Total", "All Stores", "All Suppliers", "All Products")].number_of_orders == 1
    assert by[("2019", "Store A", "All Suppliers", "All Products")].number_of_orders == 1
    assert len(R.q07_revenue_rollup(make_star(spark, sales, prods), include_grand_total=False).collect()) == 6


def test_t19_same_name_two_ids(spark):
    prods = {1: ("Same", 10.0, 1, "S", 1), 2: ("Same", 20.0, 1, "S", 1)}
    sales = [(1, "2019-03-01", 1, 1), (2, "2019-03-02", 2, 1)]
    st = make_star(spark, sales, prods)
    assert len(R.q08_half_year(st).collect()) == 1
    assert len(R.q04_seasonal_sales(st).collect()) == 2


def test_t20_t21_affinity(spark):
    prods = {1: ("A", 10.0, 1, "S", 1), 2: ("B", 10.0, 1, "S", 1)}
    sales = [(1, "2019-01-07", 1, 1), (2, "2019-01-07", 2, 1), (3, "2019-01-07", 1, 1),
             (4, "2019-01-07", 2, 1), (5, "2019-01-08", 1, 1), (5, "2019-01-08", 2, 1)]
    out = product_affinity(make_star(spark, sales, prods).fact,
                           make_star(spark, sales, prods).dim_product).collect()
    assert len(out) == 1
    assert (out[0].product1, out[0].product2, out[0].times_together) == ("A", "B", 4)
    assert out[0].pct_of_total == Decimal("66.67")   # 4 * 100 / 6 fact rows


@pytest.mark.parametrize("block_items", [1, 2048])
def test_pair_frequency_salted_equals_plain(spark, block_items):
    rows = spark.createDataFrame([(b, i, g) for b in range(3) for i in range(12) for g in range(i % 3 + 1)],
                                 "b int, i long, g int")
    a = {(r.i1, r.i2): r.freq for r in pair_frequency(rows, "b", "i", "g", block_items=block_items).collect()}
    # brute force over row pairs
    rs = rows.collect()
    exp = {}
    for x in rs:
        for y in rs:
            if x.b == y.b and x.g != y.g and x.i < y.i:
                exp[(x.i, y.i)] = exp.get((x.i, y.i), 0) + 1
    assert a == exp


def test_pair_frequency_long_ids_and_nulls(spark):
    a, b = 2**31 + 1, 2**33 + 5
    rows = spark.createDataFrame([(1, a, 1), (1, b, 2), (1, a, None), (None, b, 3), (1, None, 4)],
                                 "b int, i long, g int")
    assert [tuple(r) for r in pair_frequency(rows, "b", "i", "g").collect()] == [(a, b, 1)]


def test_t22_hour_bucket_events(spark):
    import datetime as dt
    ev = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 10, 5, 0), 1, "A", 0.0, ""),
         (2, dt.datetime(2024, 1, 1, 10, 40, 30), 2, "B", 0.0, ""),
         (3, dt.datetime(2024, 1, 1, 11, 1, 0), 3, "C", 0.0, ""),
         (4, dt.datetime(2024, 1, 1, 10, 50, 0), 1, "B", 0.0, ""),
         (5, dt.datetime(2024, 1, 1, 10, 59, 0), 4, "A", 0.0, "")],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    out = {(r.type1, r.type2): r for r in event_type_affinity(ev, min_freq=1).collect()}
    # A@10:05(u1) pairs B@10:40(u2); A@10:59(u4) pairs B@10:40(u2), B@10:50(u1): 3 pairs, min 9 min
    assert set(out) == {("A", "B")}
    assert out[("A", "B")].times_together == 3
    assert out[("A", "B")].min_minutes_apart == 9


def test_rank_within_groups_matches_window(spark):
    from pyspark.sql import Window
    from sparkmart.operators.ordering import rank_within_groups
    rows = [(g, v % 7) for g in range(3) for v in range(40 * (g + 1))]
    df = spark.createDataFrame(rows, "g int, v int")
    got = sorted(tuple(r) for r in rank_within_groups(df, ["g"], [F.desc("v")], num_partitions=5)
                 .select("g", "v", "rank").collect())
    exp = sorted(tuple(r) for r in df.withColumn(
        "rank", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))).collect())
    assert got == exp


def test_rank_within_groups_keeps_null_groups(spark):
    from sparkmart.operators.ordering import rank_within_groups
    df = spark.createDataFrame([(None, 5), (None, 7), (1, 3)], "g int, v int")
    got = {(r.g, r.v, r["rank"]) for r in rank_within_groups(df, ["g"], ["v"], num_partitions=3).collect()}
    assert got == {(None, 5, 1), (None, 7, 2), (1, 3, 1)}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_event_gap_across_partitions_brute_force(spark, parts):
    import datetime as dt
    import random
    from sparkmart.operators import affinity as A
    rnd = random.Random(parts)
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(i, base + dt.timedelta(seconds=rnd.randrange(0, 3 * 3600)), rnd.randrange(3),
             rnd.choice("ABC"), 0.0, "") for i in range(120)]
    ev = spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {(r.type1, r.type2): (r.times_together, r.min_minutes_apart)
               for r in A.event_type_affinity(ev, min_freq=1, top_n=10).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    exp = {}
    for a in rows:
        for b in rows:
            if a[3] < b[3] and a[2] != b[2] and a[1].replace(minute=0, second=0) == b[1].replace(minute=0, second=0):
                d = int(abs((b[1] - a[1]).total_seconds()) // 60)
                c, m = exp.get((a[3], b[3]), (0, None))
                exp[(a[3], b[3])] = (c + 1, d if m is None else min(m, d))
    assert got == exp


def test_any_number_of_event_types(spark):
    """Seventy types, hot minutes, equal times, null users and types."""
    import datetime as dt
    import random
    rnd = random.Random(70)
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(i, base + dt.timedelta(seconds=rnd.choice([7, 65, 3000, rnd.randrange(0, 7200)])),
             rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, *[f"t{k:02d}" for k in range(70)]])) for i in range(900)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    got = {(r.type1, r.type2): (r.times_together, r.min_minutes_apart)
           for r in event_type_affinity(ev, min_freq=1, top_n=5000).collect()}
    exp = {}
    for _, t1, u1, a in rows:
        for _, t2, u2, b in rows:
            if None not in (u1, u2, a, b) and a < b and u1 != u2 and t1.replace(minute=0, second=0) == \
                    t2.replace(minute=0, second=0):
                d = int(abs((t2 - t1).total_seconds()) // 60)
                c, m = exp.get((a, b), (0, d))
                exp[(a, b)] = (c + 1, min(m, d))
    assert len(exp) > 2000 and got == exp


@pytest.mark.parametrize("skew", [0.0, 1.5])
def test_partner_counts_match_the_theta_join(spark, skew):
    import random
    from sparkmart.operators.affinity import partner_counts
    rnd = random.Random(3)
    items = list(range(30))
    rows = [(rnd.randrange(4), rnd.choices(items, [1 / (k + 1) ** skew for k in items])[0], rnd.randrange(60))
            for _ in range(400)] + [(None, 1, 1), (1, None, 1), (1, 1, None)]
    exp = {}
    for b1, i1, g1 in rows:
        for b2, i2, g2 in rows:
            if None not in (b1, i1, g1, i2, g2) and b1 == b2 and g1 != g2 and i1 < i2:
                exp[i1] = exp.get(i1, 0) + 1
    got = partner_counts(spark.createDataFrame(rows, "b int, i int, g int"), "b", "i", "g")
    assert {r.i: r.matches for r in got.collect()} == exp


@pytest.mark.parametrize("prune_share,seed_items", [(1.0, 3), (1.0, 50), (0.0, 3), (1.0, 1)])
def test_top_pair_frequency_matches_brute_force(spark, prune_share, seed_items):
    import random
    from sparkmart.operators.affinity import top_pair_frequency
    rnd = random.Random(7)
    items = list(range(40))
    weights = [1.0 / (k + 1) ** 1.2 for k in items]       # skewed popularity
    rows = []
    for order in range(400):
        b = rnd.randrange(12)
        for it in set(rnd.choices(items, weights, k=rnd.randint(1, 4))):
            for _ in range(rnd.choice([1, 1, 1, 2])):
                rows.append((b, it, order))
    df = spark.createDataFrame(rows, "b int, i long, g int")
    exp = {}
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[2] != y[2] and x[1] < y[1]:
                exp[(x[1], y[1])] = exp.get((x[1], y[1]), 0) + 1
    top = sorted(((-f, p) for p, f in exp.items() if f >= 2))[:5]
    got = top_pair_frequency(df, "b", "i", "g", 5, min_freq=2, seed_items=seed_items,
                             prune_share=prune_share, skew_ratio=1.0).collect()
    got_top = sorted((-r.freq, (r.i1, r.i2)) for r in got)[:5]
    assert got_top == top
    assert all(exp[(r.i1, r.i2)] == r.freq for r in got)


def test_product_affinity_prunes_on_skewed_sales(spark):
    import random
    from sparkmart.operators import affinity as A
    rnd = random.Random(11)
    prods = {i: (f"P{i}", 10.0, 1, "S", 1) for i in range(1, 61)}
    weights = [1.0 / k ** 1.5 for k in range(1, 61)]
    sales, oid = [], 0
    for day in range(1, 29):
        for _ in range(30):
            oid += 1
            for p in set(rnd.choices(range(1, 61), weights, k=rnd.randint(1, 3))):
                sales.append((oid, f"2019-02-{day:02d}", p, 1))
    st = make_star(spark, sales, prods)
    got = [(r.product1, r.product2, r.times_together) for r in
           product_affinity(st.fact, st.dim_product).collect()]
    assert A.LAST_PLAN["plan"] == "pruned"
    exp = {}
    for a in sales:
        for b in sales:
            if a[1] == b[1] and a[0] != b[0] and a[2] < b[2]:
                exp[(a[2], b[2])] = exp.get((a[2], b[2]), 0) + 1
    top = sorted(((-f, i, j) for (i, j), f in exp.items() if f >= 2))[:5]
    assert got == [(f"P{i}", f"P{j}", -f) for f, i, j in top]


def _own_pairs(spark, folder):
    from conftest import write_tables
    # product p is bought in p + 1 orders of one day: all pairs have frequencies of their own
    lines, order = [], 0
    for p in range(12):
        for _ in range(p + 1):
            order += 1
            lines.append((order, "1997-03-01", p, 1, 1))
    exp = {(p, q): (p + 1) * (q + 1) for p in range(12) for q in range(p + 1, 12)}
    return write_tables(spark, folder, lines), exp


def test_filter_agg_threshold_returns_every_pair_over_the_threshold(spark, tmp_path):
    from sparkmart.plans.registry import load_all
    folder, exp = _own_pairs(spark, tmp_path)
    got = load_all()["filter_agg_threshold"].fn(spark, folder).collect()
    assert {(r.product1_id, r.product2_id): r.purchase_frequency for r in got} == {k: v for k, v in exp.items() if v > 1}


def test_self_join_theta_returns_every_pair(spark, tmp_path):
    from sparkmart.plans.registry import load_all
    folder, exp = _own_pairs(spark, tmp_path)
    got = load_all()["self_join_theta"].fn(spark, folder).collect()
    assert {(r.product1_id, r.product2_id): r.purchase_frequency for r in got} == exp


@pytest.mark.parametrize("kind", ["long", "string"])
def test_pairs_are_counted_in_tiles_and_not_shuffled(spark, kind):
    import random
    from sparkmart.operators import affinity as A
    rnd = random.Random(5)
    name = (lambda i: f"item {i:02d}") if kind == "string" else int
    rows = [(rnd.randrange(6), name(rnd.randrange(40)), rnd.randrange(50)) for _ in range(500)]
    df = spark.createDataFrame(rows, f"b int, i {kind}, g int")
    exp = {}
    for b1, i1, g1 in rows:
        for b2, i2, g2 in rows:
            if b1 == b2 and g1 != g2 and i1 < i2:
                exp[i1, i2] = exp.get((i1, i2), 0) + 1
    out = A.pair_frequency(df, "b", "i", "g", block_items=7, min_freq=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(i1" not in plan and "hashpartitioning(a" in plan
    assert {(r.i1, r.i2): r.freq for r in out.collect()} == {k: v for k, v in exp.items() if v >= 2}
    top = A.pair_frequency(df, "b", "i", "g", block_items=7, top_n=3).collect()
    assert sorted((r.freq for r in top), reverse=True)[:3] == sorted(exp.values(), reverse=True)[:3]
    assert len(top) < len(exp) and all(exp[r.i1, r.i2] == r.freq for r in top)


def _brute_force(rows):
    exp = {}
    for b1, i1, g1 in rows:
        for b2, i2, g2 in rows:
            if None not in (b1, i1, g1, b2, i2, g2) and b1 == b2 and g1 != g2 and i1 < i2:
                exp[i1, i2] = exp.get((i1, i2), 0) + 1
    return exp


@pytest.mark.parametrize("cells,blocks", [(1_000_000, 1), (40, 3)])
def test_even_sales_are_pruned_by_norms_or_counted_in_tiles(spark, monkeypatch, cells, blocks):
    """with even popularity nothing was pruned, and each count was shuffled once for every block."""
    import random
    from sparkmart.operators import affinity as A
    monkeypatch.setattr(A, "BLOCK_CELLS", cells)
    rnd = random.Random(3)
    # 0 and 1 are bought together each day, as often as others are bought alone; some share an order
    rows = [(d, i, 10 * d + i % 4) for d in range(20) for i in (0, 1)]
    rows += [(rnd.randrange(20), i, rnd.randrange(200)) for i in range(2, 12) for _ in range(8)]
    rows += [(1, None, 1), (None, 1, 1), (1, 1, None)]
    df = spark.createDataFrame(rows, "b int, i int, g int")
    exp = _brute_force(rows)
    for top_n in (1, 5):
        got = sorted((-r.freq, r.i1, r.i2) for r in A.top_pair_frequency(df, "b", "i", "g", top_n).collect())
        assert got[:top_n] == sorted((-f, *p) for p, f in exp.items() if f > 1)[:top_n]
        assert A.LAST_PLAN["plan"] == "enumerate"
        if top_n == 1:  # 20 days together; others sell 8 times, so 8 * 20 is below the square of 20
            assert A.LAST_PLAN["tau"] == 20 and A.LAST_PLAN["items_kept"] == 2
        else:
            assert A.LAST_PLAN["items_kept"] == 12 and A.LAST_PLAN["blocks"] == blocks


@pytest.mark.parametrize("key,least", [("self_join_theta", 1), ("filter_agg_threshold", 2)])
def test_blocks_of_counts_are_read_by_each_tile_and_not_copied(spark, tmp_path, monkeypatch, key, least):
    """each count was shuffled once for every block, so what was written grew with their number."""
    import random
    from conftest import write_tables
    from sparkmart.operators import affinity as A
    from sparkmart.plans.registry import load_all
    monkeypatch.setattr(A, "BLOCK_CELLS", 25)
    rnd = random.Random(9)
    lines = [(o, f"1997-03-0{1 + o % 4}", rnd.randrange(30), 1, 1) for o in range(60) for _ in range(rnd.randrange(1, 5))]
    lines += [(100 + k % 7, "1997-03-01", 3 + 2 * (k % 2), 1, 1) for k in range(80)]  # rows of one day by the dozen
    out = load_all()[key].fn(spark, write_tables(spark, tmp_path, lines))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate explode" not in plan
    exp = {k: v for k, v in _brute_force([(d, p, o) for o, d, p, _, _ in lines]).items() if v >= least}
    got = {(r.product1_id, r.product2_id): r.purchase_frequency for r in out.collect()}
    assert got == exp and len(exp) > 100


def test_product_affinity_counts_all_rows_and_skips_null_days(spark):
    sales = [(o, "2019-01-07", 1 + o % 2, 1) for o in range(6)]
    st = make_star(spark, sales, P)
    lost = st.fact.withColumn("order_date", F.lit(None).cast("date")).limit(4)
    out = product_affinity(st.fact.unionByName(lost), st.dim_product).collect()
    assert [(r.product1, r.product2, r.times_together, r.pct_of_total) for r in out] == [("P1", "P2", 9, Decimal("90.00"))]
    assert product_affinity(st.fact.limit(0), st.dim_product).collect() == []


def test_tasks_of_a_large_fact_are_counted_from_its_rows(spark, tmp_path, monkeypatch):
    from conftest import write_tables
    from sparkmart.plans.registry import load_all
    from sparkmart.sources import testdata as T
    lines = [(o, f"1997-0{1 + o % 9}-11", o % 30, 1 + o % 4, 1) for o in range(200)]
    folder = write_tables(spark, tmp_path, lines)
    keys = ("q05_monthly_volatility", "win_stddev_partition", "filter_on_window", "rollup_labels")
    plain = {k: sorted(map(str, load_all()[k].fn(spark, folder).collect())) for k in keys}
    monkeypatch.setattr(T, "ROWS_PER_TASK", 10)
    assert T.star(spark, folder).fact.rdd.getNumPartitions() == 20
    for k in keys:
        df = load_all()[k].fn(spark, folder)
        assert "hashpartitioning(product_id" in df._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")[0]
        assert sorted(map(str, df.collect())) == plain[k] and plain[k]


def test_lines_meet_their_orders_in_tasks_counted_from_rows(spark, tmp_path, monkeypatch):
    """F12 to F14, F19: this join ran in as many tasks as the session has shuffle partitions."""
    from conftest import write_tables
    from sparkmart.sources import testdata as T
    folder = write_tables(spark, tmp_path, [(o, f"1997-0{1 + o % 9}-11", o % 30, 1 + o % 4, 1) for o in range(200)])
    plain = sorted(map(str, T.transactions(spark, folder).collect()))
    monkeypatch.setattr(T, "ROWS_PER_TASK", 10)
    tx = T.transactions(spark, folder)
    assert tx.rdd.getNumPartitions() == 20 and sorted(map(str, tx.collect())) == plain
