"""sale_id: unique, the same on every run, chained on equal hashes."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.surrogate import CHAIN, HASHES, with_sale_id

SCHEMA = "order_id long, line_number int, order_date date, product_id long, customer_id long, quantity int"


def _rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.randint(1, n), rng.randint(1, 3), dt.date(2020, rng.randint(1, 3), 5), rng.randint(1, 9), 1,
             rng.randint(1, 3)) for _ in range(n)]


def _plain(rows, hashes=HASHES):
    """(row, id) by lists."""
    chains: dict[int, list] = {}
    for r in rows:
        h = int(hashlib.md5("|".join(map(str, r)).encode()).hexdigest()[:10], 16) % hashes
        chains.setdefault(((r[2].year * 12 + r[2].month) * HASHES + h) * CHAIN, []).append(r)
    return sorted((base + i, r) for base, c in chains.items() for i, r in enumerate(sorted(c)))


def _got(df):
    return sorted((r.sale_id, tuple(r)[:-1]) for r in df.collect())


@pytest.mark.parametrize("hashes", [HASHES, 4])
def test_ids_against_lists(spark, hashes):
    rows = _rows(300)
    got = _got(with_sale_id(spark.createDataFrame(rows, SCHEMA).repartition(3), hashes=hashes))
    assert got == _plain(rows, hashes) and len({i for i, _ in got}) == 300


def test_the_order_and_layout_of_rows_do_not_matter(spark):
    rows = _rows(200, seed=4)
    one = _got(with_sale_id(spark.createDataFrame(rows, SCHEMA), hashes=8))
    assert _got(with_sale_id(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5), hashes=8)) == one


def test_a_full_chain_stops_and_null_dates_have_no_id(spark):
    rows = [(1, 1, dt.date(2020, 1, 1), 1, 1, 1)] * (CHAIN + 1)
    with pytest.raises(Exception, match="chain of sale ids is full"):
        with_sale_id(spark.createDataFrame(rows, SCHEMA)).collect()
    no_date = with_sale_id(spark.createDataFrame([(1, 1, None, 1, 1, 1)], SCHEMA))
    assert no_date.filter(F.col("sale_id").isNull()).count() == 1
