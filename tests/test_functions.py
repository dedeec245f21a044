"""Scalar functions: date standardizer (T1, T2), calendar (T10), ratios."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sparkmart.functions import growth_pct, round2, season, standardize_date
from sparkmart.functions.dates import is_weekend, minutes_between


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_t1_accepted_layouts(spark):
    vals = ["03/04/2019 10:05", "05/13/2019 10:05", "1/2/2019 9:05", "2019-01-05",
            "2019-01-05 13:45:10", "01/02/2019 10:05:59", "2019-1-5"]
    got = _one(spark, standardize_date, vals)
    exp = ["2019-04-03", "2019-05-13", "2019-02-01", "2019-01-05", "2019-01-05", "2019-02-01", "2019-01-05"]
    assert got == [dt.date.fromisoformat(e) for e in exp]


def test_t2_rejected_dates(spark):
    vals = ["31/02/2019 10:00", "03/04/2019", "", "   ", "garbage", "2019-02-30", None]
    assert _one(spark, standardize_date, vals) == [None] * len(vals)


def test_t10_weekend(spark):
    got = _one(spark, is_weekend, [dt.date(2019, 1, 5), dt.date(2019, 1, 6), dt.date(2019, 1, 7)], "date")
    assert got == [True, True, False]


def test_season_and_growth(spark):
    months = [dt.date(2019, m, 1) for m in (12, 1, 2, 3, 6, 9)]
    assert _one(spark, season, months, "date") == ["Winter", "Winter", "Winter", "Spring", "Summer", "Fall"]
    df = spark.createDataFrame([(Decimal("150"), Decimal("100")), (Decimal("1"), Decimal("0")),
                                (Decimal("1"), None)], "c decimal(10,2), p decimal(10,2)")
    got = [r[0] for r in df.select(growth_pct("c", "p")).collect()]
    assert got == [Decimal("50.00"), None, None]  # T14: previous 0 -> NULL, no error


def test_round2_half_up(spark):
    df = spark.createDataFrame([(2.345,), (-1.005,), (0.125,)], "x double")
    got = [r[0] for r in df.select(round2("x")).collect()]
    assert got == [Decimal("2.35"), Decimal("-1.01"), Decimal("0.13")]


def test_minutes_between_truncates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 10, 40, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minutes_between("a", "b")).first()[0] == 40
    assert df.select(minutes_between("b", "a")).first()[0] == 40
