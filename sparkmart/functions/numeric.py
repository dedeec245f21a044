"""Numeric expressions: money, rounding, NULL-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"        # unit price, as the DDL
MONEY_SUM = "decimal(38,2)"    # every reported amount and rounded ratio


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _c(c).cast(MONEY_SUM)


def round2(c: Column | str) -> Column:
    """ROUND(x, 2) with a fixed decimal result type.

    Doubles go through decimal(28,8) first so that half-up rounding acts on
    the same decimal digits in every engine.
    """
    c = _c(c)
    return F.round(c.cast("decimal(28,8)"), 2).cast(MONEY_SUM)


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE; NULL when den is NULL or 0 (never an error)."""
    num, den = _c(num), _c(den)
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def growth_pct(cur: Column | str, prev: Column | str) -> Column:
    """(cur - prev) / prev * 100 rounded to 2; NULL when prev is NULL or 0."""
    cur, prev = _c(cur), _c(prev)
    return F.when(prev.isNull() | (prev == 0), F.lit(None)).otherwise(
        round2(safe_divide(cur - prev, prev) * 100))


def volatility_pct(cur: Column | str, prev: Column | str) -> Column:
    cur, prev = _c(cur), _c(prev)
    return F.when(prev.isNull() | (prev == 0), F.lit(None)).otherwise(
        round2(F.abs(safe_divide(cur - prev, prev) * 100)))


def zscore(x: Column | str, mean: Column | str, std: Column | str) -> Column:
    """(x - mean) / std; NULL when std is 0 or NULL."""
    x, mean, std = _c(x), _c(mean), _c(std)
    return round2(safe_divide(x.cast("double") - mean.cast("double"), std))


def deviation_pct(x: Column | str, mean: Column | str) -> Column:
    """(x / mean - 1) * 100."""
    return round2((safe_divide(x, mean) - 1) * 100)


def spike_label(daily: Column | str, total: Column | str, n: Column | str) -> Column:
    """> 2 x mean 'High Spike', < 0.5 x mean 'Low Spike', else 'Normal'.

    The mean is total / n; thresholds are compared exactly by cross-multiplying
    (daily * n > 2 * total), so rows at exactly twice the mean never flip.
    """
    daily, total, n = _c(daily), _c(total), _c(n)
    return (F.when(daily * n > total * 2, "High Spike")
            .when(daily * n * 2 < total, "Low Spike")
            .otherwise("Normal"))


def parse_int(text: Column | str) -> Column:
    """Integer.parseInt after trim: an optional sign and digits only, within
    int range; anything else (including '17.0') is NULL and the row rejected."""
    t = F.trim(_c(text))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int"))


def parse_long(text: Column | str) -> Column:
    """As ``parse_int``, within the range of a long; ids are read with it."""
    t = F.trim(_c(text))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))


def parse_price(text: Column | str) -> Column:
    """'1299.99$' -> 1299.99 as decimal(10,2); NULL when unparsable."""
    t = F.regexp_replace(F.trim(_c(text)), r"[\$\"]", "")
    return t.try_cast(MONEY)
