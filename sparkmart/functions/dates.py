"""Date and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four accepted input layouts, tried in this order, first
# success wins (day-first before month-first; ISO date before ISO date-time).
#   1. dd/MM/yyyy HH:mm   2. MM/dd/yyyy HH:mm   3. yyyy-MM-dd   4. yyyy-MM-dd HH:mm:ss
# A layout matches a leading prefix of the text, so layout 3 also takes every
# ISO date-time and layout 4 is never reached. One-digit fields are accepted.
_SLASH_PREFIX = r"^(\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2})"
_ISO_PREFIX = r"^(\d{4}-\d{1,2}-\d{1,2})"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_date(text: Column | str) -> Column:
    """Multi-layout text -> DATE; NULL when no layout fits (row is rejected).

    The matching prefix is cut with a regex, then parsed strictly; ``d``/``M``
    accept one- and two-digit fields.
    """
    t = F.trim(_c(text))
    slash = F.regexp_extract(t, _SLASH_PREFIX, 1)
    iso = F.regexp_extract(t, _ISO_PREFIX, 1)
    slash = F.when(slash != "", slash)
    iso = F.when(iso != "", iso)
    return F.coalesce(
        F.try_to_timestamp(slash, F.lit("d/M/yyyy H:m")),
        F.try_to_timestamp(slash, F.lit("M/d/yyyy H:m")),
        F.try_to_timestamp(iso, F.lit("yyyy-M-d")),
    ).cast("date")


def date_key(d: Column | str) -> Column:
    """Deterministic date surrogate key yyyymmdd (no global counter)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(d: Column | str) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(d))


def is_weekend(d: Column | str) -> Column:
    return day_of_week(d).isin(1, 7)


def month_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "EEEE")


def year_month(d: Column | str) -> Column:
    """'YYYY-MM' text, as DATE_FORMAT(d, '%Y-%m')."""
    return F.date_format(_c(d), "yyyy-MM")


def season(d: Column | str) -> Column:
    """3-5 Spring, 6-8 Summer, 9-11 Fall, else Winter (years merged)."""
    m = F.month(_c(d))
    return (F.when(m.isin(3, 4, 5), "Spring")
            .when(m.isin(6, 7, 8), "Summer")
            .when(m.isin(9, 10, 11), "Fall")
            .otherwise("Winter"))


def season_order(s: Column | str) -> Column:
    """Simple CASE without ELSE: unknown season -> NULL."""
    s = _c(s)
    return (F.when(s == "Spring", 1).when(s == "Summer", 2)
            .when(s == "Fall", 3).when(s == "Winter", 4))


def half_year(d: Column | str) -> Column:
    return F.when(F.month(_c(d)) <= 6, "H1").otherwise("H2")


def hour_bucket(ts: Column | str) -> Column:
    """Calendar hour of a timestamp (same day and same hour)."""
    return F.date_trunc("hour", _c(ts))


def minutes_between(a: Column | str, b: Column | str) -> Column:
    """ABS(TIMESTAMPDIFF(MINUTE, a, b)): whole minutes, truncated."""
    return F.abs(F.timestamp_diff("MINUTE", _c(a), _c(b)))


def calendar_columns(d: Column | str) -> list[Column]:
    """The DIM_DATE attribute columns of one date."""
    d = _c(d)
    return [
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    ]
