"""Query registry: key -> (spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables. The SQL, when present, is the same computation written for an
independent engine over the raw test tables; queries whose result is not
SQL-expressible (stream runs, generated keys) register ``sql=None``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    fn: QueryFn
    sql: str | None
    section: str


REGISTRY: dict[str, Entry] = {}


def register(key: str, sql: str | None, section: str):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql, section)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    """Import every module that registers queries."""
    from sparkmart.plans import (  # noqa: F401
        q_etl, q_operators, q_reports, q_streaming,
    )
    return REGISTRY
