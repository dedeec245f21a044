"""Every registered query against its DuckDB oracle on the smoke data."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from sparkmart.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"
SLOW = {"stream_micro_batch", "stream_dim_join", "stream_incremental_dedupe", "stream_resume",
        "stream_date_get_or_create", "stream_validate_route", "stream_metrics"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
          "boolean": "BOOLEAN", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def _type(t: str) -> str:
    return t.upper() if t.startswith("decimal") else _TYPES.get(t, t)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="smoke data absent")
@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if k not in SLOW))
def test_oracle_parity(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    stypes = {f.name: _type(f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sale_year", "sale_month", "day_type", "product_name", "total_revenue"]
