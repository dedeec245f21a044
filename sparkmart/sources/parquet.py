"""The star as Parquet: the ETL's sink and the reports' source.

The fact is partitioned by ``sale_year``; ``read_fact`` keeps that column and turns a
range of dates into a partition filter as well. Tables are written and read with
the schemas of ``sparkmart.schemas``: values are cast, a NULL in a NOT NULL column
stops the write.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import schemas as S
from sparkmart.sources.testdata import Star

DIMENSIONS = {"dim_product": S.DIM_PRODUCT, "dim_store": S.DIM_STORE, "dim_customer": S.DIM_CUSTOMER,
              "dim_date": S.DIM_DATE}
STORED_FACT = T.StructType([*S.FACT_SALES.fields, T.StructField("sale_year", T.IntegerType())])


def conform(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """The columns of ``schema``, cast to its types. A column that may be NULL may
    be missing; a NULL where the schema has none is an error when it is met."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            if not f.nullable:
                raise ValueError(f"{table} has no column {f.name}")
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{table}.{f.name} is NULL")).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def write_fact(fact: DataFrame, root: str, mode: str = "append") -> None:
    (conform(fact, S.FACT_SALES, "fact_sales").withColumn("sale_year", F.year("order_date"))
     .write.mode(mode).partitionBy("sale_year").parquet(os.path.join(root, "fact_sales")))


def read_fact(spark: SparkSession, root: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The fact with ``sale_year``, or its rows of a range of dates (both ends
    included): only the years of the range are read."""
    f = spark.read.schema(STORED_FACT).parquet(os.path.join(root, "fact_sales"))
    for edge, holds in ((date_from, "__ge__"), (date_to, "__le__")):
        if edge is not None:
            d = F.lit(edge).cast("date")
            f = f.filter(getattr(F.col("sale_year"), holds)(F.year(d)) & getattr(F.col("order_date"), holds)(d))
    return f


def write_star(star: Star, root: str, mode: str = "overwrite") -> None:
    """Full refresh of the dimensions; the fact is written by ``write_fact``."""
    for name, schema in DIMENSIONS.items():
        conform(getattr(star, name), schema, name).write.mode(mode).parquet(os.path.join(root, name))
    write_fact(star.fact, root, mode)


def read_star(spark: SparkSession, root: str, date_from: str | None = None, date_to: str | None = None) -> Star:
    dims = {n: spark.read.schema(s).parquet(os.path.join(root, n)) for n, s in DIMENSIONS.items()}
    return Star(fact=read_fact(spark, root, date_from, date_to), **dims)
