"""JDBC connector for dimension reads and batched fact writes.

Reads are split into parallel range partitions on a numeric key, so no
single connection pulls a whole table; writes go out in batches of
``batchsize`` rows per task. The driver jar must be on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FACT_INSERT_BATCH = 1000  # rows per JDBC batch, as the reference loader


def read_table(spark: SparkSession, url: str, table: str, props: dict[str, str],
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int = 8) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower)).option("upperBound", str(upper))
             .option("numPartitions", str(num_partitions)))
    return r.load()


def append_table(df: DataFrame, url: str, table: str, props: dict[str, str],
                 batchsize: int = FACT_INSERT_BATCH) -> None:
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batchsize)).mode("append"))
    for k, v in props.items():
        w = w.option(k, v)
    w.save()
