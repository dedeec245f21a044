"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import gc
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import scratch_path

#: Rows of an Arrow batch. Whole texts travel in them, in the JVM and in a Python
#: worker at a time, so the default of 10,000 rows has no useful bound in bytes.
ARROW_ROWS = 1000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    This cuts lineage: a lost executor costs a re-read, not a re-computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a
    cluster, where it is installed, this changes nothing), and keep Arrow batches
    of texts small."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(column: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


@contextlib.contextmanager
def uncollected():
    """No garbage collection meanwhile: a worker's memos are large and hold no
    cycles. Workers are used again, so what was on before is on afterwards."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()
