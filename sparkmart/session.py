"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package wants. AQE re-plans joins and
# coalesces partitions at runtime; skew-join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (about 100 TB of input, ~1000 executors). The
# initial shuffle width is large and AQE coalesces small partitions and
# splits skewed ones at run time; scan splits stay near 512 MB.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def get_spark(master: str | None = None, app: str = "sparkmart",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster, ``master`` stays None and the launcher decides;
    ``cluster=True`` adds ``CLUSTER_CONF``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names this folder; it is only set here when it is unset
    on a ``local`` master, and then to a fresh temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sparkmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "sparkmart", f"{name}-{uuid.uuid4().hex[:12]}")
