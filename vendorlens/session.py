"""Session construction and the shared checkpoint location.

On a cluster the session comes from the platform; ``spark.checkpoint.dir`` names a
shared folder. We read it from the session and only fall back to a scratch folder
when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings that matter for every operator in this package.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Local runs only (the driver JVM is the whole cluster there); ignored when a session exists.
LOCAL_CONF = {"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": "8"}

# Cluster runs (100 TB class inputs): start shuffles wide and let AQE coalesce them to
# ~128 MB partitions; split skewed join partitions; read files in 256 MB splits.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "vendorlens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    elif master:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Uses ``spark.checkpoint.dir``, which a cluster must name: executors can't see a folder of
    the driver's machine. Only a local master gets a fresh scratch folder where it is unset.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.environ.get("VENDORLENS_SCRATCH", tempfile.gettempdir())
        d = tempfile.mkdtemp(prefix="vendorlens-ckpt-", dir=base)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def stored(df, name: str = "step"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used for a derived frame that several later steps read: the upstream joins run a single
    time, a lost executor re-reads files instead of re-running the chain, and the scan keeps column
    pruning, filter pushdown and size statistics, which a ``checkpoint()`` lacks.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
