"""Session helpers: a local session for tests and benches, and scratch space.

Scratch space always lives under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``).  Only when a session has none (a bare local test
session) do we create one, as the job must never fall back to a machine-local
folder on a real cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "lakestrata", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session.  A local session that has none gets a private
    folder; on a cluster that is an error, as its machines share no folder
    made here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir isn't set: name a folder that all machines share")
    root = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, never reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/lakestrata/{name}-{uuid.uuid4().hex}"


# Runtime SQL settings for large inputs: AQE sizes shuffle partitions from
# measured map output (start high, coalesce down), splits skewed join and
# rebalance partitions, and broadcasts only sides measured to be small.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "32",
}


def tune_for_scale(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply ``SCALE_CONF`` (and overrides) to a running session."""
    for k, v in {**SCALE_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)
