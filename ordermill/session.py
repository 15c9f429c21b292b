"""Session defaults and the shared scratch location.

Library code never starts a session of its own for a caller; ``local_session``
exists for tests, the bench and the CLI.  Scratch data (CSV round trips,
stream checkpoints, published tables) always lives under the directory the
cluster names in ``spark.checkpoint.dir``; only when that is unset (tests,
a laptop) do we create one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Options that matter at any scale: AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes, and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# A starting profile for ~100 TB on ~1000 executors (pass to the cluster's
# session builder; library code never sets these itself).  Shuffles start
# wide and AQE coalesces them to ~256 MB partitions, so no reduce task holds
# more than it can sort in memory; scans split at 512 MB; skewed join
# partitions above 5x the median are split; partitioned writes rebalance.
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}

# Context-level settings (fixed when the cluster session starts): reliable
# checkpoints of multi-pass inputs are removed once no DataFrame refers to
# them, so the shared checkpoint folder does not grow run after run.
CLUSTER_CORE_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ordermill",
                  extra: dict | None = None, hive: bool = False) -> SparkSession:
    """A local session for tests / bench / CLI.  UI off, UTC, AQE on.

    ``hive=True`` asks for a Hive metastore catalog (needs Hive classes on
    the classpath); the default in-memory catalog serves everything here.
    """
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ORDERMILL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ordermill-wh-"))
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if hive:
        b = b.enableHiveSupport()
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of this session.

    A local session without one gets a temporary folder; anywhere else that
    would be some machine's own disk, so an unset directory is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context here
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None:
        root = root or sc.getConf().get("spark.checkpoint.dir", None)
        if not root and re.fullmatch(r"local(\[.*\])?", sc.master):
            root = tempfile.mkdtemp(prefix="ordermill-ckpt-")
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc is not None:
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/ordermill/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut the lineage of a multi-pass input: a reliable checkpoint under the
    shared ``spark.checkpoint.dir`` (never a local checkpoint), so later
    passes and recomputed stages read it instead of re-running its plan."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
