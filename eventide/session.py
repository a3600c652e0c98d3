"""Session helpers.

The library never builds a cluster session on its own: production jobs pass
in the session their platform gives them.  ``local_session`` exists for
tests, the bench and the examples.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  They are SQL confs, so they
# can be applied to an existing session at runtime.
RUNTIME_CONF = {
    # Event-time arithmetic and formatted timestamps are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch join strategy from real sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Suggested settings for inputs of tens of TB and up (runtime-settable SQL
# confs).  Partitions are sized by bytes, and AQE coalesces the many initial
# shuffle partitions down to ~256 MB each and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}

STATE_STORE_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def use_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def apply_scale_conf(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Apply ``SCALE_CONF`` (plus ``overrides``) to a cluster session, keeping
    any value the platform already set explicitly."""
    use_runtime_conf(spark)
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in SCALE_CONF.items():
        if key not in explicit:
            spark.conf.set(key, value)
    for key, value in (overrides or {}).items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "eventide") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("EVENTIDE_DRIVER_MEMORY", "6g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Order of preference: the cluster's ``spark.checkpoint.dir`` (the shared
    folder the platform names), then a checkpoint dir already set on the
    SparkContext.  When neither is set we pick one and register it so later
    calls agree: a temporary folder only in local mode (tests, laptops); on a
    cluster a folder under the SQL warehouse, which lives on the shared
    filesystem, never a machine-local path.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        # ``spark.checkpoint.dir`` is a core conf and cannot be changed at
        # runtime; the context's checkpoint dir can.
        if sc.master.startswith("local"):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="eventide-ckpt-"))
        else:
            warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
            sc.setCheckpointDir(f"{warehouse}/_eventide_checkpoints")
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one job run."""
    root = checkpoint_root(spark)
    return f"{root}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
