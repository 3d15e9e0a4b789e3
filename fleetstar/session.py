"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (event timestamps are UTC),
# adaptive execution for runtime re-planning, skew splitting and partition
# coalescing. ANSI mode stays on (Spark default) so bad casts fail loudly.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of DataFrames that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fleetstar", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` so one
    shuffle partition holds roughly 128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if is_local_master(spark.sparkContext.master):
        checkpoint_base(spark)
    return spark


def cluster_settings(input_bytes: float, executor_cores: int = 4, target_partition_mb: int = 256) -> dict:
    """Sizing for a cluster run over ``input_bytes`` of fact data.

    File splits of 256 MB keep scan tasks in the seconds range; the initial
    shuffle partition count gives ~256 MB per reducer for a shuffle of the
    full input (adaptive execution then coalesces small shuffles and splits
    skewed partitions). Broadcasts stay bounded by the row-count checks.
    """
    target = target_partition_mb * 1024 * 1024
    partitions = int(min(max(input_bytes / target, 200), 500_000))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.executor.cores": str(executor_cores),
    }


def checkpoint_base(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in a local session.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only ``local[*]`` without it (tests, a laptop) gets a fresh
    temporary folder; anywhere else a missing setting raises, because a
    machine-local folder would not be seen by the other machines.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(sc.master):
            raise ValueError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="fleetstar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def is_local_master(master: str) -> bool:
    """True for ``local`` and ``local[...]``, which run in one process on one machine."""
    return master == "local" or master.startswith("local[")


def app_id(spark: SparkSession) -> str:
    """Identity of the running application (changes when a session is rebuilt)."""
    return spark.conf.get("spark.app.id", "") or spark.conf.get("spark.app.name", "")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    import uuid

    base = checkpoint_base(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
