"""SparkSession construction and the shared checkpoint folder.

Reports are plain DataFrame plans; the session only pins the settings the
plans rely on: UTC session time zone (dates are compared as calendar dates),
adaptive execution with skew-join splitting and runtime broadcast conversion
(size-checked by ``spark.sql.autoBroadcastJoinThreshold``), and no UI server.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PySpark call-site capture costs several JVM round trips per DataFrame call
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # remove checkpoint files once the checkpointed DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every report assumes."""
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
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20,
               shuffle_fraction: float = 0.25, most_per_core: int | None = None) -> dict[str, str]:
    """Settings for a cluster run, sized from the bytes the reports scan.

    Shuffle partitions: one per ``partition_bytes`` of the expected largest
    shuffle (``shuffle_fraction`` of the input: window filters, column
    pruning and partial aggregation run before it), at least 2 per core and
    at most ``most_per_core`` if that is given; adaptive execution coalesces
    them to ~128 MB. Scan splits are ``partition_bytes``; a shuffle partition
    5x the median and over 512 MB is split by the skew-join handling.
    Example: 100 TiB scanned gives 102,400 shuffle partitions.
    """
    parts = max(2 * cores, -(-int(input_bytes * shuffle_fraction) // partition_bytes))
    if most_per_core is not None:
        parts = min(parts, most_per_core * cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
    used as is. Only on a ``local`` master, where the driver is the only
    executor, is a private folder made when it is unset.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or _local_folders.get(context.applicationId)
    if not current:
        if not is_local(context.master):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        current = _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="marketlens-ckpt-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


_local_folders: dict[str, str] = {}


def is_local(master: str) -> bool:
    """Whether executors run in the driver's process (local, local[n]; not local-cluster)."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{os.getpid()}-{os.urandom(4).hex()}"
