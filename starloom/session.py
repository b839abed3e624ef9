"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the semantics depend on. They are session-scoped and
# safe to set on a session someone else built.
SEMANTIC_CONF = {
    # Strict casts: a bad INTEGER / TIMESTAMP text fails the statement.
    "spark.sql.ansi.enabled": "true",
    # JSON objects with a repeated key keep the last value (JSONB rule).
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Event times carry no zone (TIMESTAMP_NTZ). Some built-ins (date_format,
    # hour) go through the session zone; in UTC that round trip is the
    # identity, while a DST zone would shift the wall-clock times of the
    # skipped spring-forward hour.
    "spark.sql.session.timeZone": "UTC",
    # Key indexes are found by their folders, not by partitions that a catalog keeps.
    "spark.sql.hive.manageFilesourcePartitions": "false",
}

# Execution settings: runtime re-planning, skew splitting, runtime-checked
# broadcast of small join sides.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # MIN / MAX / COUNT of stored layers from Parquet footers.
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _local_heap() -> str:
    """Driver heap for local runs: 60 % of the machine's memory, at most 8 GB."""
    try:
        with open("/proc/meminfo") as fh:
            kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal:"))
        return f"{max(1024, min(8192, int(kb * 0.6 / 1024)))}m"
    except (OSError, StopIteration, ValueError):
        return "4g"


def build_session(master: str | None = "local[8]", app: str = "starloom", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A session for tests and local runs (UI off, UTC, AQE). With
    ``master=None`` the master, memory and partition settings are those of the launcher
    (spark-submit, a cluster's defaults) and only the settings that results
    depend on are added."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.driver.memory", _local_heap())
        )
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove reliable checkpoints once nothing references them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**SEMANTIC_CONF, **EXECUTION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in a local session (tests, a
    laptop) a folder under the system temp dir is set once for this session.
    On a cluster an unset folder is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        path = tempfile.mkdtemp(prefix="starloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared folder."""
    return os.path.join(shared_dir(spark), "starloom", f"{name}-{uuid.uuid4().hex[:12]}")


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input:
    scan splits and shuffle partitions of about ``target_partition_bytes``
    (so a task's data fits in executor memory without spilling much), AQE
    coalescing toward the same size, and skew splitting above 4x that.
    Apply with ``spark.conf.set`` before building plans; the shuffle
    partition count is also the key-bucket count of ``operators.keys``, so
    keep it fixed for a warehouse's lifetime of loads."""
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 8),
    }
