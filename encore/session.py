"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "encore",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution, skew-join splitting and UTC time.

    On a cluster call it without ``master`` (the launcher decides) and pass
    ``extra=cluster_conf(cores, expected_shuffle_bytes)`` so that shuffle
    partitions are sized to the data; locally a small fixed count is enough.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.checkpoint.compress": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(total_cores: int, shuffle_bytes: float, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, to pass as ``build_session(extra=...)``.

    The initial shuffle partition count follows the expected shuffle volume
    (about ``partition_bytes`` per partition, never fewer than two per core);
    adaptive execution then coalesces small partitions back to the advisory
    size and splits skewed ones. For 100 TB of shuffle input this starts at
    about 400,000 partitions of 256 MB, each of which fits in executor memory.
    """
    initial = max(2 * total_cores, int(shuffle_bytes // partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``; only when nothing is set
    (local tests) a private folder is created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a session without a local SparkContext (Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="encore-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/encore-scratch/{name}-{uuid.uuid4().hex}"


def default_parallelism(spark: SparkSession) -> int:
    """Cores the cluster offers (the reference multiplied executors by cores)."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no local SparkContext: fall back to the session's settings
        return max(1, int(spark.conf.get("spark.default.parallelism", spark.conf.get("spark.sql.shuffle.partitions"))))
