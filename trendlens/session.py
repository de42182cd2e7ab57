"""SparkSession helpers shared by the library, tests and bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (running counts of every distinct word or text) lives
    # off-heap in RocksDB with changelog checkpoints instead of JVM hash maps
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "trendlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULT_CONF, **(conf or {})}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    checkpoint_root(spark)
    return spark


def local_master(master: str | None) -> bool:
    """True where driver and executors are one process and so share local folders."""
    return bool(master) and (master == "local" or master.startswith("local["))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, snapshots and stream checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names, with its
    scheme (a folder every executor can reach).  Only a local session, where
    driver and executors are one process, may leave the setting out: a private
    scratch folder is made and registered.  Elsewhere a missing setting is an
    error, since executors would write to disks that the others cannot see.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not local_master(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="trendlens-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/trendlens/{name}-{uuid.uuid4().hex}"


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 128 * 1024 ** 2) -> dict[str, str]:
    """Settings that keep every task's share of the data to about ``target_partition_bytes``.

    Scan splits and shuffle partitions are sized from the input (word and
    posting shuffles are a fraction of the text, so the input size bounds
    them); there are at least two tasks per core so stragglers overlap, and
    AQE coalesces small partitions and splits skewed ones at run time.
    """
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
