"""Session settings shared by every job and test."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Time zone: every bucket/format
# function is defined in UTC; ANSI stays on (operators use try_* forms).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "delaycast", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench: UI off, AQE on, UTC."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared checkpoint directory.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="delaycast-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    base = base.rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back from there."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run sized from the input volume.

    Shuffle partitions start at ~input / target (at least 2x the cores, so
    every core has work and a straggler is small); AQE then coalesces small
    ones to the advisory size and splits skewed ones. Scan splits match the
    target so one task's input fits comfortably in executor memory.
    E.g. 100 TB on 8,000 cores -> ~400k initial partitions, 256 MB each.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def rocksdb_state_conf() -> dict:
    """State store for large stream state: RocksDB (off-heap, spills to local
    disk, incremental changelog checkpoints to the checkpoint location).
    Set before the first start of a query; the provider is then fixed in its
    checkpoint. Locally the default in-memory provider is as fast."""
    return {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
