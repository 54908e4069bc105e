"""Session defaults and shared-folder helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so text timestamps and windows do not depend on the
# machine, ANSI kept on (bad casts go through try_cast / try_to_timestamp on purpose),
# adaptive execution to size shuffles and pick join strategies from runtime statistics.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each micro-batch uploads the state changes, not a full snapshot of every store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "flotilla",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    return spark


# Input bytes for each shuffle partition: a dedup ships nearly all its rows.
PARTITION_BYTES = 128 << 20


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """The size of files and folders in any store Spark reaches; what isn't there has none."""
    total, conf = 0, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def shuffle_width(n_bytes: int, least: int = 8) -> int:
    """Shuffle partitions for so much input. AQE merges small ones; it never makes more."""
    return max(least, -(-n_bytes // PARTITION_BYTES))


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set the SQL defaults, the state store's too, on a session someone else built (the
    driver's, a test's). Settings that a running session can't change are left as they are."""
    for key, value in SESSION_DEFAULTS.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; fails when it names none.

    Whatever executors must see of each other's work lies there: landed inputs, tables read
    back, stream state. A folder of this machine would not do on a cluster, so none is made up.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the checkpoint root, fresh per call when ``unique``."""
    leaf = "/".join(parts)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}"
    return f"{checkpoint_root(spark)}/flotilla/{leaf}"
