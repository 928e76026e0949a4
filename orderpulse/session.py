"""Session defaults and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else each put and each removal reads the row first, only to count rows.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

_local_base: dict[str, str] = {}


def build_session(app: str = "orderpulse", master: str | None = None,
                  **conf: str) -> SparkSession:
    """Session with the defaults of this library; keyword ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to a session made elsewhere.

    On a local master an untouched shuffle width of 200 only adds empty tasks
    and state stores, so it follows the core count; a cluster keeps its own.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in DEFAULTS.items():
        if "stateStore" in key:
            spark.conf.set(key, value)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions",
                       str(spark.sparkContext.defaultParallelism))
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local master may run without the setting; a machine-local folder on
    a cluster would be lost with the executor that wrote it.
    """
    base = (spark.conf.get(CHECKPOINT_CONF, None)
            or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None))
    if base:
        return base.rstrip("/")
    if not is_local(spark):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="orderpulse-")
    return _local_base[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
