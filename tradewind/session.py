"""Session settings the warehouse relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# The keyed-state operators need a state store with several column families.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that can change on a running session. Sizes (shuffle partitions, memory) stay the
# cluster's business: adaptive execution coalesces small partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key takes its last value instead of spoiling the line.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # A join keeps one store per partition instead of four; no lookup only to count the rows of a store;
    # a batch uploads its changes, packed well, instead of all files it wrote (``sinks.start`` turns that off
    # for runs of one large batch); blocks large enough to pack well. A checkpoint keeps the join format it
    # began with.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}

# Settings a session has to start with: no call-site lookup for every column expression.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **START_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A session of one machine may leave it unset and gets a temporary one; on a cluster that would be a
    folder of the driver's alone, so it is refused.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tradewind-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")
