"""Session settings for cluster runs, and the shared folder for written steps."""

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITION_BYTES = 128 * 1024 * 1024
UNKNOWN_BYTES = 2**60

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
}


def build_session(app_name: str = "curfew", hive: bool = False, **extra: str) -> SparkSession:
    """A session with these settings; ``hive`` keeps tables in a Hive metastore."""
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, scanned: DataFrame | None = None) -> int:
    """Set the number of reduce tasks: one per 128 MB scanned, and at least as many as
    configured. Adaptive execution merges what turns out small, but splits a
    shuffle no further, so the number must suit the largest one. The cores that
    are there at the start do not count: more may come."""
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if scanned is not None:
        size = int(scanned._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        if size < UNKNOWN_BYTES:
            count = max(count, -(-size // PARTITION_BYTES))
        else:
            logging.getLogger(__name__).warning("size of the scan is unknown; %d reduce tasks", count)
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for stateful streams beside a batch session.

    A stream keeps one state store per shuffle partition, and their number is
    fixed with its checkpoint, unlike a batch's, which merges as it runs. Give
    it by the size the state will have; otherwise the configured one is kept.
    """
    own = spark.newSession()
    for key, value in {
        "spark.sql.shuffle.partitions": str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions")),
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
    }.items():
        own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the one the cluster names in spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="curfew-")
    return f"{root.rstrip('/')}/curfew/{uuid.uuid4().hex}"
