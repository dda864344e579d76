"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# State stores outside the heap, with small commits.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings that matter for large inputs. Nothing here fixes a partition count:
# AQE coalesces small shuffle partitions and splits skewed ones, and every join
# is left to the size-checked broadcast threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    **STATE_SETTINGS,
}


def build_session(app: str = "oreflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def only_absent(error: AnalysisException) -> None:
    """Passes where the error says that nothing is stored there yet; any other error goes on."""
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error


def state_session(spark: SparkSession, stores: int | None = None) -> SparkSession:
    """A session for streams that keep state, on the same context.

    The number of state stores is fixed by the first run of a checkpoint and AQE
    does not apply, so it is stated: ``stores``, or the session's shuffle
    partitions. It never follows the cores that happen to be there. State lives in
    RocksDB, outside the heap.
    """
    session = spark.newSession()
    zone = "spark.sql.session.timeZone"
    session.conf.set(zone, spark.conf.get(zone))
    session.conf.set("spark.sql.shuffle.partitions", str(stores or spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in STATE_SETTINGS.items():
        session.conf.set(key, value)
    return session


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path (not created) under the session's shared folder.

    The cluster names the folder in ``spark.checkpoint.dir``. Where that is unset,
    the warehouse, which executors share as well, holds it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
