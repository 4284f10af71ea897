"""Session settings and the shared scratch folder used by jobs that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app_name: str = "cartlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine defaults; anything passed in ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: instants are read and truncated in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """Sibling session for a streaming query.

    State lives on disk (RocksDB), so it may outgrow executor memory. The number of
    state partitions is fixed for the life of a checkpoint, hence it is set here and
    not taken from whatever the caller's batch settings happen to be.
    """
    session = spark.newSession()
    for key, value in ENGINE_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    if state_partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. A machine-local folder is
    used only when that is unset and Spark itself runs inside one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "cartlake")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(spark: SparkSession, df):
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))
    return df.checkpoint()
