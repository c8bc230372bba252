"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings the jobs count on. Partition counts are left to the cluster and AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of the state would read each key before it is written.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app_name: str = "shopstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session (same context, own SQL settings) for stateful streams."""
    session = spark.newSession()
    for key, value in DEFAULTS.items():
        session.conf.set(key, value)
    zone = spark.conf.get("spark.sql.session.timeZone")
    session.conf.set("spark.sql.session.timeZone", zone)
    if partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def shared_dir(spark: SparkSession, given: str | None = None) -> str:
    """A folder all executors can reach: the one given, or else the one the cluster names.

    Where neither is set, a session on this machine alone takes a temporary folder.
    """
    folder = given or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.partition("[")[0] == "local":
        folder = tempfile.gettempdir()
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set and no folder was given")
    return folder.rstrip("/")


def run_dir(spark: SparkSession, given: str | None = None) -> str:
    """A new folder below the shared one, so that no two runs ever meet."""
    return f"{shared_dir(spark, given)}/run-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage in a way that outlives lost executors, and spares the
    readers that follow a second parse of the raw text.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
