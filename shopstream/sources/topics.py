"""Topics: named sequences of text records, in Kafka or in a folder.

Either way a record is ``value`` (its text) and ``arrival`` (its position): a
number in a folder, and in Kafka the record's time, partition and offset, so that
records of several partitions have one order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.functions.times import position


@dataclass(frozen=True)
class FolderTopics:
    """Topics as Parquet folders ``<root>/writer=<w>/topic=<name>/batch=<b>``; for stores without a broker.

    Every writer has a folder of its own, so any number of jobs and streams can
    share a root. Readers open the folders of their own topic only. Files of one
    batch have no order among them: a stream that depends on the order of arrival
    must take whole batches, so set its files per trigger above those of a batch.
    """

    root: str
    # Files taken per micro-batch; bounds what a stateful task sees at once.
    max_files_per_trigger: int = 1000


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a Kafka cluster; needs Spark's Kafka package on the class path."""

    brokers: str
    group_id: str | None = None
    starting_offsets: str = "latest"
    # Records taken per micro-batch; bounds what a stateful task sees at once.
    max_offsets_per_trigger: int = 5_000_000
    # Fixed value: transactions of the per-record sink stay open this long.
    transaction_timeout_ms: int = 15 * 60 * 1000


def kafka_read_options(store: KafkaTopics, topic: str, streaming: bool) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": store.brokers, "subscribe": topic}
    if store.group_id:
        options["kafka.group.id"] = store.group_id
    if streaming:
        options["startingOffsets"] = store.starting_offsets
        options["maxOffsetsPerTrigger"] = str(store.max_offsets_per_trigger)
    return options


def kafka_records(records: DataFrame) -> DataFrame:
    """Rows as Kafka's source gives them, as ``value`` and ``arrival``."""
    place = position(F.unix_millis("timestamp"), F.col("partition"), F.col("offset"))
    return records.select(F.col("value").cast("string").alias("value"), place.alias("arrival"))


def read_topic(spark: SparkSession, store: FolderTopics | KafkaTopics, topic: str, streaming: bool = False) -> DataFrame:
    """The records of ``topic``: ``value`` and ``arrival``, a BIGINT in a folder, a ``schemas.POSITION`` in Kafka."""
    reader = spark.readStream if streaming else spark.read
    if isinstance(store, KafkaTopics):
        records = reader.format("kafka").options(**kafka_read_options(store, topic, streaming)).load()
        return kafka_records(records)
    if streaming:
        reader = reader.option("maxFilesPerTrigger", store.max_files_per_trigger)
    records = reader.schema(schemas.TOPIC).option("basePath", store.root)
    try:
        return records.parquet(f"{store.root}/writer=*/topic={topic}").select("value", "arrival")
    except AnalysisException as error:
        if streaming or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.TOPIC)  # nobody has written to it yet


def read_topics(spark: SparkSession, store: FolderTopics) -> DataFrame:
    """The records of all topics of a folder store: ``topic STRING, value STRING, arrival BIGINT``."""
    return spark.read.schema(schemas.TOPIC + ", topic STRING").parquet(store.root).select("topic", "value", "arrival")


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Text files, one record a line, e.g. collector logs.

    ``arrival`` follows the lines of each file; files have no order among them.
    A stream has no line numbers and gives ``value`` alone.
    """
    if streaming:
        return spark.readStream.text(path).select("value")
    return spark.read.text(path).select("value", F.monotonically_increasing_id().alias("arrival"))
