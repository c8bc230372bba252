"""Writing topics, fact records and raw logs."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstream import names
from shopstream.functions.fields import is_blank, to_json_line
from shopstream.sources.topics import FolderTopics, KafkaTopics

# Fixed value: how often the streams checkpoint.
TRIGGER = "5 seconds"


def kafka_write_options(store: KafkaTopics) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": store.brokers,
        "kafka.transaction.timeout.ms": str(store.transaction_timeout_ms),
    }


def topic_records(df: DataFrame, topic: str) -> DataFrame:
    """Rows with ``value`` (or any columns, as JSON) addressed to one topic."""
    value = F.col("value") if "value" in df.columns else to_json_line(F.struct(*df.columns))
    arrival = F.col("arrival") if "arrival" in df.columns else F.lit(None).cast("bigint")
    return df.select(F.lit(topic).alias("topic"), value.alias("value"), arrival.alias("arrival"))


def fact_records(facts: DataFrame) -> DataFrame:
    """Routed fact rows: topic per record, ``data`` alone as the payload."""
    topic = F.when(is_blank(F.col("sink_table")), F.lit(names.DEFAULT_TOPIC)).otherwise(F.col("sink_table"))
    arrival = F.col("arrival") if "arrival" in facts.columns else F.lit(None).cast("bigint")
    return facts.select(
        topic.alias("topic"), to_json_line(F.col("data"), "map").alias("value"), arrival.alias("arrival")
    )


def write_records(
    records: DataFrame, store: FolderTopics | KafkaTopics, batch_id: int | None = None, writer: str | None = None,
) -> None:
    """Write (topic, value, arrival) rows of a batch, each to its own topic.

    In a folder store, what a ``writer`` writes again under the same ``batch_id``
    replaces the batch in every topic it had rows in. Without a batch id the rows
    are added. In Kafka a batch written again is there twice: at least once. Of a
    position over partitions a folder keeps the time.
    """
    if isinstance(store, KafkaTopics):
        records.select("topic", "value").write.format("kafka").options(**kafka_write_options(store)).save()
        return
    kind = records.schema["arrival"].dataType.typeName()
    if kind in ("struct", "string"):
        time = F.col("arrival.time") if kind == "struct" else F.regexp_extract("arrival", r"^(\d{19})-", 1).try_cast("bigint")
        records = records.withColumn("arrival", time)
    again = batch_id is not None
    folder = f"{store.root}/writer={writer or 'batch'}" if again else f"{store.root}/writer={uuid.uuid4().hex}"
    # One task per topic and share of its rows, not a file for each task and topic.
    spread = records.hint("rebalance", "topic").withColumn("batch", F.lit(int(batch_id) if again else 0))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch").parquet(folder)


def writer_of(name: str, checkpoint: str) -> str:
    """A stream's own folder: its batch numbers belong to its checkpoint, so the checkpoint is part of the name."""
    return f"{name}-{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}"


def stream_records(
    records: DataFrame, store: FolderTopics | KafkaTopics, checkpoint: str, once: bool = False, name: str | None = None
) -> StreamingQuery:
    """Start a stream that writes (topic, value, arrival) rows, each to its own topic.

    ``once`` takes what is there and ends; otherwise the stream runs on. In a
    folder store a batch that is run again replaces itself, whatever else writes there.
    """
    writer = records.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    if name:
        writer = writer.queryName(name)
    if isinstance(store, KafkaTopics):
        return writer.format("kafka").options(**kafka_write_options(store)).start()
    own = writer_of(name or "stream", checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_records(batch, store, batch_id, own)

    return writer.foreachBatch(write).start()


def write_topic(
    df: DataFrame, store: FolderTopics | KafkaTopics, topic: str, checkpoint: str | None = None, once: bool = False
) -> StreamingQuery | None:
    """Write ``df`` to one topic; a streaming ``df`` starts a query."""
    records = topic_records(df, topic)
    if df.isStreaming:
        return stream_records(records, store, checkpoint, once, topic)
    return write_records(records, store)


def write_facts(
    facts: DataFrame, store: FolderTopics | KafkaTopics, batch_id: int | None = None,
    checkpoint: str | None = None, once: bool = False, writer: str = "facts",
) -> StreamingQuery | None:
    """Write routed fact rows, each to the topic its rule names."""
    if facts.isStreaming:
        return stream_records(fact_records(facts), store, checkpoint, once, writer)
    return write_records(fact_records(facts), store, batch_id, writer)


def land_raw_log(
    raw: DataFrame, path: str, received: str | None = None, checkpoint: str | None = None, once: bool = False
) -> StreamingQuery | None:
    """Append raw lines to text folders by day, ``<path>/dt=<day>``.

    The day is that of the ``received`` column, or the current day.
    """
    at = F.col(received) if received else F.current_timestamp()
    lines = raw.select("value", F.date_format(at, "yyyy-MM-dd").alias("dt"))
    if not raw.isStreaming:
        return lines.write.mode("append").partitionBy("dt").text(path)
    writer = lines.writeStream.option("checkpointLocation", checkpoint).partitionBy("dt").format("text")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    return writer.start(path)
