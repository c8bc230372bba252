"""Raw app logs to start, page and display topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shopstream import names
from shopstream.functions.times import sortable
from shopstream.operators import logs
from shopstream.operators.rejects import accepted, quarantined, rejected_records
from shopstream.session import run_dir, stage
from shopstream.sinks.topics import stream_records, write_records
from shopstream.sources.topics import FolderTopics, KafkaTopics, read_topic
from shopstream.streaming import devices

QUARANTINE = "quarantine"


def run_logs(
    spark: SparkSession, source: FolderTopics | KafkaTopics, target: FolderTopics | KafkaTopics, run: str = "logs",
    scratch: str | None = None,
) -> DataFrame:
    """One batch over all raw logs; returns the rejected ones.

    The parsed logs are staged as a table first, in a new folder of this run:
    repairing the flag reads them more than once, and text is slow to read.
    """
    raw = read_topic(spark, source, names.ODS_LOG)
    parsed = stage(logs.parse_log(raw), f"{run_dir(spark, scratch)}/{run}")
    write_records(logs.log_records(logs.repair_is_new(accepted(parsed))), target)
    return quarantined(parsed)


def start_logs(
    spark: SparkSession, source: FolderTopics | KafkaTopics, target: FolderTopics | KafkaTopics,
    checkpoint: str, once: bool = False, shards: int = devices.SHARDS,
) -> StreamingQuery:
    """The log job as one stream: repair, then every output, the rejected logs among them."""
    parsed = logs.parse_log(sortable(read_topic(spark, source, names.ODS_LOG, streaming=True)))
    records = devices.repaired_records(accepted(parsed), shards)
    records = records.unionByName(rejected_records(parsed, names.ODS_LOG))
    return stream_records(records, target, checkpoint, once, "logs")


def start_quarantine(
    spark: SparkSession, source: FolderTopics | KafkaTopics, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Keeps the raw logs the log job cannot use, with the reason."""
    rejected = quarantined(logs.parse_log(read_topic(spark, source, names.ODS_LOG, streaming=True)))
    writer = rejected.writeStream.option("checkpointLocation", checkpoint).format("parquet").queryName(QUARANTINE)
    return (writer.trigger(availableNow=True) if once else writer).start(path)
