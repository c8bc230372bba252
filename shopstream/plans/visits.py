"""Page logs to unique visits and bounces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shopstream import names
from shopstream.functions.times import sortable
from shopstream.operators import visits
from shopstream.operators.logs import parse_log
from shopstream.operators.rejects import accepted, quarantined, rejected_records
from shopstream.session import run_dir, stage
from shopstream.sinks.topics import stream_records, write_topic
from shopstream.sources.topics import FolderTopics, KafkaTopics, read_topic
from shopstream.streaming import devices

Store = FolderTopics | KafkaTopics


def page_logs(spark: SparkSession, source: Store, streaming: bool = False) -> DataFrame:
    """Parsed page logs; unusable ones carry a ``reject_reason``."""
    records = read_topic(spark, source, names.PAGE_LOG, streaming)
    return parse_log(sortable(records) if streaming else records)


def run_visits(
    spark: SparkSession, source: Store, target: Store, run: str = "visits", mode: str = "exact", complete: bool = True,
    scratch: str | None = None,
) -> DataFrame:
    """Unique visits and bounces of all page logs, in one batch; returns the rejected ones.

    Both look at the pages more than once, so the parsed pages are staged as a
    table first, in a new folder of this run.
    """
    parsed = stage(page_logs(spark, source), f"{run_dir(spark, scratch)}/{run}")
    pages = accepted(parsed)
    write_topic(visits.unique_visit(pages, mode, scratch=scratch), target, names.UNIQUE_VISIT)
    write_topic(visits.jump_detail(pages, complete=complete, scratch=scratch), target, names.USER_JUMP)
    return quarantined(parsed)


def start_unique_visit(
    spark: SparkSession, source: Store, target: Store, checkpoint: str, mode: str = "exact",
    ttl: bool = True, delay: str = "1 day", once: bool = False, shards: int = devices.SHARDS,
) -> StreamingQuery:
    """``once`` needs ``ttl=False``: a stream with wall-clock expiry runs on by design."""
    if once and ttl and mode == "exact":
        raise ValueError("a stream with wall-clock expiry does not end; pass ttl=False")
    parsed = page_logs(spark, source, streaming=True)
    seen = devices.unique_visit(accepted(parsed), mode, ttl, delay, shards)
    records = devices.visit_records(seen, names.UNIQUE_VISIT, names.PAGE_LOG)
    records = records.unionByName(rejected_records(parsed, names.PAGE_LOG))
    return stream_records(records, target, checkpoint, once, "unique_visit")


def run_until_idle(query: StreamingQuery, wait: float = 0.5) -> int:
    """Let a stream that does not end by itself run until a batch of it finds nothing new, then stop it.

    Expiry by the wall clock makes a batch of every trigger, so the stream's own
    progress tells when it has taken all there is. It has to be given something.
    Returns the number of batches with input.
    """
    taken: dict[int, int] = {}
    while query.isActive and 0 not in taken.values():
        query.awaitTermination(wait)
        taken |= {p.batchId: p.numInputRows for p in query.recentProgress}
    query.stop()
    if error := query.exception():
        raise error
    return sum(n > 0 for n in taken.values())


def start_jump_detail(
    spark: SparkSession, source: Store, target: Store, checkpoint: str, once: bool = False, shards: int = devices.SHARDS,
) -> StreamingQuery:
    """Late pages go to the rejects topic; pages it cannot use are those of the visit stream, which keeps them."""
    jumps = devices.jump_detail(accepted(page_logs(spark, source, streaming=True)), shards=shards)
    return stream_records(devices.visit_records(jumps, names.USER_JUMP, names.PAGE_LOG), target, checkpoint, once, "jump_detail")
