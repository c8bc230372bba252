"""Per-device operators on streams of parsed logs.

Same results as the batch forms, for rows that are not late. State lives in
the RocksDB state store; set it with ``session.DEFAULTS``. Devices are dealt to a
fixed number of shards; a stream keeps the number it was started with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from shopstream import names
from shopstream.functions.fields import is_entry_page, with_flag
from shopstream.functions.times import DAY_MS, NO_DELAY, day_text, sortable, with_event_time
from shopstream.operators.logs import is_start, shown_records
from shopstream.operators.visits import BOUNCE_GAP_MS, timed_pages
from shopstream.streaming.processors import KEPT, LATE, Bounce, DayChange, FirstDay, FirstOfDay

# Some times the tasks that a stream's state is to be spread over; more only cost calls.
SHARDS = 256
# Into how many tables the devices a shard has seen on a day are cut; fixed for a stream.
DAY_PARTS = 16


def by_shard(rows: DataFrame, shards: int) -> GroupedData:
    """Rows, with their position as a plain value, by shards of devices."""
    return rows.withColumn("shard", F.pmod(F.xxhash64("mid"), F.lit(shards)).cast("int")).groupBy("shard")


def position_kind(rows: DataFrame) -> str:
    """The type of a position as ``sortable`` leaves it."""
    return "STRING" if rows.schema["arrival"].dataType.typeName() in ("struct", "string") else "BIGINT"


def repaired_records(logs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The start, page and display records of parsed logs, with the new-visitor flag repaired: (topic, value, arrival).

    Only the texts of logs flagged "1" visit the state; displays, which do not
    show the flag, and other logs pass by. A device's first day is kept for good.
    """
    logs, kind = sortable(logs), position_kind(logs)
    flagged = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    topic = F.when(is_start(F.col("start")), names.START_LOG).otherwise(names.PAGE_LOG)
    new = logs.where(flagged).select("mid", "arrival", day_text(F.col("ts")).alias("day"), topic.alias("topic"), "value")
    seen = by_shard(new, shards).transformWithStateInPandas(
        statefulProcessor=FirstDay(), outputStructType=f"mid STRING, arrival {kind}, day STRING, topic STRING, value STRING, first_day STRING",
        outputMode="append", timeMode="None",
    )
    stale = F.col("day") != F.col("first_day")
    repaired = seen.select("topic", F.when(stale, with_flag(F.col("value"), F.lit("0"))).otherwise(F.col("value")).alias("value"), "arrival")
    own = F.when(~flagged, F.array(F.struct(topic.alias("topic"), F.col("value").alias("value")))).otherwise(F.array())
    records = F.when(is_start(F.col("start")) | F.col("displays").isNull(), own).otherwise(F.concat(own, shown_records()))
    others = logs.select(F.explode(records).alias("r"), "arrival").select("r.topic", "r.value", "arrival")
    return repaired.union(others)


def unique_visit(pages: DataFrame, mode: str = "exact", ttl: bool = True, delay: str = "1 day", shards: int = SHARDS) -> DataFrame:
    """``kind, mid, value, arrival`` of the entry pages that open a visitor's day.

    ``exact`` compares with the day last seen, which is forgotten after a day of
    wall-clock time if ``ttl``. ``daily`` gives each device and date once, the
    first to arrive; a date is known until the newest page is ``delay`` past its
    end, and entry pages of it that come after that are of the kind "late".
    """
    kind = position_kind(pages)
    entries = sortable(timed_pages(pages).where(is_entry_page(F.col("page"))))
    entries = entries.withColumn("day", day_text(F.col("ts")))
    if mode == "daily":
        day_end = F.unix_millis(F.date_add(F.to_date("day"), 1).cast("timestamp"))
        timed = with_event_time(entries.withColumn("day_end", day_end), delay=delay)
        # By the upper half of the hash, as shards go by all of it.
        part = F.pmod(F.shiftrightunsigned(F.xxhash64("mid"), 32), F.lit(DAY_PARTS)).cast("int").alias("part")
        # Without its time a row is not dropped as late: the processor tells.
        return by_shard(timed.select("mid", "value", "arrival", "day", "day_end", part), shards).transformWithStateInPandas(
            statefulProcessor=FirstOfDay(), outputStructType=f"kind STRING, mid STRING, value STRING, arrival {kind}",
            outputMode="append", timeMode="EventTime",
        )
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    seen = by_shard(entries.select("mid", "value", "arrival", "day"), shards).transformWithStateInPandas(
        statefulProcessor=DayChange(DAY_MS if ttl else None), outputStructType=f"mid STRING, value STRING, arrival {kind}, day STRING",
        outputMode="append", timeMode="ProcessingTime" if ttl else "None",
    )
    return seen.select(F.lit(KEPT).alias("kind"), "mid", "value", "arrival")


def jump_detail(pages: DataFrame, gap_ms: int = BOUNCE_GAP_MS, delay: str = NO_DELAY, shards: int = SHARDS) -> DataFrame:
    """``kind, mid, value, arrival, ts`` of the bounces whose gap the watermark has passed, and of the late pages."""
    kind = position_kind(pages)
    timed = with_event_time(sortable(timed_pages(pages)).withColumn("entry", is_entry_page(F.col("page"))), delay=delay)
    rows = timed.select("mid", "value", "arrival", "ts", "entry")
    return by_shard(rows, shards).transformWithStateInPandas(
        statefulProcessor=Bounce(gap_ms, kind), outputStructType=f"kind STRING, mid STRING, value STRING, arrival {kind}, ts BIGINT",
        outputMode="append", timeMode="EventTime",
    )


def visit_records(seen: DataFrame, topic: str, source: str) -> DataFrame:
    """(topic, value, arrival) records: what was kept under ``topic``, late rows as rejects of ``source``, counted.

    The count of both is in the progress of the stream, under ``observedMetrics``.
    """
    late = F.col("kind") == LATE
    told = seen.observe(topic, *[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in (KEPT, LATE)])
    record = F.struct(F.lit(source).alias("source"), F.lit(LATE).alias("reject_reason"), F.col("value"))
    return told.select(
        F.when(late, names.REJECTED).otherwise(topic).alias("topic"), F.when(late, F.to_json(record)).otherwise(F.col("value")).alias("value"), "arrival",
    )
