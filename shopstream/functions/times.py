"""Epoch milliseconds, event time and the day strings the jobs compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MS = 86_400_000

# A watermark just behind the newest row: rows as new as the newest are not late.
NO_DELAY = "1 millisecond"


def event_time(ts: Column) -> Column:
    return F.timestamp_millis(ts)


def day_of(ts: Column) -> Column:
    """Calendar day of an epoch-millisecond value, in the session zone."""
    return F.to_date(F.timestamp_millis(ts))


def day_text(ts: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.timestamp_millis(ts), pattern)


def day_start_millis(text: Column) -> Column:
    """Epoch ms of the day a date-time string starts with; the rest is ignored."""
    day = F.regexp_extract(text, r"^\s*(\d+-\d+-\d+)", 1)
    return F.unix_millis(F.try_to_timestamp(day, F.lit("y-M-d")))


def second_millis(text: Column) -> Column:
    """Epoch ms of a ``yyyy-MM-dd HH:mm:ss`` string."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def with_event_time(df: DataFrame, ts: str = "ts", delay: str = NO_DELAY, name: str = "event_time") -> DataFrame:
    """Add an event-time column from epoch ms and a watermark on it.

    Rows older than the watermark are late: stateful operators drop them.
    """
    return df.withColumn(name, event_time(F.col(ts))).withWatermark(name, delay)


def position(time: Column, partition: Column, offset: Column) -> Column:
    """A record's place in a topic of several partitions, whose offsets have no common order; it compares by time first."""
    parts = zip(("time", "partition", "offset"), (time, partition, offset), ("bigint", "int", "bigint"))
    return F.struct(*[value.cast(kind).alias(name) for name, value, kind in parts])


def sortable(df: DataFrame, arrival: str = "arrival") -> DataFrame:
    """``df`` with its position as one plain value that sorts as the position does, for use outside the JVM."""
    if df.schema[arrival].dataType.typeName() != "struct":
        return df
    parts = [F.col(f"{arrival}.{p}") for p in ("time", "partition", "offset")]
    return df.withColumn(arrival, F.format_string("%019d-%010d-%019d", *parts))
