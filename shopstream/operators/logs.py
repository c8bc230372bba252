"""App logs: parse, repair the new-visitor flag, split into start, page and display."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream import names, schemas
from shopstream.functions.fields import last_of_repeated, to_json_line, with_flag
from shopstream.functions.times import day_of
from shopstream.operators.rejects import REASON, first_reason
from shopstream.operators.skew import Skew, lookup_by_key, order_value

ARRIVAL = ("arrival",)


class LogSplit(NamedTuple):
    start: DataFrame
    page: DataFrame
    display: DataFrame


def is_start(start: Column) -> Column:
    """A log with a non-empty ``start`` object is a start log, all others are page logs."""
    return F.coalesce(F.size(start), F.lit(0)) > 0


def parse_log(raw: DataFrame) -> DataFrame:
    """Parse ``value`` into the log's fields; unusable logs get a ``reject_reason``.

    The text itself stays in ``value``, so fields outside the schema are kept.
    """
    log = F.from_json("value", schemas.APP_LOG + ", _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    # Through a generator, so that filters on the fields do not parse the text again.
    parsed = raw.select("*", F.inline(F.array(log)))
    # Judged by the maps as read: no key that is repeated makes one empty or null, and a filter would settle them once more.
    on_page = ~is_start(F.col("start"))
    ts = F.col("ts").try_cast("bigint")
    reason = first_reason(
        ("bad_json", F.col("value").isNull() | F.col("_bad").isNotNull()),
        ("no_common", F.col("common").isNull()),
        ("no_mid", F.col("common.mid").isNull()),
        ("no_ts", (F.col("common.is_new") == "1") & ts.isNull()),
        ("no_page", on_page & F.col("page").isNull()),
        ("bad_display", on_page & F.exists("displays", lambda d: d.isNull())),
    )
    settled = {
        "ts": ts, "mid": F.col("common.mid"), "start": last_of_repeated(F.col("start")),
        "displays": F.transform("displays", last_of_repeated), REASON: reason,
    }
    return parsed.withColumns(settled).drop("_bad")


def repair_is_new(logs: DataFrame, order: Sequence[str] = ARRIVAL, skew: Skew = Skew()) -> DataFrame:
    """Turn ``is_new`` to "0" where the device was first seen as new on another day.

    Only rows flagged "1" count, in arrival order: the first one fixes the
    device's day (its first arrival, not its earliest date). Other rows pass by
    without a shuffle.
    """
    flagged = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    new = logs.where(flagged).withColumn("_day", day_of(F.col("ts")))
    first = new.groupBy("mid").agg(F.min_by("_day", order_value(order)).alias("_first_day"))
    seen = lookup_by_key(new, first, "mid", order, skew)
    stale = F.col("_day") != F.col("_first_day")
    zero = F.lit("0")
    repaired = (
        seen.withColumn("value", F.when(stale, with_flag(F.col("value"), zero)).otherwise(F.col("value")))
        .withColumn("common", F.when(stale, F.col("common").withField("is_new", zero)).otherwise(F.col("common")))
        .select(*logs.columns)
    )
    return repaired.unionByName(logs.where(~flagged))


def stamped_display(display: Column, page_id: Column) -> Column:
    """A display entry carrying the id of the page it was shown on."""
    own = F.map_filter(display, lambda k, _: k != "page_id")
    stamp = F.create_map(F.lit("page_id"), page_id.cast("variant"))
    return F.when(page_id.isNull(), own).otherwise(F.map_concat(own, stamp))


def explode_displays(pages: DataFrame) -> DataFrame:
    """One row per display of each page log; pages without displays give none."""
    page_id = F.col("page.page_id")
    shown = pages.select(
        *[c for c in ("arrival", "mid", "page") if c in pages.columns], F.explode("displays").alias("display")
    )
    shown = shown.withColumn("display", stamped_display(F.col("display"), page_id)).drop("page")
    return shown.withColumn("value", to_json_line(F.col("display"), "map"))


def split_logs(logs: DataFrame) -> LogSplit:
    """Start logs, page logs, and the displays of the page logs."""
    start = logs.where(is_start(F.col("start")))
    page = logs.where(~is_start(F.col("start")))
    return LogSplit(start, page, explode_displays(page))


def _record(topic: str, value: Column) -> Column:
    return F.struct(F.lit(topic).alias("topic"), value.alias("value"))


def shown_records() -> Column:
    """The display records of a parsed page log."""
    page_id = F.col("page.page_id")
    return F.transform("displays", lambda d: _record(names.DISPLAY_LOG, to_json_line(stamped_display(d, page_id), "map")))


def log_records(logs: DataFrame) -> DataFrame:
    """All three outputs as (topic, value, arrival) rows, in one pass over the logs."""
    page = F.array(_record(names.PAGE_LOG, F.col("value")))
    start = F.array(_record(names.START_LOG, F.col("value")))
    page_and_shown = F.when(F.col("displays").isNull(), page).otherwise(F.concat(page, shown_records()))
    records = F.when(is_start(F.col("start")), start).otherwise(page_and_shown)
    return logs.select(F.explode(records).alias("r"), "arrival").select("r.topic", "r.value", "arrival")
