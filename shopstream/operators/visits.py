"""Visitors and bounces, from page logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.functions.fields import is_entry_page
from shopstream.functions.times import day_of
from shopstream.operators.ordered import with_neighbour
from shopstream.operators.skew import order_value

BOUNCE_GAP_MS = 10_000


def timed_pages(pages: DataFrame) -> DataFrame:
    """Page logs that can be placed in time for their device."""
    return pages.where(F.col("mid").isNotNull() & F.col("page").isNotNull() & F.col("ts").isNotNull())


def unique_visit(
    pages: DataFrame, mode: str = "exact", order: Sequence[str] = ("arrival",), scratch: str | None = None,
) -> DataFrame:
    """Entry pages that open a visitor's day.

    ``exact`` compares each entry page with the device's previous one in
    ``order``: it opens a day when the date differs, so dates arriving as
    2, 1, 2 open three. ``daily`` gives the first entry page of each device and
    date, once.
    """
    entries = timed_pages(pages).where(is_entry_page(F.col("page")))
    entries = entries.withColumn("visit_date", day_of(F.col("ts")))
    if mode == "daily":
        return (
            entries.groupBy("mid", "visit_date")
            .agg(F.min_by(F.struct(*entries.columns), order_value(order)).alias("first"))
            .select("first.*")
        )
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    seen = with_neighbour(entries, "mid", order, F.col("visit_date"), "_last_date", after=False, scratch=scratch)
    return seen.where(~F.col("visit_date").eqNullSafe(F.col("_last_date"))).drop("_last_date")


def jump_detail(
    pages: DataFrame, gap_ms: int = BOUNCE_GAP_MS, order: Sequence[str] = ("ts", "arrival"),
    complete: bool = True, scratch: str | None = None,
) -> DataFrame:
    """Entry pages not followed by another page of the device within ``gap_ms``.

    The page that follows is the next one in event time, whatever it is; a gap
    of exactly ``gap_ms`` is a bounce. With ``complete`` the last page of a
    device counts as a bounce; without, only pages whose gap has passed by the
    latest event time do, as on a stream.
    """
    timed = timed_pages(pages)
    # Only entry pages can be output: the others go through the shuffle bare.
    entry = F.when(is_entry_page(F.col("page")), F.struct(*timed.columns))
    bare = timed.select("mid", *order, entry.alias("_entry"))
    seen = with_neighbour(bare, "mid", order, F.col("ts"), "_next_ts", after=True, scratch=scratch)
    alone = F.col("_next_ts").isNull() | (F.col("_next_ts") - F.col("ts") >= gap_ms)
    jumps = seen.where(F.col("_entry").isNotNull() & alone)
    if not complete:
        latest = timed.agg(F.max("ts")).scalar()
        jumps = jumps.where(F.col("ts") + gap_ms < latest)
    return jumps.select("_entry.*")
