"""Packing by optimal length buckets.

Documents become sequences of at most ``max_len`` tokens (longer ones are cut
into several, none is dropped). The histogram of sequence lengths, at most
``max_len`` numbers whatever the corpus, goes to the driver, where dynamic
programming picks the bucket boundaries with the least padding in all. Inside a
bucket, batches hold as many sequences as fit the token budget when padded to
the boundary.

A bucket may hold most of all rows, so places in it are not counted in one task:
rows are dealt to slices by a hash of the id, counted per slice, and numbered
from the running total of the slices before theirs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import staged, words

MAX_LEN = 2048
BUCKETS = 8
TOKEN_BUDGET = 16384
SLICE_ROWS = 500_000


class Plan(NamedTuple):
    """How sequences are packed; ``boundaries`` are the padded lengths, ascending."""

    boundaries: list[int]
    budget: int

    def capacity(self, boundary: int) -> int:
        return max(1, self.budget // boundary)


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` boundaries that minimise the padding of the given histogram.

    ``lengths`` ascend. Every boundary is one of them. Of equally good choices,
    each bucket takes the one that starts at the smallest length, as told from
    the last bucket backwards; fewer buckets win a tie.
    """
    if not len(lengths):
        return []
    lengths, counts = np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    total = len(lengths)
    # best[j]: least padded tokens for the first j lengths; real tokens are the same for every choice.
    best = np.concatenate([[0], lengths * rows[1:]])
    starts = []
    for _ in range(1, min(buckets, total)):
        start, better = np.zeros(total + 1, dtype=np.int64), best.copy()
        for j in range(1, total + 1):
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j])
            start[j] = int(np.argmin(cost))
            better[j] = cost[start[j]]
        starts.append(start)
        if better[total] == best[total]:
            starts.pop()
            break
        best = better
    ends, at = [], total
    while at > 0:
        ends.append(int(lengths[at - 1]))
        at = int(starts.pop()[at]) if starts else 0
    return ends[::-1]


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def sequences(docs: DataFrame, length: Column, id_col: str = "doc_id", max_len: int = MAX_LEN) -> DataFrame:
    """``(<id_col>, segment, length)``: documents cut into sequences of at most ``max_len``.

    A document of no tokens, or of null length, gives one sequence of length 0.
    """
    whole = docs.select(F.col(id_col), F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0)).alias("_tokens"))
    last = F.greatest(F.ceil(F.col("_tokens") / max_len) - 1, F.lit(0)).cast("int")
    return whole.select(
        id_col, "_tokens", F.explode(F.sequence(F.lit(0), last)).alias("segment"),
    ).select(
        id_col, "segment",
        F.least(F.col("_tokens") - F.col("segment").cast("bigint") * max_len, F.lit(max_len)).cast("bigint").alias("length"),
    )


def bucket_plan(rows: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> tuple[Plan, int]:
    """The plan for these sequences, and how many there are that have tokens."""
    histogram = sorted(tuple(r) for r in rows.where("length > 0").groupBy("length").count().collect())  # max_len rows at most
    lengths = np.array([r[0] for r in histogram], dtype=np.int64)
    counts = np.array([r[1] for r in histogram], dtype=np.int64)
    return Plan(optimal_boundaries(lengths, counts, buckets), budget), int(counts.sum())


def slice_of(id_col: str, slices: int) -> Column:
    """Which slice an id belongs to: the first eight hex digits of its MD5, modulo ``slices``."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % slices).cast("int")


def pack(rows: DataFrame, plan: Plan, count: int, id_col: str = "doc_id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``(<id_col>, segment, length, bucket, batch, slot, padding)``, a row for every row given.

    ``bucket`` is the padded length, ``batch`` counts from 0 inside the bucket
    and ``slot`` from 0 inside the batch. Sequences without tokens belong to no
    batch: these four are null. Rows come by id, segment and length, so rows alike in all three are all there is to mix up.
    """
    if not plan.boundaries:
        return rows.select(
            id_col, "segment", "length", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("bigint").alias("batch"),
            F.lit(None).cast("bigint").alias("slot"), F.lit(None).cast("bigint").alias("padding"),
        )
    bucket = F.lit(None).cast("bigint")
    capacity = F.lit(None).cast("bigint")
    for boundary in reversed(plan.boundaries):
        fits = (F.col("length") > 0) & (F.col("length") <= boundary)
        bucket = F.when(fits, F.lit(boundary).cast("bigint")).otherwise(bucket)
        capacity = F.when(F.col("bucket") == boundary, F.lit(plan.capacity(boundary)).cast("bigint")).otherwise(capacity)
    slices = max(1, -(-count // slice_rows))
    dealt = rows.select(id_col, "segment", "length").withColumn("bucket", bucket)
    dealt = dealt.withColumn("_slice", slice_of(id_col, slices))
    full = dealt.where(F.col("bucket").isNotNull())
    before = (
        full.groupBy("bucket", "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(F.sum("_n").over(Window.partitionBy("bucket").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .drop("_n")
    )
    near = Window.partitionBy("bucket", "_slice").orderBy(F.col(id_col).asc_nulls_first(), "segment", "length")
    numbered = (
        full.withColumn("_near", F.row_number().over(near) - 1)
        .join(before, ["bucket", "_slice"])
        .withColumn("_place", F.col("_near") + F.col("_before"))
        .withColumn("_capacity", capacity)
        .select(
            id_col, "segment", "length", "bucket",
            F.floor(F.col("_place") / F.col("_capacity")).cast("bigint").alias("batch"),
            (F.col("_place") % F.col("_capacity")).cast("bigint").alias("slot"),
            (F.col("bucket") - F.col("length")).alias("padding"),
        )
    )
    empty = dealt.where(F.col("bucket").isNull()).select(
        id_col, "segment", "length", "bucket", F.lit(None).cast("bigint").alias("batch"),
        F.lit(None).cast("bigint").alias("slot"), F.lit(None).cast("bigint").alias("padding"),
    )
    return numbered.union(empty)


def pack_documents(
    docs: DataFrame, length: Column, id_col: str = "doc_id", max_len: int = MAX_LEN, buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Every document of ``docs`` in its batches; see :func:`sequences` and :func:`pack`."""
    rows = staged(sequences(docs, length, id_col, max_len))
    plan, count = bucket_plan(rows, buckets, budget)
    return pack(rows, plan, count, id_col, slice_rows)
