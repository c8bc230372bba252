"""Lookups into tables where one key may hold much of the data.

A key counts as hot when it holds more rows than one task should take
(``Skew.rows``), whatever the size of the table, and is spread over as many parts
as it holds times that number. Which keys are hot never changes a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TASK_ROWS = 1_000_000
SALTS = 128
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


class Skew(NamedTuple):
    """How many rows of one key a task may take."""

    rows: int = TASK_ROWS


def order_value(order: Sequence[str]) -> Column:
    """One comparable value for an ordering by several columns."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _counts(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def hot_keys(df: DataFrame, key: str, skew: Skew = Skew()) -> DataFrame:
    """The hot keys of ``df`` and into how many ``_parts`` each is cut, from a map-side combined count."""
    hot = _counts(df, key).where(F.col("_n") > skew.rows)
    return hot.select(key, F.ceil(F.col("_n") / max(1, skew.rows)).cast("int").alias("_parts"))


def lookup_by_key(
    df: DataFrame, facts: DataFrame, key: str, spread: Sequence[str], skew: Skew = Skew()
) -> DataFrame:
    """Left join ``df`` with ``facts`` (one row per key, any number of keys).

    Rows of hot keys are spread by ``spread`` over the key's parts, and their
    facts are repeated once for each part.
    """
    names = [c for c in facts.columns if c != key]
    hot = hot_keys(df, key, skew)
    parts = F.coalesce("_parts", F.lit(1))
    repeated = facts.join(hot, key, "left").select(
        key, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_salt"), F.struct(*names).alias("_facts"),
    )
    salted = df.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), parts).cast("int"))
    return (
        salted.join(repeated, [key, "_salt"], "left")
        .select(*df.columns, *[F.col("_facts")[n].alias(n) for n in names])
    )


def fits_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most so many rows and bytes of text; no more rows than that are read."""
    size = F.octet_length(F.to_json(F.struct(*small.columns)))
    rows, held = small.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and held <= max_bytes


def lookup_small(
    df: DataFrame, small: DataFrame, on: Sequence[str], spread: Column,
    max_rows: int = BROADCAST_ROWS, salts: int = SALTS, max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join with a side expected to be small, e.g. rules.

    Its rows and bytes are checked first. Up to ``max_rows`` and ``max_bytes`` it
    is broadcast; beyond, it is replicated over ``salts`` so that a hot key of
    ``df`` stays spread.
    """
    if fits_broadcast(small, max_rows, max_bytes):
        return df.join(F.broadcast(small), list(on), "left")
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
        .join(salted, [*on, "_salt"], "left")
        .drop("_salt")
    )
