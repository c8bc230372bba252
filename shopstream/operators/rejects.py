"""Records that cannot be processed carry a ``reject_reason`` instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream import names

REASON = "reject_reason"


def first_reason(*checks: tuple[str, Column]) -> Column:
    """The name of the first check that holds; null when none does."""
    return F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in checks])


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON)


def quarantined(df: DataFrame) -> DataFrame:
    """The raw text of the rejected records and why."""
    keep = [c for c in ("value", "arrival", REASON) if c in df.columns]
    return df.where(F.col(REASON).isNotNull()).select(*keep)


def rejected_records(df: DataFrame, source: str) -> DataFrame:
    """The rejected records as (topic, value, arrival) rows: source, text and reason as JSON."""
    record = F.struct(F.lit(source).alias("source"), F.col(REASON), F.col("value"))
    return quarantined(df).select(F.lit(names.REJECTED).alias("topic"), F.to_json(record).alias("value"), "arrival")
