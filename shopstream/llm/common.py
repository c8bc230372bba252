"""Shared folders, cut lineage, and the small helpers that several operators use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.session import shared_dir, stage


def work_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only where a local session names none."""
    unset = spark.conf.get("spark.checkpoint.dir", None) is None
    local = tempfile.gettempdir() if unset and spark.sparkContext.master.startswith("local[") else None
    return f"{shared_dir(spark, local)}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read from there."""
    return stage(df, work_dir(df.sparkSession))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint, for loops over narrow tables."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession))
    return df.checkpoint()


def words(text: Column) -> Column:
    """Words between ASCII white space; none for null or blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
