"""A corpus made ready for training: quality, near duplicates, secrets, packing.

Every stage takes all that the one before it kept. Its result is written as
Parquet in the shared folder and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import packing, quality, secrets, simhash
from shopstream.llm.common import staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts are scored as such; all columns stay as they are."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints link, directly or through others, that with the smallest id stays.

    Null and blank texts link with one another; all columns stay as they are.
    """
    return simhash.keep_one_of_each(docs, size=simhash.SHINGLE, radius=simhash.RADIUS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are masked and its length is counted again.

    A null text stays null, and has no length; further columns stay as they are.
    """
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each training sequence: its document, bucket, batch and slot.

    Null and empty texts give one row of length zero, in no bucket; further columns are left out.
    """
    return packing.pack_documents(docs, packing.word_count(F.col("text")))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs)
    return docs


# The quality scores and the fingerprints have no SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None
