"""One query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import bpe, gnat, grace, hnsw, packing, projection, quality, quotes, reputation, secrets, simhash, warc, whitening
from shopstream.llm.common import staged

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary lies beside the tokenizer package, on the driver alone; the tokenizer travels with the tasks."""
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        definition = bpe.tokenizer_json(bpe.parse_ranks(file), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.digests_of(F.col("text"), definition).alias("found"))
    return docs.select("doc_id", "found.*")


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations hold no quotes, so their turns are made mails first, which quote the two turns before them."""
    mails = staged(quotes.as_mails(table(spark, sf_dir, "conversations")))
    found = quotes.reply_conversations(mails)
    return found.select("conv_id", "turn", "role", "text", "parent", "root", "depth", "quoted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.word_count(F.col("text")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = tuple(r.kind for r in secrets.RULES)
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id",
        *[secrets.count_kind(F.col("spans"), k).alias(f"n_{k}") for k in kinds],
        F.sha2(secrets.joined_spans(F.col("spans"), kinds), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("spans")).alias("spans"),
    )


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = reputation.page_outcomes(pages, table(spark, sf_dir, "labels"))
    found = reputation.judge(pages, outcomes)
    return found.select("page_id", "host", "path", "rule", "verdict", F.col("n").alias("n_labelled"), F.col("k").alias("n_bad"))


def op11_grace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_gnat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.compress(table(spark, sf_dir, "embeddings"))


ALL: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_quotes": op2_quotes,
    "op3_simhash": op3_simhash,
    "op4_projection": op4_projection,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_secrets": op8_secrets,
    "op9_hnsw": op9_hnsw,
    "op10_reputation": op10_reputation,
    "op11_grace": op11_grace,
    "op12_whitening": op12_whitening,
    "op13_gnat": op13_gnat,
}
