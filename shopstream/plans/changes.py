"""Change records to fact topics and dimension tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstream import names
from shopstream.operators import cdc, dims
from shopstream.operators.rejects import REASON, accepted, rejected_records
from shopstream.session import run_dir, stage
from shopstream.sinks.topics import TRIGGER, write_facts, write_records, writer_of
from shopstream.sources.rules import flatten_cdc, parse_envelopes
from shopstream.sources.topics import FolderTopics, KafkaTopics, read_topic
from shopstream.streaming import rules as rule_store

QUARANTINE = "quarantine"
UNREAD = "unread"


def stored_rules(root: str, by_position: bool = True) -> Callable[[SparkSession], DataFrame]:
    """For ``start_changes``: the rules that ``start_rules`` keeps below ``root``.

    ``by_position`` gives all versions, of which each change takes that of its own
    position, so a batch that is run again is routed as the first time; changes
    and rules must count positions alike. Otherwise the rules now in force hold.
    """

    def load(spark: SparkSession) -> DataFrame:
        stored = rule_store.read_versions(spark, root)
        return cdc.rule_versions(stored, honor_deletes=True) if by_position else cdc.current_rules(stored, honor_deletes=True)

    return load


def start_rules(
    spark: SparkSession, source: FolderTopics | KafkaTopics, topic: str, root: str, rejects: FolderTopics | KafkaTopics,
    checkpoint: str, honor_deletes: bool = False, once: bool = False,
) -> StreamingQuery:
    """The rule job: capture envelopes to the versions of the rules below ``root``, malformed ones to the rejects topic.

    Every envelope is read once. An envelope that says again what a rule says
    already, as each new snapshot of the rule table does, leaves no version.
    """
    parsed = parse_envelopes(read_topic(spark, source, topic, streaming=True))
    versions = rule_store.fold_rules(cdc.rule_changes(flatten_cdc(accepted(parsed))), honor_deletes)
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("topic", "string"), ("value", "string"), ("arrival", "bigint"))]
    records = versions.select(*none, F.struct(*versions.columns).alias("rule"))
    records = records.unionByName(rejected_records(parsed, topic), allowMissingColumns=True)
    writer = writer_of("rules", checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        held = stage(batch, f"{run_dir(session, root)}/rules")
        rule_store.write_versions(held.where("rule IS NOT NULL").select("rule.*"), root, batch_id)
        write_records(held.where("topic IS NOT NULL").select("topic", "value", "arrival"), rejects, batch_id, writer)

    stream = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName("rules")
    return (stream.trigger(availableNow=True) if once else stream.trigger(processingTime=TRIGGER)).start()


def process_changes(
    raw: DataFrame, rules: DataFrame, target: FolderTopics | KafkaTopics, dim_root: str, batch_id: int,
    scratch: str | None = None,
) -> None:
    """Route one batch of change records into facts, dimensions and quarantine.

    The records are dealt over the cluster, as a batch may be a few files only,
    and parsed in one pass. The routed rows and those that cannot be read are
    staged once, in a new folder of this run, then each output reads its own
    part. Every write to folders is keyed by ``batch_id``, so
    repeating a batch leaves the same result, with the same rules or with versions
    of them that came later (see ``stored_rules``); in Kafka the facts of a
    repeated batch are there twice.
    """
    spark = raw.sparkSession
    spread = raw.repartition(spark.sparkContext.defaultParallelism, "arrival" if "arrival" in raw.columns else "value")
    unread = F.col(REASON).isNotNull()
    parsed = cdc.parse_cdc(spread).where(unread | cdc.is_clean())
    routed = cdc.annotate_cdc(parsed, rules, scratch=scratch)
    routed = routed.withColumn("route", F.when(unread, F.lit(UNREAD)).otherwise(F.col("route")))
    folder = f"{run_dir(spark, scratch)}/changes"
    routed.write.mode("overwrite").partitionBy("route").parquet(folder)
    staged = spark.read.schema(routed.schema).parquet(folder)

    write_facts(staged.where(F.col("route") == "fact"), target, batch_id)

    dims.ensure_dim_table(spark, rules, dim_root)
    changed = staged.where(F.col("route") == "dim")
    dims.upsert_dims(spark, changed, dim_root, batch_id)
    refused = dims.mark_dim_rows(spark, changed, dim_root).where(F.col(REASON).isNotNull()).select("value", REASON)
    unfit = staged.where(F.col("route") == "rejected").select("value", F.lit("no_type").alias(REASON))
    unfit = unfit.unionByName(staged.where(F.col("route") == UNREAD).select("value", REASON)).unionByName(refused)
    unfit.write.mode("overwrite").parquet(f"{dim_root}/_{QUARANTINE}/batch={int(batch_id)}")


def start_changes(
    spark: SparkSession, source: FolderTopics | KafkaTopics, target: FolderTopics | KafkaTopics, dim_root: str,
    load_rules: Callable[[SparkSession], DataFrame], checkpoint: str, once: bool = False,
    scratch: str | None = None,
) -> StreamingQuery:
    """The change job. ``load_rules`` is called for every batch, so each batch
    sees the rules written before it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        process_changes(batch, load_rules(batch.sparkSession), target, dim_root, batch_id, scratch)

    changes = read_topic(spark, source, names.ODS_CHANGES, streaming=True)
    writer = changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName("changes")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
    return writer.start()
