"""Changes of the rule table, from capture envelopes or a table snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream import schemas
from shopstream.operators.rejects import REASON, accepted, first_reason

ENVELOPE = (
    "topic STRING, op STRING, ts_ms BIGINT, "
    "before MAP<STRING, STRING>, after MAP<STRING, STRING>"
)


def parse_envelopes(raw: DataFrame) -> DataFrame:
    """Parse ``value`` into the envelope's fields; what is no capture envelope gets a ``reject_reason``."""
    parsed = raw.select("*", F.inline(F.array(F.from_json("value", ENVELOPE))))
    return parsed.withColumn(REASON, first_reason(
        ("bad_json", F.coalesce("topic", "op").isNull()),
        ("no_table", F.get(F.split("topic", r"\."), 2).isNull()),
        ("no_op", F.col("op").isNull()),
        ("no_image", F.col("before").isNull() & F.col("after").isNull()),
    ))


def flatten_cdc(envelopes: DataFrame) -> DataFrame:
    """Capture envelopes as ``database, table, type, data, before, version``.

    Takes raw texts, of which malformed ones are left out, or parsed envelopes.
    Database and table come from the envelope's topic (``server.database.table``);
    an op of create counts as insert; no after-image gives empty ``data``.
    ``version`` orders the changes: ``arrival`` where given, else ``ts_ms``.
    """
    if "op" not in envelopes.columns:
        envelopes = accepted(parse_envelopes(envelopes))
    path = F.split("topic", r"\.")
    op = F.lower("op")
    empty = F.create_map().cast("map<string,string>")
    version = F.col("arrival") if "arrival" in envelopes.columns else F.col("ts_ms")
    return envelopes.select(
        F.get(path, 1).alias("database"), F.get(path, 2).alias("table"),
        F.when(op == "create", "insert").otherwise(op).alias("type"),
        F.coalesce("after", empty).alias("data"), "before", version.alias("version"),
    )


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """The lines of the envelope files below ``path``, parsed; malformed ones carry a ``reject_reason``."""
    reader = spark.readStream if streaming else spark.read
    return parse_envelopes(reader.text(path).select("value"))


def read_rules(
    spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None, streaming: bool = False
) -> DataFrame:
    """Rules: capture envelopes as JSON files below ``path``, or a ``jdbc`` snapshot.

    Envelopes come flattened, ready for ``rule_changes`` and ``current_rules``;
    malformed ones are the rejected rows of ``read_envelopes``. A snapshot already
    holds one row per rule.
    """
    if jdbc is not None:
        columns = [f.split()[0] for f in schemas.RULE.split(", ")]
        return spark.read.format("jdbc").options(**jdbc).load().select(*columns)
    return flatten_cdc(accepted(read_envelopes(spark, path, streaming)))
