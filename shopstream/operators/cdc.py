"""Database change records: parse, clean, and route by a table of rules."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream import names, schemas
from shopstream.functions.fields import has_content, is_blank, last_of_repeated, normalize_op, project_columns
from shopstream.operators.ordered import with_latest
from shopstream.operators.rejects import REASON, first_reason
from shopstream.operators.skew import fits_broadcast, lookup_small

RULE_NAMES = [f.split()[0] for f in schemas.RULE.split(", ")]
RULE_KEY = ["source_table", "operate_type"]
RULE_TARGET = ["sink_type", "sink_table", "sink_pk", "sink_columns"]
# Beyond so many versions of a rule its changes do not meet all of them, but are put in one order with them.
MOST_VERSIONS = 64


class Routed(NamedTuple):
    dim: DataFrame
    fact: DataFrame
    unrouted: DataFrame
    unmatched: DataFrame
    rejected: DataFrame


def parse_cdc(raw: DataFrame) -> DataFrame:
    """Parse ``value`` into ``table``, ``type`` and the open ``data`` map.

    Text that is no JSON object gets a ``reject_reason``.
    """
    change = F.from_json("value", schemas.CHANGE + ", _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    # Repeated keys are settled inside the generator, so filters on ``data`` do not settle them again.
    settled = F.transform(F.array(change), lambda c: c.withField("data", last_of_repeated(c["data"])))
    parsed = raw.select("*", F.inline(settled))
    # A ``data`` that is no object only leaves ``data`` null; cleaning drops the row.
    unread = F.col("_bad").isNotNull() & F.col("table").isNull() & F.col("type").isNull()
    bad = ("bad_json", F.col("value").isNull() | unread)
    return parsed.withColumn(REASON, first_reason(bad)).drop("_bad")


def clean_cdc(changes: DataFrame) -> DataFrame:
    """Changes that name a table and carry data."""
    return changes.where(is_clean())


def is_clean() -> Column:
    return ~is_blank(F.col("table")) & has_content(F.col("data"))


def rule_changes(flat: DataFrame) -> DataFrame:
    """Rule fields out of flattened change records of the rule table."""
    image = F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("data"))
    return flat.select("type", "version", *[image[n].alias(n) for n in RULE_NAMES])


def _known(changes: DataFrame, honor_deletes: bool) -> DataFrame:
    """Changes that name a rule; deletes only where they count."""
    if not honor_deletes:
        changes = changes.where(~F.col("type").eqNullSafe("delete"))
    return changes.where(F.col("source_table").isNotNull() & F.col("operate_type").isNotNull())


def current_rules(changes: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """The rule in force per source table and operation: the last one written.

    A deleted rule stays in force unless ``honor_deletes``.
    """
    known = _known(changes, honor_deletes)
    rest = [c for c in known.columns if c not in RULE_KEY]
    last = known.groupBy(*RULE_KEY).agg(F.max_by(F.struct(*rest), F.col("version")).alias("last"))
    rules = last.select(*RULE_KEY, "last.*")
    if honor_deletes:
        rules = rules.where(~F.col("type").eqNullSafe("delete"))
    return rules.select(*RULE_NAMES)


def rule_versions(changes: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """Every version of every rule, with the positions it holds for: from ``valid_from`` up to, not with, ``valid_until``.

    The last version's end is null. With ``honor_deletes`` a deleted rule leaves
    a version that is ``gone``; otherwise deletes change nothing. Of versions of
    one rule at the same position one counts, the greatest by its fields. The
    number of versions of a rule is that of its changes, which are few.
    """
    gone = F.col("type").eqNullSafe("delete").alias("gone")
    rest = [c for c in RULE_NAMES if c not in RULE_KEY]
    versions = _known(changes, honor_deletes).where(F.col("version").isNotNull()).groupBy(*RULE_KEY, F.col("version").alias("valid_from"))
    one = versions.agg(F.max(F.struct(gone, *rest)).alias("rule"))
    until = F.lead("valid_from").over(Window.partitionBy(*RULE_KEY).orderBy("valid_from"))
    return one.select(*RULE_KEY, "rule.*", "valid_from", until.alias("valid_until")).select(
        *RULE_NAMES, "valid_from", "valid_until", "gone",
    )


def _by_position(changes: DataFrame, versions: DataFrame, at: str, scratch: str | None) -> DataFrame:
    """Each change with the version of its rule that holds at its own position."""
    many = versions.groupBy("table", "type").count().agg(F.max("count")).first()[0] or 0
    if many <= MOST_VERSIONS and fits_broadcast(versions):
        within = (F.col(at) >= F.col("valid_from")) & (F.col("valid_until").isNull() | (F.col(at) < F.col("valid_until")))
        rules = versions.select(F.struct(*[c for c in versions.columns if c not in ("table", "type")]).alias("_rule"), *[
            F.col(c).alias(f"_{c}") for c in ("table", "type")
        ], "valid_from", "valid_until")
        same = (F.col("table") == F.col("_table")) & (F.col("type") == F.col("_type")) & within
        found = changes.join(F.broadcast(rules), same, "left").select(*changes.columns, "_rule")
    else:
        found = with_latest(changes, versions, ["table", "type"], at, "valid_from", "_rule", scratch)
    return found.select(*changes.columns, *[F.col("_rule")[c].alias(c) for c in RULE_TARGET], F.col("_rule")["_matched"].alias("_matched"))


def annotate_cdc(changes: DataFrame, rules: DataFrame, at: str = "arrival", scratch: str | None = None) -> DataFrame:
    """Add each change's target and ``route``, and cut ``data`` to the rule's columns.

    Rules in force (``current_rules``) hold for all changes. Of ``rule_versions``
    each change takes that of its own position, the column ``at``, so rules that
    are written later do not move it when it is routed again.
    """
    keyed = changes.withColumn("type", normalize_op(F.col("type")))
    versioned = "valid_from" in rules.columns
    held = ~F.col("gone") if versioned else F.lit(True)
    rules = rules.select(
        F.col("source_table").alias("table"), F.col("operate_type").alias("type"),
        "sink_type", "sink_table", *[F.when(held, F.col("sink_columns")).alias("sink_columns")],
        F.coalesce("sink_pk", F.lit(names.DEFAULT_PK)).alias("sink_pk"), held.alias("_matched"),
        *(["valid_from", "valid_until"] if versioned else []),
    )
    if versioned:
        joined = _by_position(keyed, rules, at, scratch)
    else:
        spread = F.col("arrival") if "arrival" in changes.columns else F.col("value")
        joined = lookup_small(keyed, rules, ["table", "type"], spread)
    route = (
        F.when(F.col("type").isNull(), "rejected")
        .when(~F.coalesce("_matched", F.lit(False)), "unmatched")
        .when(F.col("sink_type") == names.SINK_DIMENSION, "dim")
        .when(F.col("sink_type") == names.SINK_FACT, "fact")
        .otherwise("unrouted")
    )
    return (
        joined.withColumn("route", route)
        .withColumn("data", project_columns(F.col("data"), F.col("sink_columns")))
        .drop("sink_columns", "_matched")
    )


def route_cdc(changes: DataFrame, rules: DataFrame) -> Routed:
    """Dimension rows, fact rows, and the three kinds of rows that go nowhere.

    Only two sink types are served; changes under any other are ``unrouted``,
    those without a rule ``unmatched``, those without a type ``rejected``.
    """
    routed = annotate_cdc(changes, rules)
    return Routed(*[routed.where(F.col("route") == name) for name in Routed._fields])
