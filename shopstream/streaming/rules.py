"""Routing rules kept up to date by a stream of changes of the rule table."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shopstream import schemas
from shopstream.operators.cdc import RULE_KEY, RULE_NAMES

VERSION = schemas.RULE + ", type STRING, version BIGINT"
_FIELDS = [n for n in RULE_NAMES if n not in RULE_KEY]


class FoldRule(StatefulProcessor):
    """Keeps what a rule says now, and passes the changes that say something else.

    Input rows: the rule's fields, type and version. Its changes of a batch are
    few, and are put in order of their version first. A change with a version
    before the one kept is passed and leaves the state as it is; one with the
    kept version changes nothing, so a repeated envelope is passed once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"{n} STRING" for n in _FIELDS)
        self._now = handle.getValueState("rule", f"version BIGINT, gone BOOLEAN, {fields}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = tuple(self._now.get()) if self._now.exists() else None
        before = now
        found = [(r.version, r.type == "delete", *[r[n] for n in _FIELDS]) for r in rows]
        for rule in sorted(found, key=lambda r: (r[0], [(x is not None, x) for x in r[1:]])):
            if now is not None and rule[0] >= now[0] and rule[1:] == now[1:]:
                continue
            yield Row(**dict(zip(RULE_KEY, key)), **dict(zip(_FIELDS, rule[2:])), type="delete" if rule[1] else "update", version=rule[0])
            if now is None or rule[0] >= now[0]:
                now = rule
        if now != before:
            self._now.update(now)

    def close(self) -> None:
        pass


def fold_rules(changes: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """The versions of rules that differ from what was in force, out of a stream of ``rule_changes``.

    Deletes are left out unless ``honor_deletes``, as are changes that name no rule or have no version.
    """
    named = changes.where(F.col("version").isNotNull())
    for column in RULE_KEY:
        named = named.where(F.col(column).isNotNull())
    if not honor_deletes:
        named = named.where(~F.col("type").eqNullSafe("delete"))
    columns = [f.split()[0] for f in VERSION.split(", ")]
    folded = named.select(*columns).groupBy(*RULE_KEY).transformWithState(
        statefulProcessor=FoldRule(), outputStructType=", ".join(
            f"{n} {'BIGINT' if n == 'version' else 'STRING'}" for n in [*RULE_KEY, *_FIELDS, "type", "version"]
        ), outputMode="append", timeMode="None",
    )
    return folded.select(*columns)


def write_versions(versions: DataFrame, root: str, batch_id: int) -> None:
    """Add a batch's versions to the store below ``root``; the same batch written again replaces itself."""
    versions.coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/batch={int(batch_id)}")


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """All versions kept below ``root``, as ``rule_changes``; none if the rule job has not run yet."""
    try:
        return spark.read.schema(VERSION).option("basePath", f"{root}/versions").parquet(f"{root}/versions/batch=*").select(
            "type", "version", *RULE_NAMES,
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSION).select("type", "version", *RULE_NAMES)
