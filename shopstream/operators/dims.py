"""Dimension tables: created by rule, upserted from routed changes.

All tables of a job live below one root, and every step is one job whatever their
number. ``tables`` holds the definitions. ``rows/table=<t>/bucket=<b>`` holds the
rows, each key in the bucket its hash names. A batch is merged to one row per key,
joined with the buckets it touches, and replaces those.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream import names
from shopstream.functions.fields import is_blank, text_map
from shopstream.operators.rejects import REASON, first_reason
from shopstream.operators.skew import order_value
from shopstream.session import stage

SET = "_set"
DELETED = "_deleted"
DEFINITION = "sink_table STRING, pk STRING, columns ARRAY<STRING>, extend STRING"
ROW = "key STRING, values MAP<STRING, STRING>, deleted BOOLEAN, table STRING, bucket INT"
# How many buckets a table has; fixed once its first row is written.
BUCKETS = 16


class DimTable(NamedTuple):
    path: str
    pk: str
    columns: list[str]


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder; empty if nobody has written it yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# -- definitions -------------------------------------------------------------


def dim_rules(rules: DataFrame, since: Column | None = None) -> DataFrame:
    """Rules that create a table, with a ``reject_reason`` for unusable ones, and ``since`` if given."""
    wanted = rules.where((F.col("sink_type") == names.SINK_DIMENSION) & (F.col("operate_type") == "insert"))
    pk = F.coalesce("sink_pk", F.lit(names.DEFAULT_PK))
    columns = F.split("sink_columns", ",")
    reason = first_reason(
        ("no_columns", is_blank(F.col("sink_columns"))),
        ("no_table", is_blank(F.col("sink_table"))),
        ("pk_not_a_column", ~F.array_contains(columns, pk)),
    )
    return wanted.select(
        "sink_table", pk.alias("pk"), columns.alias("columns"),
        F.coalesce("sink_extend", F.lit("")).alias("extend"), reason.alias(REASON),
        *([] if since is None else [since.alias("since")]),
    )


def definitions(spark: SparkSession, root: str) -> DataFrame:
    """``sink_table, pk, columns, extend`` of the tables made so far; the first definition of a table stands."""
    made = _read(spark, f"{root}/tables", DEFINITION + ", made BIGINT")
    return made.groupBy("sink_table").agg(F.min(F.struct("made", "pk", "columns", "extend")).alias("d")).select(
        "sink_table", "d.pk", "d.columns", "d.extend",
    )


def ensure_dim_table(spark: SparkSession, rules: DataFrame, root: str) -> None:
    """Create the missing tables of the given rules.

    All columns are strings. A changed rule never alters a table, so of the
    ``rule_versions`` of a table the first makes it. Unusable rules are left to ``dim_rules``.
    """
    since = F.col("valid_from") if "valid_from" in rules.columns else F.lit(0).cast("bigint")
    rules = rules.where(~F.col("gone")) if "gone" in rules.columns else rules
    wanted = dim_rules(rules, since).where(F.col(REASON).isNull())
    first = wanted.groupBy("sink_table").agg(F.min(F.struct("since", "pk", "columns", "extend")).alias("d"))
    new = first.join(definitions(spark, root).select("sink_table"), "sink_table", "left_anti")
    if new.limit(1).count():
        made = F.unix_millis(F.current_timestamp()).alias("made")
        new.select("sink_table", "d.pk", "d.columns", "d.extend", made).write.mode("append").parquet(f"{root}/tables")


def _definition(spark: SparkSession, path: str) -> tuple[str, str, DimTable, str]:
    root, _, name = path.rstrip("/").rpartition("/")
    found = definitions(spark, root).where(F.col("sink_table") == name).first()
    if found is None:
        raise ValueError(f"no dimension table at {path}")
    return root, name, DimTable(path, found.pk, found.columns), found.extend


def dim_table(spark: SparkSession, path: str) -> DimTable:
    return _definition(spark, path)[2]


def table_exists(spark: SparkSession, path: str) -> bool:
    root, _, name = path.rstrip("/").rpartition("/")
    return definitions(spark, root).where(F.col("sink_table") == name).limit(1).count() > 0


# -- merging -----------------------------------------------------------------


def check_dim_rows(changes: DataFrame, pk: str | Column, columns: Sequence[str] | Column) -> DataFrame:
    """Mark routed changes the table cannot take."""
    pk = F.lit(pk) if isinstance(pk, str) else pk
    columns = columns if isinstance(columns, Column) else F.array(*[F.lit(c) for c in columns])
    data = F.col("data")
    key = F.try_element_at(data, pk).cast("string")
    return changes.withColumn(REASON, first_reason(
        ("no_table", pk.isNull()), ("no_key", is_blank(key)),
        ("unknown_column", F.size(F.array_except(F.map_keys(data), columns)) > 0),
    ))


def merge(rows: DataFrame) -> DataFrame:
    """One row per table and key: for each column the last value written.

    ``rows`` are ``table, key, order, values, writes, clears``. A row that clears
    makes all before it forgotten; its own values, if it writes, count. ``reset``
    tells that something was cleared, ``deleted`` that nothing was written since.
    Both steps are aggregates, so keys with very many changes are reduced before the shuffle.
    """
    written = F.struct("order", "value")
    cells = rows.select("table", "key", "order", "writes", "clears", F.explode_outer("values").alias("column", "value"))
    cells = cells.groupBy("table", "key", "column").agg(
        F.max(F.when(F.col("writes"), written)).alias("last"),
        F.max(F.when(F.col("writes"), F.col("order"))).alias("wrote"), F.max(F.when(F.col("clears"), F.col("order"))).alias("cleared"),
    )
    merged = cells.groupBy("table", "key").agg(
        F.max("wrote").alias("wrote"), F.max("cleared").alias("cleared"),
        F.collect_list(F.struct("column", "last")).alias("cells"),  # one for each column of the table
    )
    cleared = F.col("cleared")
    kept = F.filter("cells", lambda c: c["last"].isNotNull() & (cleared.isNull() | (c["last"]["order"] >= cleared)))
    values = F.map_from_entries(F.transform(kept, lambda c: F.struct(c["column"], c["last"]["value"])))
    gone = cleared.isNotNull() & (F.col("wrote").isNull() | (F.col("wrote") < cleared))
    return merged.select("table", "key", values.alias("values"), cleared.isNotNull().alias("reset"), gone.alias("deleted"))


def _as_rows(changes: DataFrame, table: Column, pk: Column, order: Sequence[str], apply_deletes: bool) -> DataFrame:
    """Routed changes as rows for ``merge``. A delete counts as one more write of its row unless applied."""
    deletes = F.col("type").eqNullSafe("delete") if apply_deletes else F.lit(False)
    texts = text_map(F.col("data"))
    return changes.select(
        table.alias("table"), F.element_at(texts, pk).alias("key"), order_value(order).alias("order"), texts.alias("values"),
        (~deletes).alias("writes"), deletes.alias("clears"),
    )


def merge_changes(
    changes: DataFrame, pk: str, columns: Sequence[str], order: Sequence[str], apply_deletes: bool = False
) -> DataFrame:
    """One row per key: for each column the last value written, by ``order``.

    Columns absent from a change keep what earlier changes wrote; a null that is
    present overwrites. ``_set`` lists the columns written. A delete counts as
    one more write of its row, or with ``apply_deletes`` clears it.
    """
    merged = merge(_as_rows(changes, F.lit(""), F.lit(pk), order, apply_deletes))
    every = F.array(*[F.lit(c) for c in columns])
    return merged.select(
        F.col("key").alias(pk), *[F.try_element_at("values", F.lit(c)).alias(c) for c in columns if c != pk],
        F.when(F.col("reset"), every).otherwise(F.map_keys("values")).alias(SET), F.col("deleted").alias(DELETED),
    )


# -- storage -----------------------------------------------------------------


def mark_dim_rows(spark: SparkSession, changes: DataFrame, root: str) -> DataFrame:
    """Routed changes with their table's ``pk`` and ``columns``, and a ``reject_reason`` where it cannot take them."""
    known = definitions(spark, root).drop("extend")
    return check_dim_rows(changes.drop("pk", "columns").join(known, "sink_table", "left"), F.col("pk"), F.col("columns"))


def _merged(current: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows of the touched buckets with the batch's changes in them.

    Rows whose key is gone stay until their bucket is written again, so that it is.
    """
    key = ["table", "bucket", "key"]
    old = current.where(~F.col("deleted")).select(*key, F.col("values").alias("old"))
    both = old.join(changed, key, "full_outer")
    kept = F.map_filter("old", lambda k, _: ~F.array_contains(F.map_keys("values"), k))
    values = F.when(F.col("values").isNull(), F.col("old")).when(F.col("reset") | F.col("old").isNull(), F.col("values"))
    return both.select(
        "key", values.otherwise(F.map_concat(kept, "values")).alias("values"), F.coalesce("deleted", F.lit(False)).alias("deleted"),
        "table", "bucket",
    )


def upsert_dims(
    spark: SparkSession, changes: DataFrame, root: str, batch_id: int, order: Sequence[str] = ("arrival",),
    apply_deletes: bool = False, buckets: int = BUCKETS,
) -> None:
    """Write a batch of routed changes into the tables that ``sink_table`` names, in one join for all of them.

    Rows a table cannot take (see ``mark_dim_rows``) are skipped; callers keep
    them in quarantine. Batches come in order, and only the last one may be
    repeated. If its merged rows were written already, they are put in place
    again, so a batch that ended while it replaced buckets is made whole.
    """
    merged, mark = f"{root}/merged", f"{root}/merged-batch"
    if not _read(spark, mark, "batch BIGINT").where(F.col("batch") == int(batch_id)).limit(1).count():
        fit = mark_dim_rows(spark, changes, root).where(F.col(REASON).isNull())
        rows = merge(_as_rows(fit, F.col("sink_table"), F.col("pk"), order, apply_deletes))
        changed = stage(rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")), f"{root}/changed")
        # At most the number of tables times that of buckets.
        touched = [f"{r['table']}/{r['bucket']}" for r in changed.select("table", "bucket").distinct().collect()]
        current = _read(spark, f"{root}/rows", ROW).where(F.concat_ws("/", "table", F.col("bucket").cast("string")).isin(touched))
        _merged(current, changed).write.mode("overwrite").parquet(merged)
        spark.createDataFrame([(int(batch_id),)], "batch BIGINT").write.mode("overwrite").parquet(mark)
    # One task for each bucket, so that it is one file.
    rows = _read(spark, merged, ROW).repartition("table", "bucket")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("table", "bucket").parquet(f"{root}/rows")


def upsert_dim(
    spark: SparkSession, changes: DataFrame, path: str, batch_id: int,
    order: Sequence[str] = ("arrival",), apply_deletes: bool = False,
) -> None:
    """``upsert_dims`` for a single table: all changes are its own."""
    root, _, name = path.rstrip("/").rpartition("/")
    upsert_dims(spark, changes.withColumn("sink_table", F.lit(name)), root, batch_id, order, apply_deletes)


def read_dim(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last finished batch."""
    root, name, table, extend = _definition(spark, path)
    rows = _read(spark, f"{root}/rows", ROW).where((F.col("table") == name) & ~F.col("deleted"))
    return rows.select(*[
        (F.col("key") if c == table.pk else F.try_element_at("values", F.lit(c)))
        .alias(c, metadata={"primary_key": c == table.pk, "extend": extend})
        for c in table.columns
    ])
