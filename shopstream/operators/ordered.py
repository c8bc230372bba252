"""What comes before or after a row of its key, when one key may hold much of the data.

Rows are dealt to partitions by ranges of (key, order), so a key with any number
of rows is spread evenly and its rows stay in order. Inside a partition a plain
window finds the neighbour. Each partition's edge is one boundary row, and rows
that find nothing in their own partition take it from the nearest partition
before (or after) that ends (or begins) with their key.

Boundaries of ranges come from a sample, so the dealt rows are written once, in
the shared folder, and all that follows reads the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.operators.skew import order_value
from shopstream.session import run_dir, stage

PART = "_part"


def dealt_by_range(df: DataFrame, key: Sequence[str], order: Sequence[str], scratch: str | None = None) -> DataFrame:
    """``df`` dealt by ranges of (key, order), with the partition's number as ``_part``; written once."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *key, *order).withColumn(PART, F.spark_partition_id())
    return stage(ranged, f"{run_dir(df.sparkSession, scratch)}/ordered")


def _with_edges(
    near: DataFrame, dealt: DataFrame, key: Sequence[str], order: Sequence[str], boxed: Column, name: str, after: bool,
) -> DataFrame:
    """``near`` with ``name``: its own ``_near``, or the last non-null ``boxed`` its key has in earlier (later) partitions."""
    at, own = order_value([*key, *order]), F.struct(*key)
    farthest = F.min if after else F.max
    picked = F.min_by if after else F.max_by
    # One row for each partition: its outermost key, and that key's outermost value, if it has one there.
    found = F.struct(own.alias("key"), F.struct(boxed.alias("value")).alias("held"))
    edges = dealt.groupBy(PART).agg(
        farthest(own).alias("key"), picked(found, F.when(boxed.isNotNull(), at)).alias("found"),
    )
    held = F.when(F.col("found.key") == F.col("key"), F.col("found.held"))
    edges = edges.select(PART, "key", held.alias("held"))
    # Partitions that hold nothing of the key pass on what came before them.
    ordered = Window.orderBy(F.desc(PART) if after else F.asc(PART))
    runs = edges.withColumn("starts", (~F.lag("key").over(ordered).eqNullSafe(F.col("key"))).cast("int"))
    runs = runs.withColumn("run", F.sum("starts").over(ordered))
    carried = runs.withColumn("held", F.last("held", True).over(Window.partitionBy("run").orderBy(F.desc(PART) if after else F.asc(PART))))
    before = carried.select(
        PART, F.lag("key").over(ordered).alias("_edge_key"), F.lag("held").over(ordered)["value"].alias("_edge"),
    )
    same = F.struct(*[F.col(k) for k in key]) == F.col("_edge_key")
    joined = near.join(F.broadcast(before), PART, "left")  # a row for each partition
    value = F.coalesce("_near", F.when(same, F.col("_edge")))
    return joined.withColumn(name, value).drop(PART, "_near", "_edge", "_edge_key")


def with_neighbour(
    df: DataFrame, key: str, order: Sequence[str], value: Column, name: str, after: bool, scratch: str | None = None,
) -> DataFrame:
    """Add ``value`` of the key's row just before (or after) in ``order``; null if none.

    ``key`` must not be null. Rows equal in all of ``order`` are neighbours in any order.
    """
    dealt = dealt_by_range(df.withColumn("_value", F.struct(value.alias("value"))), [key], order, scratch)
    shift = F.lead if after else F.lag
    near = dealt.withColumn("_near", shift("_value").over(Window.partitionBy(PART, key).orderBy(*order)))
    found = _with_edges(near, dealt, [key], order, F.col("_value"), "_found", after)
    return found.withColumn(name, F.col("_found")["value"]).drop("_value", "_found")


def with_latest(
    df: DataFrame, facts: DataFrame, key: Sequence[str], order: str, facts_order: str, name: str, scratch: str | None = None,
) -> DataFrame:
    """Add to each row, as a struct, the latest of ``facts`` with its key and an order value no later than its own.

    An as-of join without a range condition: facts and rows are put in one order,
    and each row takes the fact before it, so neither many facts of a key nor many
    rows meet one another. ``name`` holds the fact's columns other than the key and is null
    where there is none. Rows with a null key or order value have none; of facts
    alike in key and order, any one counts. Rows are written once before, as drawing
    the ranges, dealing and setting aside what has no place would each work them out anew.
    """
    df = stage(df, f"{run_dir(df.sparkSession, scratch)}/rows")
    held = [c for c in facts.columns if c not in key]
    kept = facts.where(~_unplaced(key, facts_order)).select(
        *key, F.col(facts_order).alias("_at"), F.lit(0).alias("_row"), F.lit(None).alias("_own"), F.struct(*held).alias("_fact"),
    )
    rows = df.where(~_unplaced(key, order)).select(
        *key, F.col(order).alias("_at"), F.lit(1).alias("_row"), F.struct(*df.columns).alias("_own"), F.lit(None).alias("_fact"),
    )
    dealt = dealt_by_range(kept.unionByName(rows), key, ["_at", "_row"], scratch)
    window = Window.partitionBy(PART, *key).orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = dealt.withColumn("_near", F.last("_fact", True).over(window))
    found = _with_edges(near.where("_row = 1"), dealt, key, ["_at", "_row"], F.col("_fact"), name, after=False)
    out = found.select("_own.*", name)
    return out.unionByName(df.where(_unplaced(key, order)).withColumn(name, F.lit(None).cast(out.schema[name].dataType)))


def _unplaced(key: Sequence[str], order: str) -> Column:
    unknown = F.col(order).isNull()
    for k in key:
        unknown = unknown | F.col(k).isNull()
    return unknown
