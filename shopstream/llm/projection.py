"""Near duplicates of embeddings by sorted projection passes.

Each pass signs every vector's dot products with random directions and orders
the vectors of a label by those bits, taken as one long key. Vectors of a label
that crowd around a centre would all have the same signs, so the label's centre
is taken off first; what is left of two similar vectors is less alike the nearer
they both are to it. A label with more vectors, or with more crowded ones, has
more passes and wider windows, so that a pair is missed no more often. Every
vector is compared with a bounded number of neighbours before it in that order,
in blocks that overlap by the window, so that no block boundary hides a pair.
Pairs at or above the similarity are verified in double precision, and the groups
of all passes are united. Orders are made of narrow rows; vectors are looked up
once the blocks are known.

A window can't hold every pair of a large group, so direct links are counted
afterwards, inside the groups found: pairs of bounded chunks of one group are
compared in full. Equal vectors count as one with its number of copies.
Blocks hand on spanning forests, chunks hand on counts, and nobody all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm.common import checkpointed, staged
from shopstream.llm.components import connected_components, join_labels

SIMILARITY = 0.93
PASSES = 12
MISSED = 0.001
SPARE_BITS = 1
BITS = 48
WINDOW = 64
BLOCK_ROWS = 1024
CHUNK_ROWS = 1024
MOST_PASSES = 48
MOST_WINDOW = 8192
LEAST_LEFT = 0.5
SEED = 7


# -- vectors -----------------------------------------------------------------


def is_usable(vector: Column) -> Column:
    """Not null nor empty, finite in every component, none of them null, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that neither huge nor tiny components overflow."""
    rows = np.array(vectors, dtype=np.float64).reshape(len(vectors), -1)
    rows /= np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _directions(number: int, size: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, number, size]).standard_normal((size, bits))


def centres(sized: DataFrame, similarity: float, passes: int, window: int, missed: float = MISSED) -> DataFrame:
    """``(label, size, centre, passes, window)``: each label's mean unit vector, and how it is to be passed over.

    With the centre c taken off, a pair at ``similarity`` has the cosine
    (similarity - cc) / (1 - cc) where both are as far from c as vectors are on
    average. Windows are as wide as ``MOST_PASSES`` passes need, up to
    ``MOST_WINDOW``; beyond that there are more passes.
    """
    label_type = sized.schema["label"].dataType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's sums of unit vectors, a row for each label and size in it."""
        totals: dict[tuple, list] = {}
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("label").type
            labels, sizes = batch.column("label").to_pylist(), np.array(batch.column("size").to_pylist())
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                vectors = batch.column("vector").take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                units = unit_rows(list(vectors.reshape(len(rows), size)))
                places: dict[object, int] = {}
                codes = np.array([places.setdefault(labels[r], len(places)) for r in rows.tolist()])
                sums = np.zeros((len(places), size))
                np.add.at(sums, codes, units)
                for (label, at), n in zip(places.items(), np.bincount(codes).tolist()):
                    held = totals.setdefault((label, size), [0, 0.0])
                    held[0], held[1] = held[0] + n, held[1] + sums[at]
        found = list(totals.items())
        for start in range(0, len(found), 1000):
            part = found[start:start + 1000]
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k, _ in part], kind), pa.array([k[1] for k, _ in part], pa.int32()),
                pa.array([v[0] for _, v in part], pa.int64()), pa.array([v[1] for _, v in part], pa.list_(pa.float64())),
            ], ["label", "size", "n", "sums"])

    parts = sized.select("label", "size", "vector").mapInArrow(add, f"label {label_type}, size INT, n BIGINT, sums ARRAY<DOUBLE>")
    places = parts.select("label", "size", "n", F.posexplode("sums").alias("place", "sum"))
    means = places.groupBy("label", "size", "place").agg((F.sum("sum") / F.sum("n")).alias("mean"), F.sum("n").alias("n"))
    held = staged(means.groupBy("label", "size").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "mean"))).alias("means"), F.sum(F.col("mean") * F.col("mean")).alias("cc"),
    ))
    left = F.greatest(F.lit(LEAST_LEFT), F.when(F.col("cc") < similarity, (similarity - F.col("cc")) / (1 - F.col("cc"))).otherwise(LEAST_LEFT))
    # The probability that a random plane does not part a pair, and how many bits may be asked for in so many passes.
    same = 1 - F.acos(F.least(left, F.lit(1.0))) / math.pi
    found = held.withColumn("same", same)
    bits = F.log(F.lit(1 - missed ** (1 / MOST_PASSES))) / F.log("same") - SPARE_BITS
    wide = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") / F.pow(F.lit(2.0), bits))))
    most_wide = F.lit(float(max(window, MOST_WINDOW)))
    wide = F.least(most_wide, F.greatest(F.lit(float(window)), wide))
    found = found.withColumn("window", F.when(F.col("same") >= 1, window).otherwise(wide).cast("int"))
    meet = F.pow("same", F.greatest(F.lit(0.0), F.log2(F.col("n") / F.col("window"))) + SPARE_BITS)
    needed = F.when(meet >= 1, 1).otherwise(F.ceil(F.log(F.lit(missed)) / F.log1p(-meet)))
    return staged(found.select(
        "label", "size", F.transform("means", lambda m: m["mean"]).alias("centre"), F.greatest(F.lit(passes), needed).cast("int").alias("passes"), "window",
    ))


def passes_for(count: int, similarity: float, window: int, missed: float = MISSED) -> int:
    """How many passes miss a pair at ``similarity`` among ``count`` vectors with at most the probability ``missed``.

    A pair lands in one window if its first bits agree, as many as leave about
    half a window of vectors with equal bits; each does so with the probability
    that a random plane does not part the two. The bits count as even, so labels
    whose unlinked vectors crowd together are missed more often.
    """
    same = 1 - math.acos(max(-1.0, min(1.0, similarity))) / math.pi
    meet = same ** (max(0.0, math.log2(max(1, count) / window)) + SPARE_BITS)
    if meet >= 1:
        return 1
    return math.ceil(math.log(missed) / math.log1p(-meet))


def keys_of(vector: Column, centre: Column, passes: Column, bits: int = BITS) -> Column:
    """One key per pass: the signs of the projections of a unit vector less the centre, the first direction's as the highest bit."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(batch: pa.Array, centres: pa.Array, wanted: pa.Array) -> pa.Array:
        vectors, numbers = [np.asarray(v) for v in batch.to_pylist()], np.array(wanted.to_pylist(), dtype=np.int64)
        out = np.zeros((len(vectors), int(numbers.max(initial=0))), dtype=np.int64)
        sizes = np.array([len(v) for v in vectors])
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            off = centres.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), size)
            units = unit_rows([vectors[r] for r in rows]) - off
            for number in range(int(numbers[rows].max())):
                still = numbers[rows] > number
                out[rows[still], number] = (units[still] @ _directions(number, int(size), bits) > 0) @ weights
        return pa.array([o[:n] for o, n in zip(out, numbers)], pa.list_(pa.int64()))

    return keys(vector, centre, passes)


# -- passes ------------------------------------------------------------------


def _links_in(rows: pd.DataFrame, similarity: float, window: int) -> pd.DataFrame:
    """A spanning forest of the verified pairs at most ``window`` places apart."""
    rows = rows.sort_values("place")
    ids = rows["node"].to_numpy()
    labels = np.arange(len(ids))
    units = unit_rows(list(rows["vector"]))
    for start in range(0, len(ids), window):
        near = units[start:start + 2 * window]
        left, right = np.nonzero(np.triu(near[:window] @ near.T >= similarity, 1))
        close = right - left <= window
        labels = join_labels(labels, left[close] + start, right[close] + start)
    moved = np.flatnonzero(labels != np.arange(len(ids)))
    return pd.DataFrame({"a": ids[moved], "b": ids[labels[moved]]})


def close_links(nodes: DataFrame, similarity: float, passes: int, bits: int, window: int, block_rows: int) -> DataFrame:
    """Links ``(a, b)`` between nodes ``(node, label, vector)`` that the passes find, ``passes`` or more of a label."""
    sized = nodes.withColumn("size", F.size("vector"))
    how = centres(sized, similarity, passes, window)
    keyed = sized.join(how, ["label", "size"]).select(
        "node", "label", "size", "window", F.posexplode(keys_of(F.col("vector"), F.col("centre"), F.col("passes"), bits)).alias("pass", "key"),
    )
    order = ["pass", "label", "size", "key", "node"]
    parts = max(passes, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Places in the whole order: what each sorted part holds is counted, and parts start where those before end.
    ordered = staged(
        keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    )
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")).sort("part").collect()
    ahead = np.cumsum([0] + [r["n"] for r in sizes]).tolist()  # one number for each part
    if not sizes:
        return nodes.sparkSession.createDataFrame([], "a BIGINT, b BIGINT")
    shift = F.create_map(*[F.lit(x) for r, n in zip(sizes, ahead) for x in (r["part"], n - r["first"])])
    placed = ordered.withColumn("place", F.col("row") + F.element_at(shift, F.col("part")))
    rows = F.greatest(F.lit(block_rows), 4 * F.col("window"))
    block = F.floor(F.col("place") / rows)
    late = F.col("place") % rows >= rows - F.col("window")
    blocks = placed.withColumn("block", F.explode(F.when(late, F.array(block, block + 1)).otherwise(F.array(block))))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return _links_in(rows, similarity, int(rows["window"].iloc[0]))

    return (
        blocks.select("pass", "label", "size", "block", "place", "window", "node").join(nodes.select("node", "vector"), "node")
        .groupBy("pass", "label", "size", "block").applyInPandas(compare, "a BIGINT, b BIGINT")
    )


# -- counts ------------------------------------------------------------------


def _count_links(grouped: DataFrame, similarity: float, chunk_rows: int) -> DataFrame:
    """``(node, linked)``: copies of other nodes directly linked, for nodes ``(component, node, copies, vector)``."""
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    sizes = staged(sizes.select("component", F.ceil(F.col("rows") / chunk_rows).cast("int").alias("chunks")))
    own = grouped.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    meeting = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "component", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "own",
        "node", "copies", "vector",
    )

    def count(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["own"].to_numpy()
        units, copies = unit_rows(list(rows["vector"])), rows["copies"].to_numpy()
        a, b = np.flatnonzero(own == group[1]), np.flatnonzero(own == group[2])
        linked = np.zeros(len(rows), dtype=np.int64)
        if len(a) and len(b):
            near = units[a] @ units[b].T >= similarity
            if group[1] == group[2]:
                np.fill_diagonal(near, False)
            linked[a] = near @ copies[b]
            if group[1] != group[2]:
                linked[b] = copies[a] @ near
        return pd.DataFrame({"node": rows["node"].to_numpy(), "linked": linked})

    found = meeting.groupBy("component", "first", "second").applyInPandas(count, "node BIGINT, linked BIGINT")
    return found.groupBy("node").agg(F.sum("linked").alias("linked"))


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    similarity: float = SIMILARITY, passes: int = PASSES, bits: int = BITS, window: int = WINDOW,
    block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(<id_col>, n_links, component_id, kept)``, one row per row of ``table``.

    Vectors link only under equal labels that are not null, and only with vectors
    of their own length. Unusable vectors (see :func:`is_usable`) and rows with
    a null label link with nothing: they are a component of their own. A row's
    component is the smallest id reachable, its own if nothing else is; a row
    without an id has a null component if it reaches no id, and is never kept.
    """
    usable = is_usable(F.col(vector_col)) & F.col(label_col).isNotNull()
    rows = staged(table.select(
        F.col(id_col).alias("id"), F.when(usable, F.struct(F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))).alias("what"),
    ))
    # Equal vectors of a label are one node. Its number is an id of this table alone, so ids may repeat or be null.
    nodes = staged(
        rows.where("what IS NOT NULL").groupBy("what").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .select("what.label", "what.vector", "first_id", "copies", F.monotonically_increasing_id().alias("node"))
    )
    links = close_links(nodes.select("node", "label", "vector"), similarity, passes, bits, window, block_rows)
    parts = connected_components(links).withColumnRenamed("id", "node")
    grouped = staged(nodes.join(parts, "node"))
    linked = checkpointed(_count_links(grouped.select("component", "node", "copies", "vector"), similarity, chunk_rows))
    names = staged(grouped.groupBy("component").agg(F.min("first_id").alias("named")))
    placed = staged(
        nodes.join(grouped.select("node", "component"), "node", "left").join(names, "component", "left").join(linked, "node", "left")
        .select(
            F.struct("label", "vector").alias("what"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("named")).alias("component_id"),
        )
    )
    found = rows.join(placed, "what", "left")
    component = F.when(F.col("what").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
