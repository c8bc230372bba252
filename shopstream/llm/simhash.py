"""Near duplicates by SimHash: Burkhard-Keller trees over shards of fingerprints.

A fingerprint's bits are cut into blocks. Two fingerprints that differ in at most
``radius`` bits agree in all but ``radius`` of the blocks, so they meet in the
shard of some combination of equal blocks. Each shard becomes a BK-tree (children
keyed by their integer Hamming distance to the parent) kept in flat arrays, and a
search follows only the edges within the radius of the node's own distance. The
number of blocks follows from the number of fingerprints, so shards keep their
size as the corpus grows. A shard above ``SHARD_ROWS`` is cut into several trees,
and every tree goes to the tasks that search its own shard, by shuffle: sent to
all executors at once, the trees would bring every fingerprint to the driver.

A task hands on a spanning forest of the links it finds, never all pairs.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm.common import staged
from shopstream.llm.components import connected_components, join_labels

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
AIM_ROWS = 512
SHARD_ROWS = 4096
SEARCH_ROWS = 256


# -- fingerprints ------------------------------------------------------------


def shingles(text: bytes, size: int) -> list[bytes]:
    """The runs of ``size`` words, A-Z lower-cased; the whole sequence if it is shorter, none for no words."""
    words = text.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-size].tolist()]
    return [line[a:b] for a, b in zip(starts, (ends[size - 1:] - 1).tolist())]


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Bits set in more than half of the hashed shingles, repeats counted; zero without words."""
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles(text, size)], dtype="<u8")
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_of(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint of a text as a signed 64-bit number; a null text counts as empty."""

    @F.arrow_udf(T.LongType())
    def prints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py() or b"", size) for t in texts], pa.int64())

    return prints(text.cast("binary"))


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# -- trees -------------------------------------------------------------------


class Tree:
    """A BK-tree over ``points`` (rows of 64-bit words): node i is point i, node 0 the root."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.span = points.shape[1] * BITS + 1
        at = np.zeros(len(points), dtype=np.int64)
        edge_of = np.zeros(len(points), dtype=np.int64)
        waiting = np.arange(1, len(points))
        while len(waiting):
            edge = at[waiting] * self.span + distance(points[waiting], points[at[waiting]])
            _, first, which = np.unique(edge, return_index=True, return_inverse=True)
            heads = waiting[first]
            edge_of[heads] = edge[first]
            at[waiting] = heads[which]
            waiting = np.delete(waiting, first)
        order = np.argsort(edge_of[1:], kind="stable")
        self.edges, self.children = edge_of[1:][order], order + 1

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at most ``radius`` apart."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        found_query, found_node = [], []
        while len(query):
            far = distance(queries[query], self.points[node])
            hit = far <= radius
            found_query.append(query[hit])
            found_node.append(node[hit])
            edge = node * self.span
            low = np.searchsorted(self.edges, edge + np.maximum(far - radius, 0))
            high = np.searchsorted(self.edges, edge + np.minimum(far + radius, self.span - 1), side="right")
            count = high - low
            query = np.repeat(query, count)
            shift = np.repeat(low - np.cumsum(count) + count, count)
            node = self.children[shift + np.arange(len(shift))]
        return np.concatenate(found_query or [query]), np.concatenate(found_node or [node])


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(1, dtype=np.int64)


def _forest(rows: pd.DataFrame, words: int, tree_of: int, search_of: int, radius: int) -> pd.DataFrame:
    """Each node with the first node of its group, where links join the tree's points and the searching ones."""
    rows = rows.sort_values("node")
    points = np.stack([rows[f"p{i}"].to_numpy().view(np.uint64) for i in range(words)], axis=1)
    nodes, own = rows["node"].to_numpy(), rows["own"].to_numpy()
    in_tree, searching = np.flatnonzero(own == tree_of), np.flatnonzero(own == search_of)
    labels = np.arange(len(points))
    if len(in_tree) and len(searching):
        tree = Tree(points[in_tree])
        for start in range(0, len(searching), SEARCH_ROWS):
            part = searching[start:start + SEARCH_ROWS]
            query, node = tree.within(points[part], radius)
            labels = join_labels(labels, part[query], in_tree[node])
    moved = np.flatnonzero(labels != np.arange(len(points)))
    return pd.DataFrame({"a": nodes[moved], "b": nodes[labels[moved]]})


# -- shards ------------------------------------------------------------------


def shard_bits(count: int, aim: int = AIM_ROWS) -> int:
    """How many bits name a shard, for shards of about ``aim`` rows."""
    return math.ceil(math.log2(count / aim)) if count > 2 * aim else 1


def shard_plan(count: int, radius: int, aim: int = AIM_ROWS) -> tuple[list[tuple[tuple[int, int], ...]], int]:
    """Combinations of blocks (first bit, width), and how many of their bits name a shard.

    With k blocks, every k - radius of them make a combination. More
    fingerprints need more bits to keep shards at ``aim`` rows, hence more blocks.
    """
    wanted = shard_bits(count, aim)
    for k in range(radius + 1, BITS + 1):
        cuts = [i * BITS // k for i in range(k + 1)]
        blocks = [(a, b - a) for a, b in itertools.pairwise(cuts)]
        combinations = list(itertools.combinations(blocks, k - radius))
        bits = min(sum(w for _, w in c) for c in combinations)
        if bits >= wanted or k == radius + 4:
            return combinations, min(bits, wanted)
    raise ValueError("radius must be below the number of bits")


def _shard_key(combination: tuple[tuple[int, int], ...], bits: int) -> Column:
    """The first ``bits`` bits of a combination, taken from the low end of each block in turn."""
    key, used = F.lit(0).cast("bigint"), 0
    share = -(-bits // len(combination))
    for first, width in combination:
        take = min(width, share, bits - used)
        part = F.shiftrightunsigned("p0", first).bitwiseAND(F.lit((1 << take) - 1).cast("bigint"))
        key, used = key.bitwiseOR(F.shiftleft(part, used)), used + take
    return key


def _links_in_shards(points: DataFrame, keys: list[Column], words: int, radius: int, shard_rows: int) -> DataFrame:
    """Links ``(a, b)`` that join the nodes of ``points`` that meet in a shard at most ``radius`` apart."""
    node_type = points.schema["node"].dataType.simpleString()
    columns = ["node", *[f"p{i}" for i in range(words)]]
    keyed = points.select(
        *columns, F.explode(F.array(*[F.struct(F.lit(i).alias("way"), k.alias("key")) for i, k in enumerate(keys)])).alias("shard"),
    ).select("shard.*", *columns)
    large = (
        keyed.groupBy("way", "key").agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > shard_rows)
        .select("way", "key", F.ceil(F.col("rows") / shard_rows).cast("int").alias("trees"))
    )
    own = keyed.join(large, ["way", "key"], "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    own = own.withColumn("own", F.pmod(F.xxhash64("node"), F.col("trees")).cast("int"))
    meeting = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
    meeting = meeting.select(
        "way", "key", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("search"), "own", *columns,
    )

    def search(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _forest(rows, words, group[2], group[3], radius)

    return meeting.groupBy("way", "key", "tree", "search").applyInPandas(search, f"a {node_type}, b {node_type}")


def close_links(prints: DataFrame, radius: int = RADIUS, aim: int = AIM_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``(a, b)`` that join the distinct fingerprints in column ``fp`` at most ``radius`` bits apart.

    The links have the same connected components as all such pairs.
    """
    combinations, bits = shard_plan(prints.count(), radius, aim)
    points = prints.select(F.col("fp").alias("node"), F.col("fp").alias("p0"))
    return _links_in_shards(points, [_shard_key(c, bits) for c in combinations], 1, radius, shard_rows)


def _placed(classes: DataFrame, radius: int, aim: int, shard_rows: int) -> DataFrame:
    """``classes``, one row for each fingerprint ``fp``, with the smallest fingerprint it reaches as ``component``."""
    parts = connected_components(close_links(classes.select("fp"), radius, aim, shard_rows)).withColumnRenamed("id", "fp")
    return classes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS,
    aim: int = AIM_ROWS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Each document's fingerprint and its component: ``(<id_col>, fp, component, component_id)``.

    One row per row of ``docs``; other columns are left out, whatever their
    names. Null and blank texts have fingerprint zero and link like any other.
    ``component`` is the smallest fingerprint reachable and ``component_id`` the
    smallest id, null only if all ids reachable are null; rows that repeat an id
    each keep their own fingerprint.
    """
    prints = staged(docs.select(F.col(id_col).alias("id"), fingerprint_of(F.col(text_col), size).alias("fp")))
    classes = staged(prints.groupBy("fp").agg(F.min("id").alias("first")))
    placed = staged(_placed(classes, radius, aim, shard_rows))
    names = staged(placed.groupBy("component").agg(F.min("first").alias("component_id")))
    placed = staged(placed.join(names, "component").select("fp", "component", "component_id"))
    return prints.join(placed, "fp").select(F.col("id").alias(id_col), "fp", "component", "component_id")


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS,
    aim: int = AIM_ROWS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``docs`` with one row left of each component of :func:`simhash_components`: that with the smallest id.

    A row without an id stays only where its whole component has none; of rows
    that repeat an id, one stays. Null and blank texts are one component like any
    other. All columns are kept as they are. Rows are numbered in the written
    table that also holds their fingerprints, so that all is decided on numbers,
    and the texts are looked up once.
    """
    rows = staged(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        fingerprint_of(F.col(text_col), size).alias("fp"), F.struct(*docs.columns).alias("doc"),
    ))
    first = F.min(F.struct(F.col("id").isNull().alias("without"), F.col("id").alias("id"), F.col("row").alias("row")))
    classes = staged(rows.groupBy("fp").agg(first.alias("first")))
    kept = staged(_placed(classes, radius, aim, shard_rows).groupBy("component").agg(F.min("first").alias("first")).select("first.row"))
    # As many numbers as texts: sending them to all tasks would only do for few.
    return rows.join(kept.hint("merge"), "row", "left_semi").select("doc.*")
