"""Nearest neighbours through one hierarchical navigable small-world graph per shard.

Rows are dealt to shards of bounded size by a hash of their vector. A shard's
graph is built by inserting its vectors one after another, those of the highest
levels first, so that the nodes of a level are a prefix and each level is one
flat array of neighbours. Graphs are stored as rows of a table. Queries are
packed into blocks, each block meets every shard's graph once, and the shards'
best rows are merged. Every row is indexed: the search is approximate, the index
is complete. Equal vectors are one node that carries its smallest ids.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import staged
from shopstream.llm.projection import is_usable, unit_rows

SHARD_ROWS = 4096
MOST_SHARD_ROWS = 1 << 16
QUERY_ROWS = 4096
LINKS = 16
BUILD_WIDTH = 64
SEARCH_WIDTH = 128
SHARD_GROWTH = 32
CLOSE = 1e-5
SEED = 11


# -- graph -------------------------------------------------------------------


def _diverse(sims: np.ndarray, between: np.ndarray, number: int) -> list[int]:
    """Up to ``number`` candidates, those first that are nearer to the base than to any already taken, then the nearest."""
    order = np.argsort(-sims, kind="stable").tolist()
    if len(order) <= number:
        return order
    taken, nearest = [], np.full(len(sims), -2.0, dtype=between.dtype)
    for i in order:
        if sims[i] > nearest[i]:
            taken.append(i)
            if len(taken) == number:
                return taken
            np.maximum(nearest, between[i], out=nearest)
    have = set(taken)
    return taken + [i for i in order if i not in have][:number - len(taken)]


class Graph:
    """A searchable graph over unit vectors; ``layers[l]`` holds the neighbours of the first nodes, -1 for none."""

    def __init__(self, units: np.ndarray, layers: list[np.ndarray]):
        self.units, self.layers = units, layers
        self.seen = np.zeros(len(units), dtype=np.int64)
        self.round = 0

    @classmethod
    def built(cls, units: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH) -> Graph:
        """``units`` are put in order of level by the caller; see :func:`levels`."""
        sizes = level_sizes(len(units), links)
        layers = [np.full((n, links if i else 2 * links), -1, dtype=np.int32) for i, n in enumerate(sizes)]
        graph = cls(units.astype(np.float32), layers)
        for node in range(1, len(units)):
            graph._insert(node, width, links)
        return graph

    def _near(self, base: np.ndarray, entries: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """The ``width`` best nodes found on a layer from the entries, as (similarity, node), unordered."""
        self.round += 1
        seen, stamp, links, units = self.seen, self.round, self.layers[layer], self.units
        seen[[n for _, n in entries]] = stamp
        waiting = [(-s, n) for s, n in entries]
        heapq.heapify(waiting)
        best = list(entries)
        heapq.heapify(best)
        while waiting:
            far, node = heapq.heappop(waiting)
            if len(best) >= width and -far < best[0][0]:
                break
            near = links[node]
            near = near[near >= 0]
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            sims = units[near] @ base
            if len(best) >= width:
                better = sims > best[0][0]
                near, sims = near[better], sims[better]
            for sim, other in zip(sims.tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (sim, other))
                elif sim > best[0][0]:
                    heapq.heapreplace(best, (sim, other))
                else:
                    continue
                heapq.heappush(waiting, (-sim, other))
        return best

    def _insert(self, node: int, width: int, links: int) -> None:
        base = self.units[node]
        entries = [(float(self.units[0] @ base), 0)]
        for layer in range(len(self.layers) - 1, -1, -1):
            if node >= len(self.layers[layer]):
                entries = [max(self._near(base, entries, 1, layer))]
                continue
            entries = self._near(base, entries, width, layer)
            near = np.array([n for _, n in entries])
            sims = np.array([s for s, _ in entries], dtype=np.float32)
            chosen = near[_diverse(sims, self.units[near] @ self.units[near].T, links)]
            self.layers[layer][node, :len(chosen)] = chosen
            for other in chosen.tolist():
                self._link_back(self.layers[layer][other], other, node)

    def _link_back(self, row: np.ndarray, other: int, node: int) -> None:
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = node
            return
        near = np.append(row, node)
        vectors = self.units[near]
        row[:] = near[_diverse(vectors @ self.units[other], vectors @ vectors.T, len(row))]

    def search(self, base: np.ndarray, width: int) -> np.ndarray:
        """The nodes found nearest to a unit vector, at most ``width``, unordered."""
        base = base.astype(np.float32)
        entries = [(float(self.units[0] @ base), 0)]
        for layer in range(len(self.layers) - 1, 0, -1):
            entries = [max(self._near(base, entries, 1, layer))]
        return np.array([n for _, n in self._near(base, entries, width, 0)])


def level_sizes(count: int, links: int) -> list[int]:
    """How many nodes stand on each level: each has 1 in ``links`` of the level below."""
    sizes = [count]
    while sizes[-1] > links:
        sizes.append(-(-sizes[-1] // links))
    return sizes


# -- tables ------------------------------------------------------------------


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _classes(table: DataFrame, id_col: str, vector_col: str, ids: int) -> DataFrame:
    """``(vector, ids)``: distinct usable vectors with their ``ids`` smallest ids, no more of which a result can need."""
    rows = table.where(is_usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
    ).distinct()
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = rows.withColumn("place", place).where(F.col("place") <= ids)
    return first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def build_index(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", ids: int = 6, shard_rows: int | None = None,
    links: int = LINKS, width: int = BUILD_WIDTH,
) -> DataFrame:
    """``(size, shard, index)``: a written table of graphs, each with its vectors and their ids, for vectors of one length.

    Shards grow with the root of the table unless ``shard_rows`` is given, from
    ``SHARD_ROWS`` to ``MOST_SHARD_ROWS``: every query visits every shard, and a
    task builds one.
    """
    classes = staged(_classes(table, id_col, vector_col, ids).withColumn("size", F.size("vector")))
    count = classes.count()
    shard_rows = shard_rows or int(min(MOST_SHARD_ROWS, max(SHARD_ROWS, SHARD_GROWTH * count ** 0.5)))
    shards = max(1, -(-count // shard_rows))
    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))

    def build(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array(list(rows["vector"]))
        order = np.lexsort(vectors.T)  # so that a shard's graph doesn't depend on how its rows arrive
        order = order[np.random.default_rng(SEED).permutation(len(order))]
        vectors, held = vectors[order], [rows["ids"].iloc[i] for i in order]
        graph = Graph.built(unit_rows(list(vectors)), links, width)
        layers = {f"layer{i}": layer for i, layer in enumerate(graph.layers)}
        ends = np.cumsum([len(h) for h in held])
        packed = _packed(vectors=vectors, ids=np.concatenate(held), ends=ends, **layers)
        return pd.DataFrame({"size": [group[0]], "shard": [group[1]], "index": [packed]})

    return staged(dealt.groupBy("size", "shard").applyInPandas(build, "size INT, shard INT, index BINARY"))


def _query_blocks(queries: DataFrame, block_rows: int) -> DataFrame:
    """``(size, queries)``: queries ``(id, vector)`` packed into blocks of about ``block_rows``."""
    blocks = max(1, -(-queries.count() // block_rows))
    dealt = queries.withColumns({"size": F.size("vector"), "block": F.pmod(F.xxhash64("id", "vector"), F.lit(blocks))})

    def pack(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        packed = _packed(ids=rows["id"].to_numpy(), vectors=np.array(list(rows["vector"])))
        return pd.DataFrame({"size": [group[0]], "queries": [packed]})

    return staged(dealt.groupBy("size", "block").applyInPandas(pack, "size INT, queries BINARY"))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square overflows or vanishes; cosines stay as they are, to the last bit."""
    _, power = np.frexp(np.abs(rows).max(1, keepdims=True))
    return np.ldexp(rows, -power)


def _near_enough(graph: Graph, vectors: np.ndarray, vector: np.ndarray, unit: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their cosines: the ``k`` + 1 best found, and all that tie with the last of them.

    The search goes by single precision and by a list of ``width``. As long as
    its last node might tie with a wanted one, the list is made wider.
    """
    norm = np.sqrt(vector @ vector)
    while True:
        nodes = graph.search(unit, max(width, k + 1))
        scores = vectors[nodes] @ vector / (np.sqrt((vectors[nodes] * vectors[nodes]).sum(1)) * norm)
        if len(nodes) <= k + 1:
            return nodes, scores
        last = np.partition(scores, -k - 1)[-k - 1]
        if len(nodes) < width or len(nodes) == len(vectors) or scores.min() < last - CLOSE:
            wanted = scores >= last
            return nodes[wanted], scores[wanted]
        width *= 2


def _best_in_shard(
    index: dict[str, np.ndarray], queries: dict[str, np.ndarray], k: int, width: int,
) -> Iterator[tuple[int, int, float]]:
    layers = [index[f"layer{i}"] for i in range(sum(n.startswith("layer") for n in index))]
    vectors, ids, ends = scaled(index["vectors"]), index["ids"], index["ends"]
    graph = Graph(unit_rows(list(vectors)).astype(np.float32), layers)
    asked = scaled(queries["vectors"])
    for own, vector, unit in zip(queries["ids"].tolist(), asked, unit_rows(list(asked))):
        found = []
        for node, score in zip(*(x.tolist() for x in _near_enough(graph, vectors, vector, unit, k, width))):
            held = ids[ends[node - 1] if node else 0:ends[node]].tolist()
            found += [(-score, other) for other in held if other != own]
        for score, other in sorted(found)[:k]:
            yield own, other, -score


def search(
    index: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    width: int = SEARCH_WIDTH, block_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, <id_col>, score)``: each query's ``k`` nearest by cosine, fewer if there are fewer.

    Nearest first, ties to the smaller id, ranks from 1. The query's own id is no
    candidate. Queries that are unusable or have no id give no rows; queries
    alike in all give theirs once.
    """
    asked = staged(queries.where(is_usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
    ).distinct())
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    blocks = _query_blocks(asked, block_rows).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                parts = (batch.column(name)[row].as_py() for name in ("index", "queries"))
                loaded = [dict(np.load(io.BytesIO(p))) for p in parts]
                found = list(_best_in_shard(loaded[0], loaded[1], k, width))
                yield pa.RecordBatch.from_pylist(
                    [{"query_id": q, "id": i, "score": s} for q, i, s in found],
                    pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]),
                )

    met = blocks.join(index, ["size", "shard"]).select("index", "queries")
    found = met.mapInArrow(look, "query_id BIGINT, id BIGINT, score DOUBLE")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )


def nearest(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", **how: int) -> DataFrame:
    """The ``k`` nearest rows of ``table`` for those of its rows where ``is_query``; see :func:`search`."""
    return search(build_index(table, id_col, vector_col, k + 1, **how), table.where(is_query), k, id_col, vector_col)
