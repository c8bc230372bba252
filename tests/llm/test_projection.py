import math

import numpy as np
import pytest

from shopstream.llm import hnsw, projection, queries

ROWS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, component_id STRING"


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def cosine(a, b):
    a, b = np.array(a, dtype=float), np.array(b, dtype=float)
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def rough_vectors():
    pick = np.random.default_rng(5)
    base = pick.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + 0.08 * pick.normal(size=16)).tolist(), i % 3, "x") for i in range(90)]
    rows += [(200 + i, pick.normal(size=16).tolist(), i % 3, "x") for i in range(60)]
    rows += [(300 + i, rows[4][1], 1, "x") for i in range(30)]  # equal vectors
    rows += [(400, (np.array(rows[4][1]) * 1000).tolist(), 1, "x"), (401, (np.array(rows[4][1]) * 1e-30).tolist(), 1, "x")]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1, ""), (501, [0.0] * 16, 1, ""), (502, [nan] + [1.0] * 15, 1, ""), (503, [inf] + [1.0] * 15, 1, "")]
    rows += [(504, [None] + [1.0] * 15, 1, ""), (505, [], 1, ""), (506, rows[4][1], None, ""), (507, rows[4][1], 2, ""), (508, [1.0, 2.0], 1, "")]
    return rows + [(None, rows[4][1], 1, ""), (None, [5.0] * 16, 0, ""), (7, rows[7][1], 1, ""), (7, rows[8][1], 2, "")]


def plain(rows, similarity=0.93):
    def linked(a, b):
        return a is not b and a[2] is not None and a[2] == b[2] and usable(a[1]) and usable(b[1]) and len(a[1]) == len(b[1]) \
            and cosine(a[1], b[1]) >= similarity

    near = [[j for j, b in enumerate(rows) if linked(a, b)] for a in rows]
    low = [math.inf if r[0] is None else r[0] for r in rows]
    while True:
        new = [min([low[i], *(low[j] for j in near[i])]) for i in range(len(rows))]
        if new == low:
            break
        low = new
    parts = [None if x == math.inf else x for x in low]
    return sorted(str((r[0], len(n), p, r[0] is not None and r[0] == p)) for r, n, p in zip(rows, near, parts))


@pytest.fixture
def table(spark):
    return spark.createDataFrame(rough_vectors(), ROWS).repartition(3)


@pytest.mark.parametrize("sizes", [{}, {"window": 4, "block_rows": 16, "chunk_rows": 5, "passes": 24}])
def test_links_equal_brute_force(table, sizes):
    rows = [tuple(r) for r in table.collect()]
    found = sorted(str(tuple(r)) for r in projection.near_duplicates(table, **sizes).collect())
    assert found == plain(rows)


def test_empty_table(table):
    assert projection.near_duplicates(table.where("false")).count() == 0
    assert projection.near_duplicates(table.where("embedding IS NULL")).count() == 1


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(str(tuple(r)) for r in queries.op4_projection(spark, sf_dir).collect()) == plain(rows)


# -- nearest neighbours ------------------------------------------------------


def plain_nearest(rows, queries_, k):
    out = {}
    for q in queries_:
        found = {(-round(cosine(q[1], r[1]), 12), r[0]) for r in rows
                 if r[0] is not None and r[0] != q[0] and usable(r[1]) and len(r[1]) == len(q[1])}
        out[q[0]] = [i for _, i in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [4096, 20])
def test_neighbours_equal_brute_force(table, shard_rows):
    rows = [tuple(r) for r in table.collect() if r["vec_id"] != 7]
    unique = table.where("vec_id != 7 OR vec_id IS NULL")
    asked = [r for r in rows if r[0] is not None and r[0] % 10 == 0 and usable(r[1])]
    found = hnsw.nearest(unique, hnsw.F.col("vec_id") % 10 == 0, shard_rows=shard_rows).orderBy("query_id", "rank").collect()
    got = {}
    for row in found:
        got.setdefault(row["query_id"], []).append(row["vec_id"])
        assert row["rank"] == len(got[row["query_id"]])
    want = {q: ids for q, ids in plain_nearest(rows, asked, 5).items() if ids}
    assert set(got) == set(want)
    right = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert right >= 0.97 * sum(map(len, want.values()))


def test_few_candidates_ties_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1, ""), (3, [2.0, 0.0], 1, ""), (2, [2.0, 0.0], 1, ""), (9, [0.0, 1.0], 1, "")]
    table = spark.createDataFrame(rows, ROWS)
    found = hnsw.nearest(table, hnsw.F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found] == [(1, 2, 1.0), (2, 3, 1.0), (3, 9, 0.0)]
    assert hnsw.nearest(table.where("vec_id = 0"), hnsw.F.col("vec_id") == 0).count() == 0
    assert hnsw.nearest(table.where("false"), hnsw.F.col("vec_id") == 0).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    """Forty rows equally near, in shuffled order, and a hundred and fifty that all miss the query."""
    pick = np.random.default_rng(6)
    rows = [(1000, [1.0] + [0.0] * 200, 1, "")]
    for i in range(40):
        rows.append((i + 1, [1.0 if j == 0 else 2.0 if j == i + 1 else 0.0 for j in range(201)], 1, ""))
    rows += [(100 + i, [1.0 if j == i + 45 else 0.0 for j in range(201)], 1, "") for i in range(150)]
    rows += [(2000, [0.0] * 200 + [3.0], 1, "")]
    rows = [rows[i] for i in pick.permutation(len(rows))]
    table = spark.createDataFrame(rows, ROWS.replace("FLOAT", "DOUBLE"))
    for shard_rows in (None, 40):
        found = hnsw.nearest(table, hnsw.F.col("vec_id").isin(1000, 2000), shard_rows=shard_rows).orderBy("query_id", "rank").collect()
        assert [(r["query_id"], r["vec_id"]) for r in found] == [(1000, i) for i in range(1, 6)] + [(2000, i) for i in range(1, 6)]


def test_huge_and_tiny_components(spark):
    base = np.random.default_rng(7).normal(size=(30, 8))
    rows = [(i, (base[i] * 10.0 ** (200 * (i % 3 - 1))).tolist(), 1, "") for i in range(30)]
    found = hnsw.nearest(spark.createDataFrame(rows, ROWS.replace("FLOAT", "DOUBLE")), hnsw.F.col("vec_id") % 5 == 0).collect()
    want = plain_nearest([(i, b.tolist()) for i, b in enumerate(base)], [(i, base[i].tolist()) for i in range(0, 30, 5)], 5)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert abs(r["score"] - cosine(base[r["query_id"]], base[r["vec_id"]])) < 1e-12
    assert got == want


def test_graph_reaches_every_node():
    units = projection.unit_rows(list(np.random.default_rng(2).normal(size=(600, 8))))
    graph = hnsw.Graph.built(units)
    assert [len(x) for x in graph.layers] == hnsw.level_sizes(600, hnsw.LINKS)
    assert all(i in graph.search(u, 32) for i, u in enumerate(units))


def test_recall_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = plain_nearest(rows, [r for r in rows if r[0] % 50 == 0], 5)
    found = [(r["query_id"], r["vec_id"]) for r in queries.op9_hnsw(spark, sf_dir).collect()]
    assert sum(i in want[q] for q, i in found) >= 0.9 * sum(map(len, want.values()))


# -- passes ------------------------------------------------------------------


def pairs_at(similarity, count, size=32):
    """Twice ``count`` vectors, each of the first half with one at this cosine in the second."""
    pick = np.random.default_rng(11)
    left = projection.unit_rows(list(pick.normal(size=(count, size))))
    other = pick.normal(size=(count, size))
    other -= (other * left).sum(1, keepdims=True) * left
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return np.concatenate([left, similarity * left + math.sqrt(1 - similarity**2) * other])


def test_passes_grow_with_the_label(spark):
    units = pairs_at(0.9301, 1500)
    rows = [(i, u.tolist(), 1, "") for i, u in enumerate(units)]
    table = spark.createDataFrame(rows, ROWS.replace("FLOAT", "DOUBLE"))
    found = projection.near_duplicates(table, window=4, block_rows=64).where("n_links = 0").count()
    assert found <= 2 * 5


def test_crowded_labels(spark):
    """Vectors around one centre, with a mean cosine of 0.87, of which each has a partner at 0.94."""
    pick, size, count = np.random.default_rng(3), 64, 2500
    centre = projection.unit_rows([pick.normal(size=size)])[0]
    own = pick.normal(size=(count, size))
    own -= np.outer(own @ centre, centre)
    own = projection.unit_rows(list(own))
    other = pick.normal(size=(count, size))
    other -= np.outer(other @ centre, centre) + (other * own).sum(1, keepdims=True) * own
    other = projection.unit_rows(list(other))
    left, part = 0.13, (0.94 - 0.87) / 0.13  # what the centre leaves of a vector, and the cosine of two such rests
    rest = [own, part * own + math.sqrt(1 - part**2) * other]
    units = np.concatenate([math.sqrt(1 - left) * centre + math.sqrt(left) * r for r in rest])
    near = units @ units.T >= 0.93
    np.fill_diagonal(near, False)
    table = spark.createDataFrame([(i, u.tolist(), 1, "") for i, u in enumerate(units)], ROWS.replace("FLOAT", "DOUBLE"))
    found = {r["vec_id"]: r["n_links"] for r in projection.near_duplicates(table).collect()}
    want = near.sum(1)
    assert sum(want) >= 2 * count and sum(found[i] for i in range(2 * count)) >= 0.99 * sum(want)
    assert all(found[i] <= want[i] for i in range(2 * count))


def test_passes_of_a_label_of_a_hundred_thousand():
    units = pairs_at(0.9301, 50_000)
    missed = np.ones(50_000, dtype=bool)
    weights = 1 << np.arange(projection.BITS - 1, -1, -1, dtype=np.int64)
    for number in range(projection.passes_for(len(units), 0.93, projection.WINDOW)):
        keys = (units @ projection._directions(number, 32, projection.BITS) > 0) @ weights
        place = np.argsort(np.argsort(keys, kind="stable"))
        missed &= np.abs(place[:50_000] - place[50_000:]) > projection.WINDOW
    assert missed.mean() <= projection.MISSED
