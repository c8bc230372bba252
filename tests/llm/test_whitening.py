import math

import numpy as np
import pytest

from shopstream.llm import queries, whitening

ROWS = "vec_id BIGINT, embedding ARRAY<DOUBLE>, component STRING, n STRING, x STRING"


def usable(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def plain(rows):
    """(id, component) to the values, by a full eigendecomposition."""
    whole = [(r[0], [math.floor(256 * c) for c in r[1]]) for r in rows if usable(r[1])]
    out = []
    for size in {len(x) for _, x in whole if x}:
        fit = sorted({tuple(x) for _, x in whole if len(x) == size})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=float) / n
        covariance = centred.T @ centred / n
        values, vectors = np.linalg.eigh(covariance)
        for doc_id, x in whole:
            if len(x) == size:
                off = [n * a - s for a, s in zip(x, sums)]
                for i in range(1, min(4, size) + 1):
                    if values[-i] > 1e-9 * values[-1] and values[-1] > 0:
                        out.append((doc_id, i, n, sum(d * d for d in off), abs(float(np.array(off, dtype=float) / n @ vectors[:, -i])) / math.sqrt(values[-i]), values[-i] / values.sum()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


def agrees(found, rows):
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in found),
                 key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))
    want = plain(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want] and got
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-8, atol=1e-9)
    assert max(r["identity_error"] for r in found) < 1e-9


def rough_vectors():
    pick = np.random.default_rng(4)
    rows = [(i, (pick.normal(size=12) * np.arange(1, 13)).tolist(), "", "", "") for i in range(150)]
    rows += [(200 + i, rows[0][1], "", "", "") for i in range(60)]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None, "", "", ""), (301, [0.0] * 12, "", "", ""), (302, [nan] * 12, "", "", ""), (303, [inf] + [0.0] * 11, "", "", "")]
    rows += [(304, [None] + [1.0] * 11, "", "", ""), (305, [], "", "", ""), (306, [1.0, 2.0], "", "", ""), (307, [3.0, 1.0], "", "", ""), (308, [5.0], "", "", "")]
    return rows + [(None, rows[3][1], "", "", ""), (7, rows[7][1], "", "", ""), (7, rows[8][1], "", "", "")]


def test_components_equal_a_full_decomposition(spark):
    rows = rough_vectors()
    found = whitening.whiten(spark.createDataFrame(rows, ROWS).repartition(4))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    agrees(found.collect(), rows)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    agrees(queries.op12_whitening(spark, sf_dir).collect(), rows)


def test_empty_tables_and_huge_components(spark):
    table = spark.createDataFrame(rough_vectors(), ROWS)
    assert whitening.whiten(table.where("false")).count() == 0
    assert whitening.whiten(table.where("vec_id = 308")).count() == 0
    huge = [(i, [float(i % 3) * 1e14, float(i % 5)], "", "", "") for i in range(15)]
    found = whitening.whiten(spark.createDataFrame(huge, ROWS)).collect()  # the second component is lost in rounding
    assert len(found) == 15 and all(r["deviation"] is None for r in found if r["vec_id"] % 3 != 1)
    assert {r["deviation"] is None for r in found if r["vec_id"] % 3 == 1} == {False}


# -- eigenvalues -------------------------------------------------------------


def symmetric(values, seed=0):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    matrix = turn * np.array(values) @ turn.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize("seed", range(5))
def test_inertia(seed):
    values = np.random.default_rng(seed).normal(size=30)
    for shift in (-1.0, 0.0, 0.3, 5.0):
        assert whitening.count_above(symmetric(values, seed), shift) == (values > shift).sum()


def test_inertia_needs_pivots_of_two_rows():
    assert whitening.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.count_above(np.zeros((3, 3)), 0.0) == 0


SPECTRA = [
    list(range(1, 65)), [1e8, 1e4, 1.0, 1e-2, 1e-3, 1e-4], [5.0] * 20, [9.0, 4.0, 4.0, 4.0, 4.0, 4.0, 4.0, 1.0, 0.0], [3.0], [2.0, 1.0],
    [1.0 + 1e-7 * i for i in range(40)], [100.0] + [1.0 + 1e-3 * i for i in range(127)],
]


@pytest.mark.parametrize("values", SPECTRA)
def test_largest_components(values):
    matrix = symmetric(values)
    found, vectors = whitening.largest(matrix, 4)
    want = np.linalg.eigvalsh(matrix)[::-1][:4]
    assert len(found) == min(4, len(values))
    assert np.allclose(found, want, rtol=0, atol=1e-13 * want[0])
    assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-12 * want[0]
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)


def test_an_interval_without_its_eigenvalues_is_an_error():
    with pytest.raises(ArithmeticError):
        whitening.in_interval(symmetric([1.0, 2.0, 3.0]), 1.5, 2.5, 2)
