import hashlib
import math

import numpy as np
import pytest

from shopstream.llm import gnat

ROWS = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, code STRING, of STRING"


def plain(rows, parts, entries, rounds):
    """Every part against every entry, in Python's whole numbers."""
    whole = [(i, v[2], [math.floor(256 * c) for c in v[1]]) for i, v in enumerate(rows)
             if v[1] is not None and all(c is not None and math.isfinite(c) for c in v[1])]
    out = {}
    for size in {len(x) for _, _, x in whole}:
        same = [(i, x) for i, _, x in whole if len(x) == size]
        if size == 0 or size % parts:
            out |= {i: (None, None, None) for i, _ in same}
            continue
        width = size // parts
        cut = {i: [x[p * width:(p + 1) * width] for p in range(parts)] for i, x in same}
        first = sorted(same, key=lambda r: (rows[r[0]][0] is None, rows[r[0]][0] or 0, r[1]))[:entries]
        books = [[cut[i][p] for i, _ in first] for p in range(parts)]

        def nearest(book, xs):
            return min((sum((a - b) ** 2 for a, b in zip(e, xs)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            for p, book in enumerate(books):
                held = {}
                for i, _ in same:
                    held.setdefault(nearest(book, cut[i][p])[1], []).append(cut[i][p])
                books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else e for k, e in enumerate(book)]
        sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for i, _ in same:
            found = [nearest(books[p], cut[i][p]) for p in range(parts)]
            out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), sha)
    total = {}
    for i, label, _ in whole:
        if out[i][1] is not None:
            total[label] = total.get(label, 0) + out[i][1]
    return sorted(str((rows[i][0], out[i][0], out[i][1], total.get(label), out[i][2])) for i, label, _ in whole)


def rough_vectors():
    pick = np.random.default_rng(8)
    rows = [(i, np.round(pick.normal(size=8), 1).tolist(), None if i % 4 == 0 else i % 3, "", "") for i in range(120)]
    rows += [(200 + i, rows[5][1], 1, "", "") for i in range(50)]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None, 1, "", ""), (301, [0.0] * 8, 1, "", ""), (302, [nan] * 8, 1, "", ""), (303, [inf] + [0.0] * 7, 1, "", "")]
    rows += [(304, [None] + [1.0] * 7, 1, "", ""), (305, [], 9, "", ""), (306, [1.0, 2.0], 1, "", ""), (307, [1.0, 2.0, 3.0, 4.0], 8, "", "")]
    return rows + [(None, rows[3][1], 1, "", ""), (7, rows[7][1], 1, "", ""), (7, rows[8][1], 1, "", "")]


@pytest.mark.parametrize("entries", [1, 5, 64])
def test_codes_equal_brute_force(spark, entries):
    rows = rough_vectors()
    found = gnat.compress(spark.createDataFrame(rows, ROWS).repartition(4), parts=4, entries=entries)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(str(tuple(r)) for r in found.collect()) == plain(rows, 4, entries, 2)


def test_huge_components(spark):
    rows = [(i, [1e13 * (i % 7), 1e6 * i, -1.0, float(i)], i % 2, "", "") for i in range(30)]
    found = sorted(str(tuple(r)) for r in gnat.compress(spark.createDataFrame(rows, ROWS), parts=2, entries=30, rounds=1).collect())
    assert found == plain(rows, 2, 30, 1)
    far = [(0, [0.0], 1, "", ""), (1, [1e300], 1, "", "")]
    found = gnat.compress(spark.createDataFrame(far, ROWS), parts=1, entries=1, rounds=0).orderBy("vec_id").collect()
    assert [(r["error"], r["label_error"]) for r in found] == [(0, 0), (None, 0)]


def test_empty_table_and_too_many_entries(spark):
    table = spark.createDataFrame([], ROWS)
    assert gnat.compress(table).count() == 0
    with pytest.raises(ValueError):
        gnat.compress(table, entries=257)


@pytest.mark.parametrize("degree,leaf", [(2, 1), (8, 8), (3, 2)])
def test_tree_equals_full_search(degree, leaf):
    pick = np.random.default_rng(degree)
    points = pick.integers(-40, 40, size=(200, 3))
    points[50:80] = points[:30]  # ties go to the earlier entry
    rows = np.concatenate([pick.integers(-60, 60, size=(3000, 3)), points])
    best, squared = gnat.Gnat(points, degree=degree, leaf=leaf).nearest(rows)
    far = gnat.squares(rows, points)
    assert (best == far.argmin(1)).all() and (squared == far.min(1)).all()


def test_tree_passes_over_children(monkeypatch):
    seen = []
    real = gnat.squares
    monkeypatch.setattr(gnat, "squares", lambda rows, points: seen.append(len(rows) * len(points)) or real(rows, points))
    pick = np.random.default_rng(1)
    tree = gnat.Gnat(pick.integers(0, 1000, size=(256, 2)))
    rows = pick.integers(0, 1000, size=(1000, 2))
    seen.clear()
    tree.nearest(rows)
    assert sum(seen) < 0.4 * len(rows) * 256
