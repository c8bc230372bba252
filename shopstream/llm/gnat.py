"""Codes for vectors: each part of a vector becomes the number of its codebook's nearest entry, found in a GNAT.

A geometric near-neighbour access tree takes some entries of a codebook as split
points and gives every other entry to the nearest of them. Each split point keeps
the least and the largest distance from itself to the entries of each child. A
part that is d away from a split point and r from the nearest entry so far has
nothing to look for in a child whose distances from that point lie outside
[d - r, d + r]; only a strictly outer range is passed over, with bounds rounded
to the safe side, so ties survive. Distances that decide are whole numbers.

Vectors are compared in batches: a batch goes down the tree together, and each
child sees only the rows that it was not ruled out for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import staged
from shopstream.llm.whitening import LONG_MAX, is_finite, scaled, whole_rows

PARTS = 16
ENTRIES = 64
ROUNDS = 2
DEGREE = 8
LEAF = 8
SAFE = 1e-9


# -- tree --------------------------------------------------------------------


def squares(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of rows to points: longs where they fit, Python's numbers for objects."""
    off = rows[:, None, :] - points[None, :, :]
    return (off * off).sum(2)


def lengths(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


class Gnat:
    """A tree over ``points`` (whole numbers), of which ``entries`` are this node's; a leaf has no children."""

    def __init__(self, points: np.ndarray, entries: np.ndarray | None = None, degree: int = DEGREE, leaf: int = LEAF):
        self.points = points
        self.entries = np.arange(len(points)) if entries is None else entries
        self.children: list[Gnat] = []
        if len(self.entries) <= leaf:
            return
        self.splits = self._spread(degree)
        rest = np.setdiff1d(self.entries, self.splits)
        far = squares(points[rest], points[self.splits])
        nearest = far.argmin(1)
        far = lengths(far)
        groups = [np.flatnonzero(nearest == i) for i in range(len(self.splits))]
        groups = [g for g in groups if len(g)]
        self.children = [Gnat(points, rest[g], degree, leaf) for g in groups]
        self.low = np.array([far[g].min(0) for g in groups]) * (1 - SAFE)
        self.high = np.array([far[g].max(0) for g in groups]) * (1 + SAFE)

    def _spread(self, number: int) -> np.ndarray:
        """Entries far from one another: each next one is that farthest from those taken."""
        taken = [int(self.entries[0])]
        near = squares(self.points[self.entries], self.points[taken])[:, 0]
        while len(taken) < min(number, len(self.entries)):
            near[np.isin(self.entries, taken)] = -1
            taken.append(int(self.entries[near.argmax()]))
            near = np.minimum(near, squares(self.points[self.entries], self.points[taken[-1:]])[:, 0])
        return np.array(taken)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry, the first of several, and its squared distance."""
        best = np.zeros(len(rows), dtype=np.int64)
        squared = squares(rows, self.points[:1])[:, 0]
        self._look(rows, np.arange(len(rows)), best, squared)
        return best, squared

    def _take(self, rows: np.ndarray, which: np.ndarray, entries: np.ndarray, best: np.ndarray, squared: np.ndarray) -> np.ndarray:
        """Compares rows with entries; ``best`` and ``squared`` take what is nearer, or as near and earlier."""
        far = squares(rows[which], self.points[entries])
        least = far.min(1)
        first = np.where(far == least[:, None], entries, len(self.points)).min(1)
        new = (least < squared[which]) | ((least == squared[which]) & (first < best[which]))
        best[which[new]], squared[which[new]] = first[new], least[new]
        return far

    def _look(self, rows: np.ndarray, which: np.ndarray, best: np.ndarray, squared: np.ndarray) -> None:
        if not self.children:
            self._take(rows, which, self.entries, best, squared)
            return
        far = lengths(self._take(rows, which, self.splits, best, squared))
        for child, low, high in zip(self.children, self.low, self.high):
            radius = lengths(squared[which])[:, None] * (1 + SAFE)
            outside = (far * (1 - SAFE) - radius > high) | (far * (1 + SAFE) + radius < low)
            left = np.flatnonzero(~outside.any(1))
            if len(left):
                child._look(rows, which[left], best, squared)


# -- codebooks ---------------------------------------------------------------


class Codebooks:
    """``books[p]`` holds the entries of part p as rows."""

    def __init__(self, books: list[list[list[int]]]):
        self.books = books
        self.most = max((abs(x) for b in books for e in b for x in e), default=0)
        self.trees: dict[bool, list[Gnat]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"trees": {}}

    def _trees(self, wide: bool) -> list[Gnat]:
        if wide not in self.trees:
            self.trees[wide] = [Gnat(np.array(b, dtype=object if wide else np.int64)) for b in self.books]
        return self.trees[wide]

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes (row, part) and each row's summed squared distances, in Python's numbers where longs are too short."""
        most = max(self.most, int(rows.max(initial=0)), -int(rows.min(initial=0)))
        wide = rows.shape[1] * (2 * most) ** 2 >= 1 << 62
        rows = rows.astype(object) if wide else rows
        indexes, total, width = [], 0, rows.shape[1] // len(self.books)
        for part, tree in enumerate(self._trees(wide)):
            best, squared = tree.nearest(rows[:, part * width:(part + 1) * width])
            indexes.append(best)
            total = total + squared.astype(object) if wide else total + squared
        return np.array(indexes).T, total

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Each entry replaced by its parts' mean, rounded down; entries without parts stay."""
        out = [[list(e) for e in b] for b in self.books]
        for (part, entry), (count, totals) in sums.items():
            out[part][entry] = [t // count for t in totals]
        return Codebooks(out)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for e in b for x in e).encode()).hexdigest()


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors of the smallest ids; rows without an id come last, ties by the vector."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()  # ``entries`` rows
    width = len(first[0]["x"]) // parts
    return Codebooks([[list(r["x"][p * width:(p + 1) * width]) for r in first] for p in range(parts)])


def _next_codebooks(rows: DataFrame, books: Codebooks, size: int) -> Codebooks:
    """One round: sums and counts per entry, added up in each task first."""
    parts, width = len(books.books), size // len(books.books)
    entries = len(books.books[0])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=object)
        for batch in batches:
            whole = whole_rows(batch.column("x"), size)
            indexes, _ = books.encode(whole)
            held = whole.reshape(len(whole), parts, width)
            small = not len(whole) or (np.abs(held.astype(np.float64)).max() * len(whole) < 1 << 52)
            for part in range(parts):
                counts[part] += np.bincount(indexes[:, part], minlength=entries)
                for place in range(width):
                    if small:  # such sums are whole as doubles, too
                        sums[part, :, place] += np.bincount(
                            indexes[:, part], weights=held[:, part, place], minlength=entries,
                        ).astype(np.int64).astype(object)
                    else:
                        np.add.at(sums[part, :, place], indexes[:, part], held[:, part, place].astype(object))
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(counts[part, entry], pa.int64()),
            "totals": pa.array(sums[part, entry].tolist(), pa.list_(pa.decimal128(38, 0))),
        })

    found = rows.select("x").mapInArrow(gather, "part INT, entry INT, n BIGINT, totals ARRAY<DECIMAL(38,0)>")
    added = found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(width)],
    ).collect()  # a row for each entry at most
    return books.moved({(r["part"], r["entry"]): (r["n"], [int(r[f"t{i}"]) for i in range(width)]) for r in added})


# -- codes -------------------------------------------------------------------


def _coded(rows: DataFrame, books: Codebooks, size: int, id_type: str, label_type: str) -> DataFrame:
    digest = books.digest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            indexes, errors = books.encode(whole_rows(batch.column("x"), size))
            digits = indexes.astype(np.uint8).tobytes().hex()
            width = 2 * indexes.shape[1]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("label"), pa.array([digits[i:i + width] for i in range(0, len(digits), width)], pa.string()),
                pa.array([e if e <= LONG_MAX else None for e in errors.tolist()], pa.int64()),
                pa.array([digest] * len(batch), pa.string()),
            ], ["id", "label", "code", "error", "codebooks_sha256"])

    schema = f"id {id_type}, label {label_type}, code STRING, error BIGINT, codebooks_sha256 STRING"
    return rows.mapInArrow(encode, schema)


def compress(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = 256,
) -> DataFrame:
    """``(<id_col>, code, error, label_error, codebooks_sha256)``, one row per row whose vector is finite.

    Vectors that are null or have a null or non-finite component are left out.
    Vectors of each length have codebooks of their own; a length that cannot be
    cut into ``parts`` has no code, error nor codebooks. Ids may repeat or be null.
    ``label_error`` adds up the errors of equal labels, null labels together; it
    and an error are null where no long holds them, and null errors add nothing.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code's two digits tell at most 256 entries apart")
    id_type, label_type = (table.schema[c].dataType.simpleString() for c in (id_col, label_col))
    rows = staged(table.where(is_finite(F.col(vector_col))).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), scaled(F.col(vector_col), scale).alias("x"),
    ))
    whole = (F.size("x") > 0) & (F.size("x") % parts == 0)
    found = rows.where(~whole).select(
        "id", "label", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "bigint"), ("codebooks_sha256", "string"))],
    )
    for size in [r["size"] for r in rows.where(whole).select(F.size("x").alias("size")).distinct().orderBy("size").collect()]:
        same = rows.where(F.size("x") == size)
        books = first_codebooks(same, parts, entries)
        for _ in range(rounds):
            books = _next_codebooks(same, books, size)
        found = found.union(_coded(same, books, size, id_type, label_type))
    found = staged(found)
    return with_label_error(found).withColumnRenamed("id", id_col)


def with_label_error(found: DataFrame) -> DataFrame:
    """``found`` with the sum of ``error`` over equal labels, nulls together."""
    total: Column = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = staged(found.groupBy("label").agg(total.alias("total")))
    sums = sums.select(F.col("label").alias("of"), F.when(F.col("total") <= LONG_MAX, F.col("total").cast("bigint")).alias("label_error"))
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("id", "code", "error", "label_error", "codebooks_sha256")
