"""Whitening of embeddings by their largest components, found by contour integration (FEAST).

Spark gathers the moments: the distinct integer vectors, their sums, and the
products of the centred vectors, which tasks add up to one matrix each and a
two-level tree to one. The matrix has the square of a vector's length, whatever
the number of rows.

The components are those of an interval that holds the largest eigenvalues.
Inertia counts (Sylvester's law, on a factorisation with symmetric pivots) say
how many eigenvalues lie above a number, so bisection places the interval's lower
end. Solves with the matrix shifted to points of a circle around the interval,
added up as a quadrature, project a block of vectors onto its eigenvectors; a
Rayleigh-Ritz step takes the components out of the block. As many must come out
as the inertia counts say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import staged

COMPONENTS = 4
SCALE = 256
NODES = 8
SPARE = 4
ROUNDS = 60
BRANCHES = 64
SEED = 3
LONG_MAX = (1 << 63) - 1


# -- integer vectors ---------------------------------------------------------


def is_finite(vector: Column) -> Column:
    """Not null, with no null, infinite or undefined component."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Each component times ``scale``, rounded down, as a long; beyond a long's range, its end."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def whole_rows(column: pa.Array, size: int) -> np.ndarray:
    """Lists of one length as rows of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), size)


def exact(rows: np.ndarray, factor: int = 1, square: bool = False) -> np.ndarray:
    """``rows`` as they are if ``factor`` times a row's sum (of squares) fits in a long, else as Python's numbers."""
    most = max(int(rows.max(initial=0)), -int(rows.min(initial=0))) * factor
    return rows if rows.shape[1] * (most * most if square else most) < 1 << 62 else rows.astype(object)


# -- eigenvalues -------------------------------------------------------------


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: the positive pivots of the shifted matrix.

    Pivots are one or two rows, whichever is larger in proportion (Bunch and Parlett).
    """
    rest = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(rest):
        size = np.abs(rest)
        diagonal = size.diagonal()
        one = int(diagonal.argmax())
        a, b = divmod(int(np.argmax(np.triu(size, 1))), len(rest)) if len(rest) > 1 else (0, 0)
        if size[a, b] == 0 and diagonal[one] == 0:
            break
        if a == b or diagonal[one] >= (1 + 17 ** 0.5) / 8 * size[a, b]:
            pivot = [one]
            above += bool(rest[one, one] > 0)
        else:
            pivot = [a, b]
            block = rest[np.ix_(pivot, pivot)]
            below_zero = block[0, 0] * block[1, 1] < block[0, 1] * block[1, 0]
            above += 1 if below_zero else 2 * bool(block[0, 0] > 0)
        others = np.delete(np.arange(len(rest)), pivot)
        side = rest[np.ix_(others, pivot)]
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(rest[np.ix_(pivot, pivot)], side.T)
        rest = (rest + rest.T) / 2
    return above


def filtered(matrix: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """``block`` projected onto the eigenvectors of the interval, by Gauss-Legendre nodes on the upper half circle."""
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for at, weight in zip(*np.polynomial.legendre.leggauss(nodes)):
        turn = np.exp(1j * np.pi / 2 * (1 - at))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, block.astype(complex))
        out += weight / 2 * (radius * turn * solved).real
    return out


def in_interval(matrix: np.ndarray, low: float, high: float, count: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, falling, and their unit eigenvectors as columns."""
    norm = np.abs(matrix).sum(1).max()
    size = min(len(matrix), 2 * count + SPARE)
    block = np.random.default_rng(SEED).standard_normal((len(matrix), size))
    best, last = None, np.inf
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(filtered(matrix, block, low, high, nodes))
        values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turns
        inside = np.flatnonzero((values > low) & (values <= high))[::-1]
        if len(inside) == count:
            vectors = block[:, inside]
            off = np.abs(matrix @ vectors - vectors * values[inside]).max()
            if off >= last and off <= 1e-12 * norm:
                return best
            if off < last:
                best, last = (values[inside], vectors), off
        elif size < len(matrix):  # the block was too narrow, or still mixes what is inside with what is not
            size = min(len(matrix), size + SPARE)
            more = np.random.default_rng([SEED, size]).standard_normal((len(matrix), size - block.shape[1]))
            block = np.hstack([block, more])
    if best is None or last > 1e-9 * norm:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, but they were not found")
    return best


def largest(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest eigenvalues above zero, as far as rounding tells, and their unit eigenvectors as columns.

    An eigenvector's largest entry is positive.
    """
    norm = np.abs(matrix).sum(1).max(initial=0)
    if norm == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    matrix = matrix / norm
    low, high = len(matrix) * np.finfo(float).eps, 1.0 + 1e-6
    count = count_above(matrix, low)
    wanted, top = min(wanted, count), high
    for _ in range(ROUNDS):
        if count <= wanted + SPARE:
            break
        middle = (low + top) / 2
        found = count_above(matrix, middle)
        low, count, top = (middle, found, top) if found >= wanted else (low, count, middle)
    if not wanted:
        return np.zeros(0), np.zeros((len(matrix), 0))
    values, vectors = in_interval(matrix, low, high, count)
    vectors = vectors[:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    return values[:wanted] * norm, vectors * signs


# -- moments -----------------------------------------------------------------


@dataclass(frozen=True)
class Moments:
    """Of the distinct vectors of one length: their number and the exact sum of each component."""

    size: int
    n: int
    sums: list[int]

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """``n`` times the rows less the sums, exactly."""
        sums = np.array(self.sums, dtype=object)
        most = max([abs(s) for s in self.sums], default=0)
        rows = exact(rows, self.n)
        return self.n * rows - (sums.astype(np.int64) if rows.dtype != object and most < 1 << 62 else sums)

    def away(self, rows: np.ndarray) -> np.ndarray:
        """The rows less the mean."""
        return self.centred(rows).astype(np.float64) / self.n


@dataclass(frozen=True)
class Whitening:
    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def of(self, rows: np.ndarray) -> np.ndarray:
        return self.moments.away(rows) @ self.vectors / np.sqrt(self.values)


def _moments(fit: DataFrame, size: int) -> Moments:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(size, dtype=object)
        for batch in batches:
            rows = whole_rows(batch.column("x"), size)
            count, total = count + len(rows), total + (exact(rows.T).sum(1).astype(object) if len(rows) else 0)
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(range(-1, size), pa.int32()), "total": pa.array([count, *total.tolist()], pa.decimal128(38, 0)),
        })

    parts = fit.mapInArrow(add, "place INT, total DECIMAL(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    found = [int(r["total"]) for r in parts.orderBy("place").collect()]  # one number for each component
    return Moments(size, found[0], found[1:])


def _products(fit: DataFrame, width: int, rows_of: object) -> np.ndarray:
    """The sum of each task's ``rows_of(batch).T @ rows_of(batch)``, by a tree of two levels."""
    shape = (width, width)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            rows = rows_of(batch)
            total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.zeros(shape)
        for part in table["total"]:
            total += np.frombuffer(part.as_py()).reshape(shape)
        return pa.table({"part": pa.array([table["part"][0].as_py() % BRANCHES], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

    parts = fit.mapInArrow(gather, "total BINARY").withColumn("part", F.spark_partition_id())
    branches = parts.groupBy(F.col("part") % BRANCHES).applyInArrow(add, "part INT, total BINARY")
    return np.frombuffer(branches.groupBy().applyInArrow(add, "part INT, total BINARY").first()["total"]).reshape(shape)


def fit_whitening(fit: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the vectors ``x``, longs of length ``size``, each of which is there once."""
    moments = _moments(fit, size)

    def away(batch: pa.RecordBatch) -> np.ndarray:
        return moments.away(whole_rows(batch.column("x"), size))

    covariance = _products(fit, size, away) / moments.n
    values, vectors = largest(covariance, components)
    return Whitening(moments, values, vectors, float(np.trace(covariance)))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry, by its absolute value, of the whitened vectors' covariance less the identity.

    Whitened vectors have the mean zero, as the vectors they come from are less their own.
    """
    def whitened(batch: pa.RecordBatch) -> np.ndarray:
        return model.of(whole_rows(batch.column("x"), model.moments.size))

    width = len(model.values)
    return float(np.abs(_products(fit, width, whitened) / model.moments.n - np.eye(width)).max(initial=0))


def _whitened_rows(rows: DataFrame, model: Whitening, error: float, id_type: str) -> DataFrame:
    size, n, width = model.moments.size, model.moments.n, len(model.values)
    explained = model.values / model.trace if width else model.values

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = whole_rows(batch.column("x"), size)
            off = exact(model.moments.centred(whole), square=True)
            deviation = [int(d) if d <= LONG_MAX else None for d in (off * off).sum(1).tolist()]
            count = len(whole)
            again = pa.array(np.repeat(np.arange(count), width))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(again), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                pa.array(np.full(count * width, n)), pa.array(deviation, pa.int64()).take(again),
                pa.array(model.of(whole).reshape(-1)), pa.array(np.tile(explained, count)), pa.array(np.full(count * width, error)),
            ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = f"id {id_type}, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
    return rows.mapInArrow(rows_of, schema)


def whiten(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """``(<id_col>, component, n, deviation, whitened, explained, identity_error)`` for each row and component.

    Rows whose vector is null or has a null or non-finite component give no rows;
    ids may repeat or be null. The model is fitted on the distinct integer vectors
    (:func:`scaled`), on those of each length apart. Components without variance
    give no rows, nor does a length with one distinct vector alone. A deviation
    that no long holds is null.
    """
    kept = table.where(is_finite(F.col(vector_col))).select(F.col(id_col).alias("id"), scaled(F.col(vector_col), scale).alias("x"))
    id_type = table.schema[id_col].dataType.simpleString()
    fit = staged(kept.select("x").where(F.size("x") > 0).distinct())
    sizes = [r["size"] for r in fit.select(F.size("x").alias("size")).distinct().orderBy("size").collect()]
    found = None
    for size in sizes:
        same = fit.where(F.size("x") == size)
        model = fit_whitening(same, size, components)
        rows = _whitened_rows(kept.where(F.size("x") == size), model, identity_error(same, model), id_type)
        found = rows if found is None else found.union(rows)
    if found is None:
        found = _whitened_rows(kept.where("false"), Whitening(Moments(0, 0, []), np.zeros(0), np.zeros((0, 0)), 0.0), 0.0, id_type)
    return found.withColumnRenamed("id", id_col)
