"""A quality classifier: regularised quadratic discriminant analysis over document statistics.

Every text is reduced to a dozen transformed statistics, in one pass and in
Arrow batches. Class means and covariances come from sums that Spark combines
over all labelled rows, so the driver sees a few hundred numbers whatever the
size of the corpus. Each covariance is shrunk towards the pooled one and towards
its diagonal; its Cholesky factor is inverted once and travels with the model.
The score is the logistic function of the log-density difference of the two
classes, from Mahalanobis distances through those factors.
"""

from __future__ import annotations

import operator
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm.common import staged

FEATURES = (
    "words", "word_length", "upper", "symbol", "stop", "exclaim", "digit", "distinct", "repeat", "top_word",
    "line_repeat", "line_words",
)
FLOOR = 0.002
TO_POOLED = 0.5
TO_DIAGONAL = 0.1
RIDGE = 1e-3
THRESHOLD = 0.7

OTHER, LOWER, UPPER, DIGIT, SPACE, STOP, EXCLAIM = range(7)
PLANE = 0x10000


# -- statistics --------------------------------------------------------------


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """What kind of character each code point of the basic plane is; all others count as ``OTHER``."""
    kinds = np.zeros(PLANE, dtype=np.uint8)
    for code in range(PLANE - 1):
        c = chr(code)
        if c.isalpha():
            kinds[code] = UPPER if c.isupper() else LOWER
        elif c.isdigit():
            kinds[code] = DIGIT
        elif c.isspace():
            kinds[code] = SPACE
        elif c in ".,;:'\"-()":
            kinds[code] = STOP
        elif c in "!?":
            kinds[code] = EXCLAIM
    return kinds


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text, in the order of ``FEATURES``; defined for empty texts too."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(_kinds()[np.minimum(codes, PLANE - 1)], minlength=7)
    words = text.split()
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    chars, n = max(1, len(codes)), max(1, len(words))
    letters = max(1, int(kinds[LOWER] + kinds[UPPER]))
    shares = (
        kinds[UPPER] / letters, kinds[OTHER] / chars, kinds[STOP] / chars, kinds[EXCLAIM] / chars, kinds[DIGIT] / chars,
    )
    repeats = sum(map(operator.eq, words, words[1:])) / n
    line_repeats = 1 - len(set(lines)) / max(1, len(lines))
    raised = [*shares, repeats, max(counts.values(), default=0) / n, line_repeats]
    upper, symbol, stop, exclaim, digit, repeat, top, line_repeat = np.log(np.array(raised) + FLOOR).tolist()
    distinct = float(np.log(max(1, len(counts)) / n) / np.log(n + 2))
    return [
        float(np.log1p(len(words))), float(np.log1p((chars - kinds[SPACE]) / n)), upper, symbol, stop, exclaim, digit,
        distinct, repeat, top, line_repeat, float(np.log1p(len(words) / max(1, len(lines)))),
    ]


def statistics_of(text: Column) -> Column:
    """:func:`statistics` of a column; a null text counts as empty."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t.as_py() or "") for t in texts], pa.list_(pa.float64()))

    return measure(text)


# -- model -------------------------------------------------------------------


class Model(NamedTuple):
    """Per class (0, 1): log prior, mean, inverse Cholesky factor and log determinant; or one score for all."""

    priors: tuple[float, ...] = ()
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    log_dets: tuple[float, ...] = ()
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """How likely label 1 is, from 0 to 1, for each row of statistics."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [
            prior - 0.5 * (((x - mean) @ factor.T) ** 2).sum(1) - 0.5 * log_det
            for prior, mean, factor, log_det in zip(self.priors, self.means, self.factors, self.log_dets)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def model_of(
    moments: dict[int, tuple[int, np.ndarray, np.ndarray]],
    to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL, ridge: float = RIDGE,
) -> Model:
    """The model from each class's count, sums and sums of products.

    Where a class has no rows, nothing can be told apart: all score the share
    of label 1, or 1 without any labels.
    """
    if len(moments) < 2:
        return Model(constant=float(next(iter(moments), 1)))
    total = sum(n for n, _, _ in moments.values())
    means = {k: s / n for k, (n, s, _) in moments.items()}
    covariances = {k: p / n - np.outer(means[k], means[k]) for k, (n, _, p) in moments.items()}
    pooled = sum(n * covariances[k] for k, (n, _, _) in moments.items()) / total
    priors, factors, log_dets = [], [], []
    for k in (0, 1):
        mixed = (1 - to_pooled) * covariances[k] + to_pooled * pooled
        mixed = (1 - to_diagonal) * mixed + to_diagonal * np.diag(np.diag(mixed)) + ridge * np.eye(len(mixed))
        lower = np.linalg.cholesky(mixed)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * float(np.log(np.diag(lower)).sum()))
        priors.append(float(np.log(moments[k][0] / total)))
    return Model(tuple(priors), (means[0], means[1]), tuple(factors), tuple(log_dets))


def fit(rows: DataFrame, features: str = "features", label: str = "quality") -> Model:
    """A model from all rows whose label is 0 or 1."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = [F.col(features)[i] for i in range(d)]
    sums = (
        rows.where(F.col(label).isin(0, 1))
        .groupBy(F.col(label).cast("int").alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v) for v in x]).alias("sums"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("products"),
        )
        .collect()  # one row a class
    )
    moments = {}
    for row in sums:
        products = np.zeros((d, d))
        for (i, j), value in zip(pairs, row["products"]):
            products[i, j] = products[j, i] = value
        moments[row["label"]] = (row["n"], np.array(row["sums"]), products)
    return model_of(moments)


def score_of(features: Column, model: Model) -> Column:
    @F.arrow_udf(T.DoubleType())
    def score(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        return pa.array(model.scores(x), pa.float64())

    return score(features)


def is_held_out(doc_id: Column) -> Column:
    """Rows never learned from; a null id counts as not held out (and can hold no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_labels(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", features: str = "features") -> Model:
    """A model from the labelled rows that are not held out. A document with several labels counts once for each."""
    known = labels.select(F.col(id_col).alias("_label_id"), F.col("quality").alias("_quality"))
    known = known.where(F.col("_quality").isin(0, 1) & ~is_held_out(F.col("_label_id")))
    rows = measured.select(F.col(id_col).alias("_id"), F.col(features).alias("_features"))
    return fit(rows.join(known, F.col("_id") == F.col("_label_id")), "_features", "_quality")


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """``(<id_col>, held_out, score, predicted)`` for every row of ``docs``, learned from ``labels``.

    Texts are measured once, into a narrow table. Null and empty texts have
    statistics and a score like any other. ``predicted`` is 1 from ``threshold`` up.
    """
    measured = staged(docs.select(F.col(id_col).alias("_id"), statistics_of(F.col(text_col)).alias("_features")))
    model = fit_on_labels(measured.withColumnRenamed("_id", id_col), labels, id_col, "_features")
    score = score_of(F.col("_features"), model)
    scored = measured.select(F.col("_id").alias(id_col), is_held_out(F.col("_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns.

    Texts are measured twice, for the model and for the scores, so that none has
    to be shuffled.
    """
    measured = docs.select(F.col(id_col), statistics_of(F.col(text_col)).alias("_features"))
    model = fit_on_labels(measured, labels, id_col, "_features")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), statistics_of(F.col(text_col)).alias("features"))
    return rows.where(score_of(F.col("features"), model) >= threshold).select("doc.*")
