"""Linear fits and components from one scan: means and covariances of all pairs of columns.

The table is read once, whatever the number of penalties; what reaches the driver is one row
a column. All that follows is algebra on a matrix as large as the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from threading import Lock

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F


def covariances(df: DataFrame, columns: Sequence[str] | str, label: str | None = None) -> DataFrame:
    """Row ``i`` has the count ``n``, the ``mean`` of column i and ``with``: its population
    covariances with all columns. ``columns`` are names or one vector column; ``label``,
    if given, is the last column. Rows with a NULL in any of them are left out.

    A row is spread over its columns and combined on the map side, so tasks send one row
    a column. Sums are centred as they go: large means cost no digits.
    """
    values = vector_to_array(columns) if isinstance(columns, str) else F.array(
        *[F.col(c).cast("double") for c in columns])
    if label is not None:
        values = F.concat(values, F.array(F.col(label).cast("double")))
    rows = df.select(values.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    size = len(columns) if not isinstance(columns, str) else _width(df, columns)
    size += label is not None
    return rows.select("v", F.posexplode("v").alias("i", "x")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"),
        F.array(*[F.covar_pop("x", F.element_at("v", j + 1)) for j in range(size)]).alias("with"))


def _width(df: DataFrame, vector: str) -> int:
    first = df.where(F.col(vector).isNotNull()).select(vector).first()
    return len(first[0]) if first else 0


@dataclass(frozen=True)
class Moments:
    """``n`` rows, their ``means`` and their population ``covariance``."""

    n: int
    means: np.ndarray
    covariance: np.ndarray


def moments(df: DataFrame, columns: Sequence[str] | str, label: str | None = None) -> Moments:
    """``covariances`` as a matrix. A table without complete rows raises ValueError."""
    rows = covariances(df, columns, label).orderBy("i").collect()
    if not rows:
        raise ValueError("no row has a value in every column")
    return Moments(rows[0]["n"], np.array([r["mean"] for r in rows]), np.array([r["with"] for r in rows], float))


# -- linear fits: the label is the last column -------------------------------------------------


def least_squares(m: Moments) -> np.ndarray:
    """The shortest weights of least squared error. Columns are scaled first, so one of small
    numbers is no linear combination of others by rounding; a constant one weighs nothing."""
    return _solved(m, 0.0)


def ridge(m: Moments, alpha: float) -> np.ndarray:
    """Weights that minimise ``|y - Xw|^2 + alpha |w|^2``; the intercept is not penalised."""
    return _solved(m, alpha)


def _solved(m: Moments, alpha: float) -> np.ndarray:
    gram, target = m.covariance[:-1, :-1], m.covariance[:-1, -1]
    if alpha > 0:
        return np.linalg.solve(gram + alpha / m.n * np.eye(len(target)), target)
    scale = np.sqrt(np.diag(gram))
    scale = np.where(scale > 0, scale, 1.0)
    return np.linalg.lstsq(gram / np.outer(scale, scale), target / scale, rcond=1e-12)[0] / scale


def lasso(m: Moments, alpha: float, rounds: int = 100_000, tolerance: float = 1e-12) -> np.ndarray:
    """Weights that minimise ``|y - Xw|^2 / 2n + alpha |w|_1``, by coordinate descent on the
    covariances. It ends when a round changes no weighted column's deviation by more than
    ``tolerance`` of the label's; without that after ``rounds`` it raises RuntimeError."""
    gram, target = m.covariance[:-1, :-1], m.covariance[:-1, -1]
    spread = np.sqrt(np.diag(gram))
    enough = tolerance * np.sqrt(m.covariance[-1, -1])
    weights = np.zeros(len(target))
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(spread > 0):
            pull = target[j] - gram[j] @ weights + gram[j, j] * weights[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / gram[j, j]
            moved = max(moved, abs(new - weights[j]) * spread[j])
            weights[j] = new
        if moved <= enough:
            return weights
    raise RuntimeError(f"the weights still moved after {rounds} rounds")


class SharedMoments:
    """The moments of ``train``, read once by all fits that share this object. A fit on another
    table reads that one."""

    def __init__(self, train: DataFrame, features: str, label: str):
        self.train, self.features, self.label = train, features, label
        self._found: Moments | None = None
        self._lock = Lock()

    def of(self, df: DataFrame) -> Moments:
        if df is not self.train:
            return moments(df, self.features, self.label)
        with self._lock:  # fits that run at the same time wait for the one scan
            if self._found is None:
                self._found = moments(df, self.features, self.label)
        return self._found


@dataclass(frozen=True)
class LinearFit:
    """``kind`` is ``least_squares``, ``ridge`` or ``lasso``; ``alpha`` is its penalty."""

    shared: SharedMoments
    kind: str = "least_squares"
    alpha: float = 0.0

    def fit(self, df: DataFrame) -> LinearFitModel:
        m = self.shared.of(df)
        if self.kind == "least_squares":
            weights = least_squares(m)
        else:
            weights = {"ridge": ridge, "lasso": lasso}[self.kind](m, self.alpha)
        intercept = float(m.means[-1] - m.means[:-1] @ weights)
        return LinearFitModel(weights, intercept, self.shared.features)


@dataclass(frozen=True)
class LinearFitModel:
    """Weights and an intercept, which score rows by a plain expression. Has the few methods
    of Spark's own models that scoring uses."""

    coefficients: np.ndarray
    intercept: float
    features: str = "features"
    prediction: str = "prediction"

    def copy(self) -> LinearFitModel:
        return replace(self)

    def setFeaturesCol(self, name: str) -> LinearFitModel:
        return replace(self, features=name)

    def setPredictionCol(self, name: str) -> LinearFitModel:
        return replace(self, prediction=name)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("__slots", vector_to_array(self.features)).withColumn(
            self.prediction, weighted("__slots", self.coefficients) + F.lit(self.intercept)).drop("__slots")


def weighted(array: str, weights: Sequence[float]) -> Column:
    """Sum of an array column's slots times ``weights``; slots of weight zero are not read."""
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        if w:
            total = total + F.element_at(array, i + 1) * F.lit(float(w))
    return total


# -- principal components ------------------------------------------------------------------------


@dataclass(frozen=True)
class Components:
    """Directions (one a row) of the standardised columns, and the shares they explain."""

    means: np.ndarray
    deviations: np.ndarray
    directions: np.ndarray
    shares: np.ndarray


def components(m: Moments, count: int) -> Components:
    """The ``count`` first principal components of the columns, each centred and divided by its
    sample deviation. Signs are fixed: a direction's largest part (the first of equal ones, up
    to rounding) is positive. A constant column takes no part."""
    if m.n < 2:
        raise ValueError("components need two rows")
    deviations = np.sqrt(np.diag(m.covariance) * m.n / (m.n - 1))
    scale = np.where(deviations > 0, deviations, np.inf)
    correlation = m.covariance * m.n / (m.n - 1) / np.outer(scale, scale)
    values, vectors = np.linalg.eigh(correlation)
    directions = vectors.T[::-1][:count]
    at = (np.abs(directions) >= np.abs(directions).max(axis=1, keepdims=True) - 1e-9).argmax(axis=1)
    directions = directions * np.sign(directions[np.arange(len(directions)), at])[:, None]
    return Components(m.means, scale, directions, values[::-1][:count] / max(values.sum(), 1e-300))


def scores(df: DataFrame, columns: Sequence[str], parts: Components, prefix: str = "PC") -> DataFrame:
    """``df`` with a column for each component, as plain expressions; NULL if a column is."""
    out = {}
    for k, direction in enumerate(parts.directions):
        total = F.lit(0.0)
        for c, w, mean, deviation in zip(columns, direction, parts.means, parts.deviations):
            total = total + (F.col(c).cast("double") - F.lit(float(mean))) * F.lit(float(w / deviation))
        out[f"{prefix}{k + 1}"] = total
    return df.withColumns(out)
