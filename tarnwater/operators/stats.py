"""Tests, covariance, Gram matrices and objectives: one aggregate each, never more than a d x d result."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def t_test(df: DataFrame, sample: str, value: str, first, second) -> DataFrame:
    """Two-sample t statistic with equal variances and its degrees of freedom."""
    side = lambda label: F.when(F.col(sample) == label, F.col(value).cast("double"))
    a, b = side(first), side(second)
    parts = df.agg(
        F.count(a).alias("n1"), F.avg(a).alias("m1"), F.var_samp(a).alias("v1"),
        F.count(b).alias("n2"), F.avg(b).alias("m2"), F.var_samp(b).alias("v2"),
    )
    freedom = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / freedom
    t = (F.col("m1") - F.col("m2")) / F.sqrt(pooled * (1.0 / F.col("n1") + 1.0 / F.col("n2")))
    return parts.select(t.alias("t"), freedom.alias("df"))


def student_p_value(t: float, freedom: int, steps: int = 20_000) -> float:
    """Two-sided p-value: Simpson integration of the Student density after the substitution x = sqrt(df) tan(u)."""
    limit = math.atan(abs(t) / math.sqrt(freedom))
    u = np.linspace(0.0, limit, steps + 1)
    density = np.cos(u) ** (freedom - 1)
    weights = np.ones(steps + 1)
    weights[1:-1:2], weights[2:-1:2] = 4.0, 2.0
    area = float((weights * density).sum()) * (limit / steps) / 3.0
    scale = math.exp(math.lgamma((freedom + 1) / 2) - math.lgamma(freedom / 2)) / math.sqrt(math.pi)
    return max(0.0, 1.0 - 2.0 * scale * area)


def p_value(t: Column, freedom: Column, steps: int = 2000) -> Column:
    """Two-sided p-value of a Student t, as a column: the share of the density's integral beyond |t|, by Simpson's rule after the substitution
    x = sqrt(df) tan(u). Both integrals use a fixed number of steps within 40 standard deviations, so no gamma function is needed."""
    width = 40 / F.sqrt(freedom)
    whole = F.least(F.lit(math.pi / 2), width)
    inner = F.least(F.atan(F.abs(t) / F.sqrt(freedom)), whole)

    def area(limit: Column) -> Column:
        weight = lambda i: F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        total = F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), lambda s, i: s + weight(i) * F.pow(F.cos(limit * i / steps), freedom - 1))
        return limit * total / (3 * steps)

    return F.greatest(1 - area(inner) / area(whole), F.lit(0.0))


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of every column pair as rows (i, j, covariance); the symmetric half is computed once."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.covar_samp(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(x).alias("i"), F.lit(y).alias("j"), F.col(f"`{a}|{b}`").alias("covariance"))
        for a, b in pairs
        for x, y in ([(a, b)] if a == b else [(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


def _product_sums(df: DataFrame, left: Sequence[Column], right: Sequence[Column]) -> list[list[float]]:
    sums = [F.sum(a * b).alias(f"{i}_{j}") for i, a in enumerate(left) for j, b in enumerate(right)]
    row = df.agg(*sums).first()
    return [[float(row[f"{i}_{j}"] or 0.0) for j in range(len(right))] for i in range(len(left))]


def gram_matrix(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """X'X, and X'y in rows with j = 'y', as (i, j, value)."""
    names = [*features, *([label] if label else [])]
    pairs = [(a, b) for a in features for b in names]
    row = df.agg(*[F.sum(F.col(a).cast("double") * F.col(b)).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(a).alias("i"), F.lit("y" if b == label else b).alias("j"), F.col(f"`{a}|{b}`").alias("value"))
        for a, b in pairs
    ]
    return row.select(F.inline(F.array(*cells)))


def covariance_eigenvalues(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Eigenvalues of the covariance matrix, largest first. Only the d x d matrix reaches the driver."""
    row = df.agg(*[F.covar_samp(a, b).alias(f"{i}_{j}") for i, a in enumerate(columns) for j, b in enumerate(columns)]).first()
    d = len(columns)
    matrix = np.array([[row[f"{i}_{j}"] for j in range(d)] for i in range(d)], dtype=float)
    return np.linalg.eigvalsh(matrix)[::-1]


def explained_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Eigenvalue, share of the total variance and cumulative share per component (1-based)."""
    values = covariance_eigenvalues(df, columns)
    shares = values / values.sum()
    rows = [(i + 1, float(v), float(s), float(c)) for i, (v, s, c) in enumerate(zip(values, shares, shares.cumsum()))]
    return df.sparkSession.createDataFrame(rows, "component int, eigenvalue double, share double, cumulative double")


def singular_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Singular values of the data matrix, from its Gram matrix; largest first."""
    names = [F.col(c).cast("double") for c in columns]
    gram = np.array(_product_sums(df, names, names))
    values = np.sqrt(np.clip(np.linalg.eigvalsh(gram)[::-1], 0.0, None))
    rows = [(i + 1, float(v)) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "component int, singular_value double")


@dataclass(frozen=True)
class Factors:
    """A thin singular value decomposition: singular values, largest first, and one right vector per value over the columns."""

    columns: tuple[str, ...]
    values: tuple[float, ...]
    right: tuple[tuple[float, ...], ...]

    def left(self, df: DataFrame, prefix: str = "u") -> DataFrame:
        """``df`` with one column per value, ``u1``, ``u2``, ...: the rows of U = X V / s, computed where the rows are. NULL for a value that is zero."""
        limit = max(self.values, default=0.0) * 1e-12
        parts = [linear_prediction(self.columns, [v / s for v in vector]) if s > limit else F.lit(None).cast("double") for s, vector in zip(self.values, self.right, strict=True)]
        return df.withColumns({f"{prefix}{i + 1}": part for i, part in enumerate(parts)})

    def right_table(self, df: DataFrame) -> DataFrame:
        """(component, singular_value, column_name, value)."""
        rows = [(i + 1, s, c, x) for i, (s, vector) in enumerate(zip(self.values, self.right, strict=True)) for c, x in zip(self.columns, vector, strict=True)]
        return df.sparkSession.createDataFrame(rows, "component int, singular_value double, column_name string, value double")


def singular_vectors(df: DataFrame, columns: Sequence[str]) -> Factors:
    """Thin factorisation X = U S V' of tall data: one aggregate for the d x d Gram matrix, whose eigenvectors are V; U stays distributed.
    The largest component of a right vector (the first of equal ones) is positive, which fixes the signs of both sides."""
    names = [F.col(c).cast("double") for c in columns]
    values, vectors = np.linalg.eigh(np.array(_product_sums(df, names, names)))
    order = np.argsort(-values, kind="stable")
    right = []
    for i in order:
        vector = vectors[:, i]
        size = np.abs(vector)
        right.append(tuple(map(float, vector * np.sign(vector[int(np.flatnonzero(size >= size.max() * (1 - 1e-9))[0])]))))
    return Factors(tuple(columns), tuple(float(math.sqrt(max(values[i], 0.0))) for i in order), tuple(right))


def linear_prediction(features: Sequence[str], weights: Sequence[float], intercept: float = 0.0) -> Column:
    """Xw + intercept for one row."""
    terms = [F.col(c) * F.lit(float(w)) for c, w in zip(features, weights, strict=True)]
    return reduce(lambda a, b: a + b, terms) + F.lit(float(intercept))


def squared_error(df: DataFrame, features: Sequence[str], label: str, weights: Sequence[float]) -> DataFrame:
    """Sum of squared errors of fixed weights."""
    error = F.col(label) - linear_prediction(features, weights)
    return df.agg(F.sum(error * error).alias("sse"))


def squared_error_gradient(df: DataFrame, features: Sequence[str], label: str, weights: Sequence[float]) -> DataFrame:
    """2X'Xw - 2X'y, one row per feature, from one aggregate."""
    error = linear_prediction(features, weights) - F.col(label)
    row = df.agg(*[(2.0 * F.sum(F.col(c) * error)).alias(c) for c in features])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("gradient")) for c in features]
    return row.select(F.inline(F.array(*cells)))


@dataclass(frozen=True)
class Descent:
    """Weights found, steps taken, and the gradient's length."""

    weights: tuple[float, ...]
    steps: int
    length: float


def gradient_descent(df: DataFrame, features: Sequence[str], label: str, tolerance: float = 1e-6, most: int = 1000) -> Descent:
    """Least squares without intercept from zero weights: each step is one aggregate over the rows, the gradient 2X'Xw - 2X'y, times
    1 / (2 sum of X squared), which never overshoots. Ends when the gradient is ``tolerance`` times as long as the first one."""
    size = float(df.agg(F.sum(sum(F.col(c).cast("double") * F.col(c) for c in features))).first()[0] or 0.0)
    weights, steps, first = np.zeros(len(features)), 0, None
    while True:
        found = {r["feature"]: r["gradient"] for r in squared_error_gradient(df, features, label, weights).collect()}
        gradient = np.array([found[c] or 0.0 for c in features])
        length = float(np.sqrt((gradient * gradient).sum()))
        first = length if first is None else first
        if length <= tolerance * first or steps == most:
            return Descent(tuple(map(float, weights)), steps, length)
        weights = weights - gradient / (2 * size)
        steps += 1


def lasso_objective(df: DataFrame, features: Sequence[str], label: str, weights: Sequence[float], alpha: float) -> DataFrame:
    """Half the mean squared error plus alpha times the sum of absolute weights."""
    error = F.col(label) - linear_prediction(features, weights)
    penalty = alpha * sum(abs(w) for w in weights)
    return df.agg((F.avg(error * error) / 2.0 + F.lit(penalty)).alias("objective"))


def lasso_gradient(df: DataFrame, features: Sequence[str], label: str, weights: Sequence[float], alpha: float) -> DataFrame:
    """Subgradient of the lasso objective, one row per feature."""
    error = linear_prediction(features, weights) - F.col(label)
    sign = lambda w: float((w > 0) - (w < 0))
    row = df.agg(*[(F.avg(F.col(c) * error) + F.lit(alpha * sign(w))).alias(c) for c, w in zip(features, weights, strict=True)])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("gradient")) for c in features]
    return row.select(F.inline(F.array(*cells)))


def sparse_matvec(cells: DataFrame, vector: DataFrame, row: str, column: str, value: str, entry: str) -> DataFrame:
    """Sparse matrix (row, column, value) times vector (column, entry). Cells of one (row, column) are summed before
    the join, and products are partially summed before the shuffle by row."""
    compact = cells.groupBy(row, column).agg(F.sum(value).alias("_value"))
    joined = compact.join(vector.select(column, entry), column)
    return joined.groupBy(row).agg(F.sum(F.col("_value") * F.col(entry)).alias("product"))
