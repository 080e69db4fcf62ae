"""Generalised linear models with L1 and L2 penalties, by iteratively reweighted least squares.

One aggregate over the rows gives the loss, its gradient and its Hessian at the present coefficients: 1 + d + d (d + 1) / 2 sums,
combined in the map tasks, and all that reaches the driver. There a d x d quadratic problem with the penalties is solved by cyclic
coordinate descent (without L1 that is one weighted least squares step, with it a proximal Newton step), a step that doesn't
lower the objective is halved, and the fit ends when no coefficient can lower it further. Meant for up to some dozens of features.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.operators.stats import linear_prediction


@dataclass(frozen=True)
class Family:
    """Mean, its slope (the weight of a row) and loss of a linear prediction."""

    mean: Callable[[Column], Column]
    slope: Callable[[Column], Column]
    loss: Callable[[Column, Column], Column]


GAUSSIAN = Family(lambda eta: eta, lambda mu: F.lit(1.0), lambda y, eta: (y - eta) * (y - eta) / 2)
LOGISTIC = Family(
    lambda eta: 1 / (1 + F.exp(-eta)),
    lambda mu: mu * (1 - mu),
    lambda y, eta: F.log1p(F.exp(-F.abs(eta))) + F.greatest(eta, F.lit(0.0)) - y * eta,
)
POISSON = Family(F.exp, lambda mu: mu, lambda y, eta: F.exp(eta) - y * eta)


@dataclass(frozen=True)
class Penalised:
    """A fit: coefficients in the order of the features, intercept (0 without one), rounds, and how far the optimality
    conditions are missed (the largest subgradient of the mean objective)."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    rounds: int
    gap: float

    def prediction(self) -> Column:
        """The linear prediction of a row."""
        return linear_prediction(self.features, self.coefficients, self.intercept)

    def table(self, df: DataFrame) -> DataFrame:
        """(term, coefficient), the intercept first."""
        rows = [("intercept", self.intercept), *zip(self.features, self.coefficients, strict=True)]
        return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def _sums(df: DataFrame, terms: list[Column], label: str, family: Family, beta: np.ndarray, weight: str | None) -> tuple[float, float, np.ndarray, np.ndarray]:
    """(weight of all rows, loss, gradient, Hessian) in one pass."""
    eta = sum((F.lit(float(b)) * x for b, x in zip(beta, terms, strict=True)), F.lit(0.0))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    d = len(terms)
    seen = df.select(*[x.cast("double").alias(f"x{i}") for i, x in enumerate(terms)], F.col(label).cast("double").alias("y"), eta.alias("eta"), w.alias("w"))
    seen = seen.withColumn("mu", family.mean(F.col("eta")))
    error, slope = F.col("w") * (F.col("mu") - F.col("y")), F.col("w") * family.slope(F.col("mu"))
    seen = seen.withColumns({"e": error, "s": slope})
    row = seen.agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * family.loss(F.col("y"), F.col("eta"))).alias("loss"), *[F.sum(F.col("e") * F.col(f"x{i}")).alias(f"g{i}") for i in range(d)],
        *[F.sum(F.col("s") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i in range(d) for j in range(i, d)],
    ).first()
    if not row["n"]:
        raise ValueError("no rows to fit on")
    hessian = np.array([[row[f"h{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)], float)
    return row["n"], row["loss"], np.array([row[f"g{i}"] for i in range(d)], float), hessian


def _quadratic_step(beta: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, l1: np.ndarray, l2: np.ndarray, sweeps: int = 2000) -> np.ndarray:
    """Minimum of the quadratic model at ``beta`` with both penalties, by cyclic coordinate descent."""
    b = beta.copy()
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(b)):
            bend = hessian[j, j] + l2[j]
            if bend <= 0:
                continue
            pull = hessian[j, j] * b[j] - gradient[j] - hessian[j] @ (b - beta)
            new = math.copysign(max(abs(pull) - l1[j], 0.0), pull) / bend
            moved = max(moved, abs(new - b[j]) * math.sqrt(bend))
            b[j] = new
        if moved < 1e-13 * (1 + np.abs(b).max()):
            break
    return b


def signed_step(beta: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The same minimum for dozens of related features, where sweeps alone creep: a few tell which coefficients are 0 and the signs of the others,
    for which the model is solved at once; more follow as long as that solution has other signs or misses the conditions at a 0."""
    b, bent = beta, hessian + np.diag(l2)
    for _ in range(400):
        b = _quadratic_step(b, gradient + hessian @ (b - beta), hessian, l1, l2, 5)
        used = ((b != 0) | (l1 == 0)) & (np.diag(bent) > 0)
        solved = np.zeros(len(b))
        solved[used] = np.linalg.lstsq(bent[np.ix_(used, used)], (hessian @ beta - gradient - l1 * np.sign(b))[used], rcond=None)[0]
        slope = gradient + hessian @ (solved - beta) + l2 * solved
        kept = (np.sign(solved) == np.sign(b)) | (l1 == 0)
        if kept[used].all() and (np.abs(slope[~used]) <= l1[~used] * (1 + 1e-9)).all():
            return solved
    return b


def _gap(beta: np.ndarray, gradient: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> float:
    """Largest violation of the optimality conditions."""
    slope = gradient + l2 * beta
    return float(np.where(beta != 0, np.abs(slope + l1 * np.sign(beta)), np.maximum(np.abs(slope) - l1, 0)).max())


def rounds_of(
    beta: np.ndarray, n: float, absolute: np.ndarray, square: np.ndarray, tolerance: float, most: int, step_of: Callable[..., np.ndarray] = _quadratic_step
) -> Generator[np.ndarray, tuple[float, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, int]]:
    """The rounds of a fit: yields the coefficients at which it wants (loss, gradient, Hessian) of all rows next, and returns the last ones with
    their gradient and the number of rounds. Whoever drives it may so serve many fits from one reading of the rows."""
    objective = lambda x, b: x + float(absolute @ np.abs(b)) + float(square @ (b * b)) / 2
    loss, gradient, hessian = yield beta
    rounds = 1
    while _gap(beta, gradient, absolute, square) > tolerance * n and rounds < most:
        wanted = step_of(beta, gradient, hessian, absolute, square)
        step, before = 1.0, objective(loss, beta)
        while True:
            trial = beta + step * (wanted - beta)
            loss_, gradient_, hessian_ = yield trial
            rounds += 1
            if objective(loss_, trial) <= before + 1e-12 * abs(before) or step < 1e-6 or rounds >= most:
                break
            step /= 2
        done = step < 1e-6 or np.abs(trial - beta).max() < 1e-13
        beta, loss, gradient, hessian = trial, loss_, gradient_, hessian_
        if done:
            break
    return beta, gradient, rounds


def fit(
    df: DataFrame, features: Sequence[str], label: str, family: Family, penalty: float = 0.0, l1: float = 0.0, weight: str | None = None, intercept: bool = True,
    tolerance: float = 1e-9, most: int = 50,
) -> Penalised:
    """Minimise mean loss + penalty * (l1 * sum |b| + (1 - l1) / 2 * sum b^2); the intercept isn't penalised.

    ``df`` is read once a round, so cache what is costly. ``weight`` counts a row more than once. NULLs are an error of the caller:
    a row with one drops out of the sums that need it.
    """
    terms = [*([F.lit(1.0)] if intercept else []), *[F.col(c) for c in features]]
    free = int(intercept)
    share = np.array([0.0] * free + [1.0] * len(features))
    beta = np.zeros(len(terms))
    if intercept and family is POISSON:
        beta[0] = math.log(max(df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0, 1e-9))
    first = _sums(df, terms, label, family, beta, weight)
    n, found = first[0], first[1:]
    absolute, square = n * penalty * l1 * share, n * penalty * (1 - l1) * share
    steps = rounds_of(beta, n, absolute, square, tolerance, most)
    next(steps)
    while True:
        try:
            trial = steps.send(found)
        except StopIteration as end:
            beta, gradient, rounds = end.value
            break
        found = _sums(df, terms, label, family, trial, weight)[1:]
    gap = _gap(beta, gradient, absolute, square) / n
    return Penalised(tuple(features), tuple(map(float, beta[free:])), float(beta[0]) if intercept else 0.0, rounds, gap)
