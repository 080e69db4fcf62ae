"""Cross-validation, validation curves and best parameters as tables."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.models.metrics import MacroF1, macro_f1
from tarnwater.models.penalised import rounds_of, signed_step
from tarnwater.operators.features import assemble
from tarnwater.operators.splits import random_parts
from tarnwater.session import gather


def param_grid(choices: Mapping[Param, Sequence]) -> list[dict]:
    """All combinations of the listed values."""
    builder = ParamGridBuilder()
    for param, values in choices.items():
        builder = builder.addGrid(param, list(values))
    return builder.build()


def cross_validate(
    df: DataFrame, keys: Sequence[str], estimator: Estimator, grid: list[dict], evaluator: Evaluator, folds: int, seed: int, parallelism: int = 8
) -> CrossValidatorModel:
    """k-fold search. The fold of a row is the hash of its key, so a recomputed row stays in its fold."""
    folded = random_parts(df, keys, [1.0] * folds, seed, "_fold").cache()
    try:
        search = CrossValidator(
            estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="_fold", parallelism=parallelism
        )
        return search.fit(folded)
    finally:
        folded.unpersist()


def fold_moments(df: DataFrame, keys: Sequence[str], columns: Sequence[str], folds: int, seed: int) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(rows, means, sums of products of deviations) of every fold, from one pass; only d x d numbers a fold reach the driver."""
    d = len(columns)
    folded = random_parts(df, keys, [1.0] * folds, seed, "_fold")
    near = folded.select(*[F.col(c).cast("double").alias(c) for c in columns]).first()  # sums of values less a row's own keep their digits
    if near is None:
        raise ValueError("no rows to fit on")
    moved = folded.select("_fold", *[(F.col(c).cast("double") - F.lit(near[c] or 0.0)).alias(f"x{i}") for i, c in enumerate(columns)])
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {r["_fold"]: r for r in moved.groupBy("_fold").agg(F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(d)], *products).collect()}
    if len(found) < folds:
        raise ValueError(f"{folds - len(found)} of {folds} folds are empty")
    parts = []
    for r in (found[k] for k in range(folds)):
        n, sums = float(r["n"]), np.array([r[f"s{i}"] for i in range(d)], float)
        squares = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)], float)
        parts.append((n, sums / n + np.array([near[c] or 0.0 for c in columns]), squares - np.outer(sums, sums) / n))
    return parts


def _united(parts: Sequence[tuple[float, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """Moments of all rows of several parts."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    return n, mean, sum(p[2] + p[0] * np.outer(p[1] - mean, p[1] - mean) for p in parts)


def _ridge(moments: tuple[float, np.ndarray, np.ndarray], penalty: float) -> np.ndarray:
    """Coefficients of a linear fit on standardised features and label, label last in the moments; a constant feature gets 0."""
    cov = moments[2] / moments[0]
    scale = np.sqrt(np.diag(cov))
    used = scale[:-1] > 0
    out = np.zeros(len(used))
    if scale[-1] > 0 and used.any():
        unit = cov / np.outer(np.where(scale > 0, scale, 1.0), np.where(scale > 0, scale, 1.0))
        inner = unit[:-1, :-1][np.ix_(used, used)] + np.eye(int(used.sum())) * penalty / scale[-1]
        out[used] = np.linalg.lstsq(inner, unit[:-1, -1][used], rcond=None)[0] * scale[-1] / scale[:-1][used]
    return out


def cross_validate_ridge(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], estimator: LinearRegression, penalties: Sequence[float], folds: int, seed: int
) -> CrossValidatorModel:
    """k-fold search over the L2 penalties of a linear fit with an intercept on standardised features, by root mean squared error. Fits and errors of
    all folds follow from the folds' moments, so the rows are read once for the search and once for the best fit."""
    label = estimator.getLabelCol()
    parts = fold_moments(df, keys, [*columns, label], folds, seed)
    errors = np.empty((folds, len(penalties)))
    for k, (n, mean, products) in enumerate(parts):
        train = _united(parts[:k] + parts[k + 1 :])
        for j, penalty in enumerate(penalties):
            slope = np.append(-_ridge(train, penalty), 1.0)
            errors[k, j] = np.sqrt(max(slope @ products @ slope / n + (slope @ (mean - train[1])) ** 2, 0.0))
    scores = errors.mean(axis=0)
    grid = param_grid({estimator.regParam: penalties})
    best = estimator.fit(assemble(df, columns, estimator.getFeaturesCol()), grid[int(scores.argmin())])
    model = CrossValidatorModel(best, [float(x) for x in scores], None, [float(x) for x in errors.std(axis=0)])
    model.set(model.estimatorParamMaps, grid)
    model.set(model.evaluator, RegressionEvaluator(labelCol=label, metricName="rmse"))
    return model


# Rows of a block at most: its matrix and the weighted copy that a task makes of it stay small.
BLOCK = 4096


def _blocks(folded: DataFrame, features: str, label: str) -> DataFrame:
    """Rows as blocks of one fold (fold, n, rows): a binary matrix of doubles, each row the label and behind it the features."""
    wanted = F.col(label).cast("double")
    checked = F.when(wanted.isin(0.0, 1.0), wanted).otherwise(F.raise_error(F.concat(F.lit("labels must be 0 or 1, but got "), F.coalesce(wanted.cast("string"), F.lit("NULL")))))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, y = (batch.column(i).to_numpy() for i in (0, 1))
            rows = np.column_stack([y, batch.column(2).flatten().to_numpy().reshape(len(y), -1)]) if len(y) else np.zeros((0, 1))
            for k in np.unique(fold):
                mine = rows[fold == k]
                for start in range(0, len(mine), BLOCK):
                    piece = mine[start : start + BLOCK]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(piece)], pa.int32()), pa.array([piece.tobytes()], pa.binary())], ["fold", "n", "rows"])

    return folded.select("_fold", checked.alias("_label"), vector_to_array(features).alias("_features")).mapInArrow(packed, "fold int, n int, rows binary")


def _summed(blocks: DataFrame, shape: tuple[int, ...], add) -> np.ndarray:
    """Sum of an array over all blocks: a task adds those of its blocks by ``add(total, fold, matrix)`` and sends one to the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for fold, n, rows in zip(*(batch.column(i) for i in range(3)), strict=True):
                add(total, fold.as_py(), np.frombuffer(rows.as_buffer(), float).reshape(n.as_py(), -1))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    return sum((np.frombuffer(r["total"], float).reshape(shape) for r in blocks.mapInArrow(sums, "total binary").collect()), np.zeros(shape))


def _fold_scales(blocks: DataFrame, folds: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows outside each fold: their number, those with label 1, means and deviations (n - 1) of the features."""

    def add(total, fold, rows):
        total[fold, 0] += len(rows)
        total[fold, 1:] += rows.sum(axis=0)

    first = _summed(blocks, (folds, d + 2), add)
    if (first[:, 0] == 0).any():
        raise ValueError(f"{(first[:, 0] == 0).sum()} of {folds} folds are empty")
    near = first[:, 2:].sum(axis=0) / first[:, 0].sum()  # squares are taken around the mean of all rows, which keeps their digits

    def spread(total, fold, rows):
        total[fold] += ((rows[:, 1:] - near) ** 2).sum(axis=0)

    others = 1.0 - np.eye(folds)
    n, positive, sums = (lambda x: (x[:, 0], x[:, 1], x[:, 2:]))(others @ first)
    mean = sums / n[:, None]
    squares = others @ _summed(blocks, (folds, d), spread) - n[:, None] * (mean - near) ** 2
    return n, positive, mean, np.sqrt(np.maximum(squares, 0.0) / np.maximum(n - 1, 1)[:, None])


def _margin_sums(blocks: DataFrame, points: Sequence[tuple[int, np.ndarray]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(loss, gradient, Hessian) of the logistic loss for many fits in one reading of the rows; a point is the fold that its fit leaves out and its
    coefficients, intercept first."""
    held, beta = np.array([k for k, _ in points]), np.array([b for _, b in points]).T
    d = len(beta)

    def add(total, fold, rows):
        fits = np.flatnonzero(held != fold)
        y, x = rows[:, :1], rows.copy()
        x[:, 0] = 1.0
        eta = x @ beta[:, fits]
        mu = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
        total[fits, 0] += (np.logaddexp(0, eta) - y * eta).sum(axis=0)
        total[fits, 1 : d + 1] += (x.T @ (mu - y)).T
        root = np.sqrt(mu * (1 - mu))
        for i, fit in enumerate(fits):
            weighted = x * root[:, i : i + 1]
            total[fit, d + 1 :] += (weighted.T @ weighted).ravel()

    return [(s[0], s[1 : d + 1], s[d + 1 :].reshape(d, d)) for s in _summed(blocks, (len(points), 1 + d + d * d), add)]


def _confusions(blocks: DataFrame, points: Sequence[tuple[int, np.ndarray]]) -> np.ndarray:
    """For every point, rows of its left-out fold by label and prediction, 2 x 2."""
    held, beta = np.array([k for k, _ in points]), np.array([b for _, b in points]).T

    def add(total, fold, rows):
        for fit in np.flatnonzero(held == fold):
            predicted = rows[:, 1:] @ beta[1:, fit] + beta[0, fit] > 0
            total[fit] += np.bincount((2 * rows[:, 0] + predicted).astype(int), minlength=4).reshape(2, 2)

    return _summed(blocks, (len(points), 2, 2), add)


def cross_validate_logistic(
    df: DataFrame, keys: Sequence[str], estimator: LogisticRegression, grid: list[dict], evaluator: MacroF1, folds: int, seed: int
) -> CrossValidatorModel:
    """k-fold search over the penalties of a logistic fit of two classes with an intercept on standardised features, by macro F1. All fits of all folds
    go on side by side: a round reads the rows once and gives every fit its loss, gradient and Hessian, so the number of readings is that of
    the slowest fit and not the sum of all. What reaches the driver doesn't grow with the rows. ``maxIter`` bounds the steps of a fit, ``tol`` is
    how far its optimality conditions may be missed. Spark's estimator fits the best point on all rows."""
    if not (estimator.getFitIntercept() and estimator.getStandardization()):
        raise ValueError("needs an intercept and standardised features")
    blocks = gather(_blocks(random_parts(df, keys, [1.0] * folds, seed, "_fold"), estimator.getFeaturesCol(), estimator.getLabelCol())).cache()
    try:
        size = blocks.select((F.length("rows") / (8 * F.col("n"))).cast("int").alias("w")).first()
        if size is None:
            raise ValueError("no rows to fit on")
        d = size["w"] - 1
        n, positive, mean, scale = _fold_scales(blocks, folds, d)
        running, moves, results = {}, {}, {}
        for k, (j, point) in product(range(folds), enumerate(grid)):
            if positive[k] in (0, n[k]):  # one class: it is predicted for every row
                results[j, k] = np.append(np.inf if positive[k] else -np.inf, np.zeros(d))
                continue
            # coefficients of standardised features times ``moves[k]`` are those of the raw ones; a constant feature gets 0
            unit = np.divide(1.0, scale[k], out=np.zeros(d), where=scale[k] > 0)
            moves[k] = np.block([[np.ones((1, 1)), -(mean[k] * unit)[None, :]], [np.zeros((d, 1)), np.diag(unit)]])
            settings = estimator.copy(point)
            penalty, mix, free = settings.getRegParam(), settings.getElasticNetParam(), np.append(0.0, np.ones(d))
            # two classes have a row of coefficients each, b / 2 and -b / 2 at the optimum: their squares add up to b^2 / 2
            absolute, square = n[k] * penalty * mix * free, n[k] * penalty * (1 - mix) / 2 * free
            start = np.append(np.log(positive[k] / (n[k] - positive[k])), np.zeros(d))
            running[j, k] = rounds_of(start, n[k], absolute, square, settings.getTol(), settings.getMaxIter() + 1, signed_step)
        wanted = {jk: next(steps) for jk, steps in running.items()}
        while wanted:
            sums = _margin_sums(blocks, [(k, moves[k] @ b) for (_, k), b in wanted.items()])
            for (j, k), (loss, gradient, hessian) in zip(list(wanted), sums, strict=True):
                try:
                    wanted[j, k] = running[j, k].send((loss, moves[k].T @ gradient, moves[k].T @ hessian @ moves[k]))
                except StopIteration as end:
                    results[j, k] = moves[k] @ end.value[0]
                    del wanted[j, k]
        places = list(product(range(len(grid)), range(folds)))
        cells = _confusions(blocks, [(k, results[j, k]) for j, k in places])
    finally:
        blocks.unpersist()
    scores = np.array([macro_f1(c) for c in cells]).reshape(len(grid), folds)
    means = scores.mean(axis=1)
    model = CrossValidatorModel(estimator.fit(df, grid[int(means.argmax())]), [float(x) for x in means], None, [float(x) for x in scores.std(axis=1)])
    model.set(model.estimatorParamMaps, grid)
    model.set(model.evaluator, evaluator)
    return model


def score_table(model: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """One row per grid point: parameters as JSON, mean and deviation over the folds."""
    points = [json.dumps({p.name: v for p, v in point.items()}, sort_keys=True) for point in model.getEstimatorParamMaps()]
    rows = [(i, p, float(m), float(s)) for i, (p, m, s) in enumerate(zip(points, model.avgMetrics, model.stdMetrics, strict=True))]
    return df.sparkSession.createDataFrame(rows, "point int, params string, mean_score double, std_score double")


def validation_curve(model: CrossValidatorModel, param: Param, df: DataFrame) -> DataFrame:
    """Parameter value against mean score."""
    rows = [(float(point[param]), float(score)) for point, score in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True)]
    return df.sparkSession.createDataFrame(rows, "value double, mean_score double")


def best_params_json(model: CrossValidatorModel) -> str:
    """All parameters of the best model as a JSON object."""
    best = model.bestModel.stages[-1] if hasattr(model.bestModel, "stages") else model.bestModel
    plain = lambda v: v if isinstance(v, (int, float, str, bool, type(None))) else str(v)
    return json.dumps({p.name: plain(v) for p, v in best.extractParamMap().items()}, sort_keys=True)


def best_point(model: CrossValidatorModel) -> dict:
    """The grid point with the best mean score, to fit again with."""
    pick = max if model.getEvaluator().isLargerBetter() else min
    return model.getEstimatorParamMaps()[model.avgMetrics.index(pick(model.avgMetrics))]


def combinations(choices: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of named settings that are not parameters of one estimator."""
    return [dict(zip(choices, values)) for values in product(*choices.values())]
