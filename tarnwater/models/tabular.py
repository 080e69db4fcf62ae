"""From a raw table to features for a regression: rows without missing values, a split by order, one-hot columns, standardised features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.models import penalised
from tarnwater.operators import features, splits
from tarnwater.operators.aggregate import column_values
from tarnwater.session import materialize


@dataclass(frozen=True)
class Prepared:
    """Rows (target, features, is_train), written once, and the names of the features."""

    rows: DataFrame
    target: str
    features: tuple[str, ...]


def prepare(df: DataFrame, target: str, numeric: Sequence[str], category: str, order: Sequence[str], test_share: float = 0.15) -> Prepared:
    """Rows without NULL in the target, the numeric columns or the category; the last ``test_share`` of them in ``order`` are the test.

    The category becomes one column for each value that the training rows hold (a value that only the test holds is 0 in all of them). All features
    are standardised by the training rows' mean and sample deviation; one that is constant there is an error.
    """
    kept = df.dropna(subset=[target, *numeric, category])
    columns = dict.fromkeys([target, *numeric, category, *order])
    flagged = materialize(splits.ordered_split(kept.select(*columns), list(order), test_share), "ordered")
    values = column_values(flagged.where("is_train"), category, 1000)
    coded = {f"{category}_{v}": (F.col(category) == F.lit(v)).cast("double") for v in values}
    names = (*numeric, *coded)
    rows = flagged.select(F.col(target).cast("double").alias(target), *[F.col(c).cast("double").alias(c) for c in numeric], *[x.alias(c) for c, x in coded.items()], "is_train")
    train, test = features.standardise_columns(rows.where("is_train"), names, rows.where("not is_train"))
    return Prepared(materialize(train.unionByName(test), "prepared"), target, names)


def lasso(data: Prepared, alpha: float) -> penalised.Penalised:
    """Half the mean squared error plus alpha times the sum of absolute coefficients, with an intercept, on the training rows."""
    return penalised.fit(data.rows.where("is_train"), data.features, data.target, penalised.GAUSSIAN, alpha, 1.0)


def errors_by_side(data: Prepared, prediction: Column) -> DataFrame:
    """(is_train, n, rmse, deviation): error of the predictions and population deviation of the target, on both sides of the split."""
    error = F.col(data.target) - prediction
    return data.rows.groupBy("is_train").agg(F.count("*").alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"), F.stddev_pop(data.target).alias("deviation"))


@dataclass(frozen=True)
class Projection:
    """Rows with a column per component, each component's share in the variance of all kept ones, and the eigenvalues of the loadings' covariance."""

    rows: DataFrame
    shares: tuple[float, ...]
    loadings: np.ndarray

    @property
    def eigenvalues(self) -> tuple[float, ...]:
        """Of the covariance of the loadings between components, the largest first."""
        return tuple(sorted((float(v) for v in np.linalg.eigvalsh(np.atleast_2d(np.cov(self.loadings, rowvar=False)))), reverse=True))


def wide_projection(cells: DataFrame, row: str, column: str, value: str, k: int = 2, most: int = 1000) -> Projection:
    """Cells (row, column, value) summed into one wide row each, missing cells 0, features divided by their sample deviation and projected on k
    components (pc1, ...). The largest loading of a component, the first of equal ones, is positive. Constant columns become 0. Cells without a row or a column
    are left out. More than ``most`` columns are an error."""
    cells = cells.dropna(subset=[row, column])
    names = column_values(cells, column, most)
    wide = cells.groupBy(row).pivot(column, names).agg(F.sum(value)).na.fill(0)
    wide = materialize(wide.select(row, *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)]), "wide")
    scaled = features.scale_unit_std(features.assemble(wide, [f"c{i}" for i in range(len(names))]))
    model = features.fit_pca(scaled, k, "scaled")
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(0), np.arange(k)])
    projected = model.transform(scaled).withColumn("p", vector_to_array("projected"))
    rows = projected.select(row, *[(F.col("p")[i] * float(signs[i])).alias(f"pc{i + 1}") for i in range(k)])
    return Projection(rows, tuple(features.retained_variance(model)), loadings * signs)
