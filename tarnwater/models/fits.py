"""Regression and classification fits, and their coefficients as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Seed, penalty and iteration limit of the documented experiments.
SEED = 6
PENALTY = 0.01
MAX_ITERATIONS = 50


def poisson_regression(label: str, features: str = "features", penalty: float = PENALTY, **params) -> GeneralizedLinearRegression:
    """Poisson regression with log link."""
    settings = {"maxIter": MAX_ITERATIONS, **params}
    return GeneralizedLinearRegression(labelCol=label, featuresCol=features, family="poisson", link="log", regParam=penalty, **settings)


def linear_regression(label: str, features: str = "features", penalty: float = PENALTY, l1: float = 0.0, **params) -> LinearRegression:
    """Least squares with an L2 (``l1=0``) or L1 (``l1=1``) penalty; no penalty gives ordinary least squares."""
    settings = {"maxIter": MAX_ITERATIONS, "solver": "normal", **params}
    return LinearRegression(labelCol=label, featuresCol=features, regParam=penalty, elasticNetParam=l1, **settings)


def lasso(label: str, features: str = "features", alpha: float = 0.1, intercept: bool = True, **params) -> LinearRegression:
    """Lasso on the raw scale: half the mean squared error plus alpha times the absolute weights."""
    return linear_regression(label, features, alpha, 1.0, standardization=False, fitIntercept=intercept, **params)


def logistic_regression(label: str, features: str = "features", penalty: float = PENALTY, l1: float = 0.0, **params) -> LogisticRegression:
    """Logistic regression, two classes unless ``family`` says otherwise."""
    settings = {"maxIter": MAX_ITERATIONS, "family": "binomial", **params}
    return LogisticRegression(labelCol=label, featuresCol=features, regParam=penalty, elasticNetParam=l1, **settings)


def boosted_trees(label: str, features: str = "features", depth: int = 2, bins: int = 3, rounds: int = 5, **params) -> GBTClassifier:
    """Gradient-boosted trees, logistic loss, every tree on half of the rows."""
    settings = {"lossType": "logistic", "subsamplingRate": 0.5, "seed": SEED, "minInstancesPerNode": 1, **params}
    return GBTClassifier(labelCol=label, featuresCol=features, maxDepth=depth, maxBins=bins, maxIter=rounds, **settings)


def forest_classifier(label: str, features: str = "features", trees: int = 5, depth: int = 2, bins: int = 3, **params) -> RandomForestClassifier:
    """Random forest for classes."""
    settings = {"seed": SEED, **params}
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, maxBins=bins, **settings)


def forest_regressor(label: str, features: str = "features", trees: int = 10, max_features: int | str = "auto", sample: float = 1.0, **params) -> RandomForestRegressor:
    """Random forest for numbers; ``max_features`` per split and ``sample`` of the rows per tree."""
    settings = {"seed": SEED, **params}
    return RandomForestRegressor(
        labelCol=label, featuresCol=features, numTrees=trees, featureSubsetStrategy=str(max_features), subsamplingRate=sample, **settings
    )


def perceptron(label: str, layers: Sequence[int], features: str = "features", **params) -> MultilayerPerceptronClassifier:
    """Fully connected network with sigmoid hidden units and a softmax output."""
    settings = {"maxIter": MAX_ITERATIONS, "seed": SEED, **params}
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=list(layers), **settings)


def compact_rows(df: DataFrame, columns: Sequence[str], weight: str = "weight") -> DataFrame:
    """Equal training rows as one row with their number as weight. With few distinct rows every iteration of a weighted
    fit then costs as good as nothing, and the result is the same."""
    return df.groupBy(*columns).agg(F.count("*").cast("double").alias(weight))


def coefficient_table(model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """Intercept and one coefficient per feature; zeros of a sparse result included."""
    values = [float(v) for v in model.coefficients.toArray()]
    rows = [("intercept", float(model.intercept)), *zip(features, values, strict=True)]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


def rectify(column: str) -> "F.Column":
    """max(x, 0) per array position."""
    return F.transform(column, lambda x: F.greatest(x, F.lit(0.0)))
