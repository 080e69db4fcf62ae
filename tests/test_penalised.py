"""Penalised fits against Spark ML, closed forms and the conditions of an optimum."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwater.models import fits, penalised
from tarnwater.operators import features

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(2)
    data = []
    for _ in range(600):
        a, b, c = draw.gauss(0, 1), draw.random(), float(draw.random() < 0.3)
        z = 0.4 + 0.8 * a - 0.5 * b
        data.append((a, b, c, float(draw.random() < 1 / (1 + np.exp(-z))), float(min(draw.expovariate(1 / np.exp(0.3 * z)) // 0.5, 9)), z + draw.gauss(0, 0.1)))
    return spark.createDataFrame(data, "a double, b double, c double, yes double, n double, y double").cache()


def close(fit, model, tolerance):
    assert np.abs(np.array(fit.coefficients) - model.coefficients.toArray()).max() < tolerance and abs(fit.intercept - model.intercept) < tolerance


@pytest.mark.parametrize(("penalty", "l1"), [(0.0, 0.0), (0.05, 0.0), (0.02, 1.0), (0.05, 0.5)])
def test_logistic_equals_spark(rows, penalty, l1):
    fit = penalised.fit(rows, NAMES, "yes", penalised.LOGISTIC, penalty, l1)
    assert fit.gap < 1e-9 and fit.rounds < 15
    ml = fits.logistic_regression("yes", penalty=penalty, l1=l1, standardization=False, tol=1e-12, maxIter=500)
    close(fit, ml.fit(features.assemble(rows, NAMES)), 1e-4)


@pytest.mark.parametrize(("penalty", "l1"), [(0.0, 0.0), (0.1, 0.0), (0.1, 1.0)])
def test_linear_equals_spark(rows, penalty, l1):
    fit = penalised.fit(rows, NAMES, "y", penalised.GAUSSIAN, penalty, l1)
    settings = {"solver": "auto", "standardization": False, "tol": 1e-12, "maxIter": 1000}
    # Spark divides the square penalty by the label's deviation; the L1 penalty stays.
    deviation = rows.agg(F.stddev_pop("y")).first()[0]
    ml = fits.linear_regression("y", penalty=penalty * (1 if l1 else deviation), l1=l1, **settings)
    close(fit, ml.fit(features.assemble(rows, NAMES)), 1e-4)


def test_poisson_equals_spark(rows):
    # Spark weighs the penalty against the sum of the working weights, which is the sum of the counts here.
    mean = rows.agg(F.avg("n")).first()[0]
    for penalty in (0.0, 0.05):
        fit = penalised.fit(rows, NAMES, "n", penalised.POISSON, penalty * mean, 0.0)
        close(fit, fits.poisson_regression("n", penalty=penalty, tol=1e-12).fit(features.assemble(rows, NAMES)), 1e-5)


def test_weights_count_rows_and_odd_fits(spark, rows):
    twice = rows.select(*NAMES, "yes", F.lit(2.0).alias("w"))
    plain, weighted = (penalised.fit(df, NAMES, "yes", penalised.LOGISTIC, 0.01, 1.0, weight=w) for df, w in ((rows, None), (twice, "w")))
    assert np.allclose(plain.coefficients, weighted.coefficients, atol=1e-8)
    dropped = penalised.fit(rows, NAMES, "yes", penalised.LOGISTIC, 10.0, 1.0)
    assert dropped.coefficients == (0.0, 0.0, 0.0)
    share = rows.agg(F.avg("yes")).first()[0]
    assert abs(dropped.intercept - np.log(share / (1 - share))) < 1e-8
    through = penalised.fit(rows, ["a", "a"], "y", penalised.GAUSSIAN, 0.1, 0.0, intercept=False)
    assert abs(through.coefficients[0] - through.coefficients[1]) < 1e-6 and through.intercept == 0.0
    constant = penalised.fit(rows.withColumn("k", F.lit(0.0)), ["k"], "yes", penalised.LOGISTIC)
    assert constant.coefficients == (0.0,)
    with pytest.raises(ValueError, match="no rows"):
        penalised.fit(rows.where("a > 100"), NAMES, "yes", penalised.LOGISTIC)


def test_steps_by_signs_equal_those_by_sweeps():
    draw = np.random.default_rng(3)
    for l1 in (0.0, 2.0, 40.0, 1e6):
        x = draw.normal(size=(200, 12)) + draw.normal(size=(200, 1)) * 3
        x[:, 5] = 0.0
        beta, gradient, hessian = draw.normal(size=12), draw.normal(size=12) * 30, x.T @ x
        absolute, square = np.append(0.0, np.full(11, l1)), np.append(0.0, np.full(11, 0.5))
        slow = penalised._quadratic_step(beta, gradient, hessian, absolute, square, 200_000)
        assert np.allclose(penalised.signed_step(beta, gradient, hessian, absolute, square), slow, atol=1e-8)
