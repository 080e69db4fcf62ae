"""The chains over whole tables against numpy on small rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwater.models import tabular


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(5)
    data = [(i, float(a), float(b), "xyz"[i % 3], float(3 * a - b + (i % 3 == 1) * 2 + 0.1 * e)) for i, (a, b, e) in enumerate(draw.normal(size=(200, 3)))]
    data += [(200 + i, None, 1.0, "x", 1.0) for i in range(5)] + [(210, 1.0, 1.0, None, 1.0), (211, 1.0, 1.0, "x", None), (212, 0.5, 0.5, "late", 1.0)]
    return spark.createDataFrame(data, "id long, a double, b double, kind string, y double"), data


def test_preparation(rows):
    df, data = rows
    found = tabular.prepare(df, "y", ["a", "b"], "kind", ["id"], 0.15)
    kept = [r for r in data if None not in r]
    train = kept[: len(kept) - int(np.ceil(0.15 * len(kept)))]
    assert found.features == ("a", "b", "kind_x", "kind_y", "kind_z")
    assert found.rows.where("is_train").count() == len(train) and found.rows.count() == len(kept)
    a = np.array([r[1] for r in train])
    moments = found.rows.where("is_train").agg(*[f(c) for c in ("a", "kind_z") for f in (F.avg, F.stddev_samp)]).first()
    assert np.allclose(list(moments), [0, 1, 0, 1], atol=1e-9)
    last = found.rows.where("not is_train").orderBy("a").toPandas()
    assert np.allclose(last["a"], sorted((r[1] - a.mean()) / a.std(ddof=1) for r in kept[len(train) :]))


def test_value_of_the_test_side_alone_is_in_no_column(rows):
    df, _ = rows
    found = tabular.prepare(df.where("id = 212 or id < 200"), "y", ["a", "b"], "kind", ["id"], 0.01)
    assert "kind_late" not in found.features
    raw = found.rows.where("not is_train").select("kind_x", "kind_y", "kind_z").collect()
    assert any(all(v < 0 for v in r) for r in raw)


def test_lasso_reaches_the_optimum(rows):
    df, _ = rows
    data = tabular.prepare(df.where("id < 200"), "y", ["a", "b"], "kind", ["id"], 0.15)
    fit = tabular.lasso(data, 0.1)
    assert fit.gap < 1e-8
    local = data.rows.where("is_train").toPandas()
    x, y = local[list(data.features)].to_numpy(), local["y"].to_numpy()
    slope = x.T @ (y - fit.intercept - x @ np.array(fit.coefficients)) / len(y)
    for s, b in zip(slope, fit.coefficients, strict=True):
        assert abs(s - 0.1 * np.sign(b)) < 1e-7 if b else abs(s) <= 0.1 + 1e-7
    sides = {r["is_train"]: r for r in tabular.errors_by_side(data, fit.prediction()).collect()}
    assert sides[True]["n"] == 170 and all(r["rmse"] < 0.2 * r["deviation"] for r in sides.values())


def test_projection(spark):
    draw = np.random.default_rng(6)
    dense = draw.integers(0, 9, (30, 4)) * np.array([1, 5, 1, 2])
    cells = [(i, f"w.{j}", int(v)) for i, r in enumerate(dense) for j, v in enumerate(r) if v] + [(0, "w.0", 4), (0, "w.0", None)]
    dense[0, 0] += 4
    found = tabular.wide_projection(spark.createDataFrame(cells, "paper long, word string, n long"), "paper", "word", "n")
    scaled = dense / dense.std(0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(scaled, rowvar=False))
    vectors = vectors[:, ::-1][:, :2]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), range(2)])
    assert np.allclose(np.array([r[1:] for r in found.rows.orderBy("paper").collect()]), scaled @ vectors)
    assert np.allclose(found.shares, values[::-1][:2] / values[::-1][:2].sum())
    assert np.allclose(found.eigenvalues, np.linalg.eigvalsh(np.cov(vectors, rowvar=False))[::-1])


def test_too_many_columns(spark):
    cells = spark.range(5).select("id", F.col("id").alias("word"), F.lit(1).alias("n"))
    with pytest.raises(ValueError, match="more than 4"):
        tabular.wide_projection(cells, "id", "word", "n", most=4)
