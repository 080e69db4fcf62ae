"""String index, singular vectors, gradient descent and p-values on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnwater.operators import features, stats


def test_string_index_with_a_hot_value_and_nulls(spark):
    values = ["hot"] * 900 + ["b"] * 20 + ["a"] * 20 + ["ß"] * 3 + [""] * 2 + [f"v{i}" for i in range(30)]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "id bigint, c string, _same string").repartition(5)
    found = features.string_index(df, ["c"])
    assert found.columns == ["id", "c", "_same", "c_index"] and found.count() == len(values)
    codes = {r["c"]: r["c_index"] for r in found.select("c", "c_index").distinct().collect()}
    order = sorted(set(values), key=lambda v: (-values.count(v), v.encode()))
    assert codes == {v: float(i) for i, v in enumerate(order)}
    assert all(r["c"] == r["_same"] for r in found.collect())
    holed = df.unionByName(spark.createDataFrame([(-1, None, None)], df.schema))
    assert features.string_index(holed, ["c"], "skip").count() == len(values)
    assert features.string_index(holed, ["c"], "keep").where("id = -1").first()["c_index"] == len(order)
    with pytest.raises(Exception, match="c holds NULL"):
        features.string_index(holed, ["c"]).collect()
    assert features.string_index(df.limit(0), ["c", "_same"]).count() == 0


def test_string_index_of_a_million_labels(spark):
    df = spark.range(1_000_000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("c"))
    found = features.string_index(df, ["c"]).agg(F.countDistinct("c_index").alias("n"), F.max("c_index").alias("last"), F.count_if(F.substring("c", 2, 7).cast("double") == F.col("c_index")).alias("same")).first()
    assert tuple(found) == (1_000_000, 999_999.0, 1_000_000)


def test_singular_vectors_restore_the_rows(spark):
    x = np.random.default_rng(4).normal(size=(200, 4)) @ np.diag([5.0, 2.0, 1.0, 0.1])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    found = stats.singular_vectors(df, list("abcd"))
    left = found.left(df)
    u = np.array([[r[f"u{i}"] for i in range(1, 5)] for r in left.collect()])
    back = np.array([list(r)[:4] for r in left.collect()])
    assert np.abs(u.T @ u - np.eye(4)).max() < 1e-6
    assert np.abs(u @ np.diag(found.values) @ np.array(found.right) - back).max() < 1e-6
    assert all(v[int(np.argmax(np.abs(v)))] > 0 for v in found.right)
    assert np.allclose(found.values, np.linalg.svd(x, compute_uv=False))
    flat = stats.singular_vectors(df.withColumn("b", F.col("a")), ["a", "b"])
    assert flat.values[1] < 1e-5 * flat.values[0]
    assert stats.singular_vectors(df.where("a > 100"), ["a", "b"]).left(df.limit(1)).first()["u1"] is None


def test_gradient_descent_reaches_the_closed_form(spark):
    x = np.random.default_rng(9).normal(size=(300, 3))
    y = x @ [1.0, -2.0, 0.5] + 0.1
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double")
    found = stats.gradient_descent(df, list("abc"), "y", tolerance=1e-8)
    assert np.allclose(found.weights, np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-6) and 5 < found.steps < 200
    assert stats.gradient_descent(df, list("abc"), "y", most=3).steps == 3
    assert stats.gradient_descent(df.where("a > 100"), list("abc"), "y").weights == (0.0, 0.0, 0.0)


def test_p_value_column(spark):
    # Quantiles of Student's t from printed tables, and the closed forms for one and two degrees.
    cases = [(2.306, 8, 0.05), (1.96, 1_000_000, 0.05), (-2.306, 8, 0.05), (0.0, 5, 1.0), (12.706, 1, 0.05), (1.0, 1, 0.5), (2.0, 2, 1 - 2 / math.sqrt(6)), (60.0, 50_000, 0.0)]
    rows = spark.createDataFrame([(float(t), float(n), p) for t, n, p in cases], "t double, n double, p double")
    for r in rows.select("p", stats.p_value(F.col("t"), F.col("n")).alias("found")).collect():
        assert r["found"] == pytest.approx(r["p"], abs=1e-4)
