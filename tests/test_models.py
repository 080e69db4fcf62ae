"""Fits, metrics and tuning on small tables."""

import json
import random
import threading

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tarnwater.models import fits, metrics, recommend, tuning
from tarnwater.operators import features, splits
from tarnwater.plans import models
from tarnwater.session import Tables


def toy(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (1.0, 3.0, 1.0), (2.2, 3.0, 2.0)], "a double, b double, y double")
    return features.assemble(df, ["a", "b"])


def coefficients(model):
    return [float(c) for c in model.coefficients.toArray()]


def test_toy_least_squares_and_lasso(spark):
    ols = fits.linear_regression("y", penalty=0.0, fitIntercept=False).fit(toy(spark))
    assert coefficients(ols) == pytest.approx([0.8333, 0.0556], abs=1e-4)
    lasso = fits.lasso("y", alpha=0.1, intercept=False, solver="auto", tol=1e-12).fit(toy(spark))
    assert coefficients(lasso) == pytest.approx([0.6389, 0.1426], abs=1e-4)


def test_weighted_distinct_rows_give_the_same_fit(spark):
    rng = random.Random(7)
    rows = [(float(x), float(rng.randrange(4 + 3 * x))) for x in [rng.randrange(2) for _ in range(400)]]
    df = spark.createDataFrame(rows, "x double, y double")
    plain = fits.poisson_regression("y").fit(features.assemble(df, ["x"]))
    weighted = fits.poisson_regression("y", weightCol="weight").fit(features.assemble(fits.compact_rows(df, ["x", "y"]), ["x"]))
    assert coefficients(plain) == pytest.approx(coefficients(weighted), abs=1e-8)


def test_roc_auc_with_ties_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(2), 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(400)]
    got = metrics.roc_auc(spark.createDataFrame(rows, "label int, score double")).first()["auc"]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got == pytest.approx(wins / (len(pos) * len(neg)))


def test_macro_scores_with_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, prediction string")
    row = metrics.macro_scores(df).first()
    assert (row["precision"], row["recall"], row["f1"]) == pytest.approx((1 / 3, 0.5, (0.5 + 2 / 3) / 3))
    assert metrics.MacroF1(labelCol="label").evaluate(df) == pytest.approx(row["f1"])


def test_misclassified_and_log_loss(spark):
    df = spark.createDataFrame([(1, 0, [0.7, 0.3]), (1, 1, [0.2, 0.8])], "label int, prediction int, probabilities array<double>")
    row = metrics.misclassified(df).first()
    assert (row["p_max"], row["p_truth"], row["difference"]) == pytest.approx((0.7, 0.3, -0.4))
    assert metrics.log_loss(df, F.lit(0.0)).first()["log_loss"] == pytest.approx(18.42, abs=0.01)


def test_cross_validation_finds_the_smaller_error(spark):
    rng = random.Random(9)
    rows = [(i, float(i % 50), 3.0 * (i % 50) + rng.gauss(0, 1)) for i in range(300)]
    df = features.assemble(spark.createDataFrame(rows, "id int, x double, y double"), ["x"])
    estimator = fits.linear_regression("y")
    grid = tuning.param_grid({estimator.regParam: [0.01, 100.0]})
    model = tuning.cross_validate(df, ["id"], estimator, grid, RegressionEvaluator(labelCol="y"), 3, 6)
    curve = {r["value"]: r["mean_score"] for r in tuning.validation_curve(model, estimator.regParam, df).collect()}
    assert curve[0.01] < curve[100.0] and json.loads(tuning.best_params_json(model))["regParam"] == 0.01
    assert [r["point"] for r in tuning.score_table(model, df).collect()] == [0, 1]
    assert len(tuning.combinations({"a": [1, 2], "b": [3]})) == 2


def test_recommender_clusters_and_categories(spark):
    rng = random.Random(10)
    rows = [(u, i, float(5 if (u + i) % 2 else 1)) for u in range(20) for i in range(10) if rng.random() < 0.8]
    ratings = spark.createDataFrame(rows, "u int, i int, r double")
    members = recommend.user_clusters(recommend.recommender("u", "i", "r", rank=3, iterations=3).fit(ratings), k=3)
    assert members.count() == 20
    assert recommend.largest_groups(members, "cluster").agg(F.sum("size")).first()[0] == 20
    items = spark.createDataFrame([(i, "odd" if i % 2 else "even") for i in range(10)], "i int, genre string")
    even_users = spark.createDataFrame([(u,) for u in range(0, 20, 2)], "u int")
    liked = recommend.liked_categories(ratings, even_users, items, "u", "i", "r", "genre")
    assert [(r["genre"], r["n"]) for r in liked.collect()] == [("odd", 5)]


def test_splits_are_fitted_beside_each_other_with_few_blocks(spark):
    rng = random.Random(11)
    rows = [(u, i, 1.0 + 4 * rng.random(), u * i % 97) for u in range(30) for i in range(20)]
    ratings = spark.createDataFrame(rows, "u int, i int, r double, t int")
    makers = {f"{n}": recommend.recommender("u", "i", "r", rank=2, iterations=n, blocks=2) for n in (1, 2)}
    assert all(m.getNumUserBlocks() == m.getNumItemBlocks() == 2 and m.getCheckpointInterval() == recommend.CHECKPOINT_INTERVAL for m in makers.values())
    found = recommend.score_by_time_split(ratings, F.col("t"), (0.4, 0.8), makers, "r").collect()
    assert [(r["model"], r["split"], r["metric"]) for r in found] == [(m, s, k) for s in ("40:60", "80:20") for m in ("1", "2") for k in ("rmse", "mse", "mae")]
    cut = 96 * 0.4
    scored = makers["2"].fit(ratings.where(F.col("t") < cut)).transform(ratings.where(F.col("t") >= cut))
    expected = scored.agg(F.avg(F.pow(F.col("r") - F.col("prediction"), 2)).alias("e")).first()["e"]
    assert {(r["model"], r["split"], r["metric"]): r["score"] for r in found}["2", "40:60", "mse"] == pytest.approx(expected, rel=1e-4)


def test_large_fits_get_more_blocks_and_wait_for_each_other(spark, monkeypatch):
    ratings = spark.range(600).select((F.col("id") % 30).cast("int").alias("u"), (F.col("id") % 19).cast("int").alias("i"), (F.col("id") % 5).cast("double").alias("r"), F.col("id").cast("int").alias("t"))
    makers = {str(n): recommend.recommender("u", "i", "r", rank=2, iterations=n, blocks=3) for n in (1, 2)}
    plain = recommend.score_by_time_split(ratings, F.col("t"), (0.4, 0.8), makers, "r").collect()
    fit, running, seen = recommend.ALS.fit, [], []

    def watched(self, rows):
        n = rows.count()
        running.append(n)
        seen.append((n, self.getNumUserBlocks(), self.getNumItemBlocks(), sum(running)))
        try:
            return fit(self, rows)
        finally:
            running.remove(n)

    monkeypatch.setattr(recommend.ALS, "fit", watched)
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", 100)
    monkeypatch.setattr(recommend, "RATINGS_BESIDE", 485)
    found = recommend.score_by_time_split(ratings, F.col("t"), (0.4, 0.8), makers, "r").collect()
    assert sorted(x[:3] for x in seen) == [(240, 3, 3), (240, 3, 3), (480, 5, 5), (480, 5, 5)]
    assert max(x[3] for x in seen) <= 485
    assert [r[:3] for r in found] == [r[:3] for r in plain] and found[0] == plain[0]  # the small split has its three blocks in both
    assert all(m.getIntermediateStorageLevel() == "DISK_ONLY" and m.getNumUserBlocks() == 3 for m in makers.values())


def test_a_job_larger_than_the_room_is_alone():
    room, order = recommend.Room(10), []

    def small():
        with room.of(1):
            order.append(room.used)

    with room.of(25):
        late = threading.Thread(target=small)
        late.start()
        late.join(0.2)
        assert order == [] and room.used == 25
    late.join(5)
    assert order == [1] and room.used == 0


def test_folds_from_moments_equal_the_general_search(spark):
    rng = random.Random(12)
    rows = [(i, rng.gauss(50, 3), float(rng.randrange(4)), 7.0) for i in range(400)]
    df = spark.createDataFrame([(i, a, b, c, 2 * a - b + rng.gauss(0, 1)) for i, a, b, c in rows], "id int, a double, b double, c double, y double")
    estimator, penalties = fits.linear_regression("y"), [0.001, 0.5, 20.0]
    grid = tuning.param_grid({estimator.regParam: penalties})
    slow = tuning.cross_validate(features.assemble(df, ["a", "b"]), ["id"], estimator, grid, RegressionEvaluator(labelCol="y"), 4, 6)
    quick = tuning.cross_validate_ridge(df, ["id"], ["a", "b"], estimator, penalties, 4, 6)
    assert quick.avgMetrics == pytest.approx(slow.avgMetrics, rel=1e-9) and quick.stdMetrics == pytest.approx(slow.stdMetrics, rel=1e-6)
    assert tuning.best_params_json(quick) == tuning.best_params_json(slow) and tuning.best_point(quick) == tuning.best_point(slow)
    assert tuning.score_table(quick, df).collect()[0]["params"] == tuning.score_table(slow, df).collect()[0]["params"]
    assert tuning.cross_validate_ridge(df, ["id"], ["a", "c"], estimator, penalties, 4, 6).avgMetrics[0] > 0
    with pytest.raises(ValueError, match="folds are empty"):
        tuning.cross_validate_ridge(df.limit(1), ["id"], ["a"], estimator, penalties, 4, 6)


def test_rows_of_many_rounds_lie_in_few_partitions(spark, tmp_path):
    values = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.sin(F.col("id") * i).cast("float"))
    vectors = spark.range(3000).select(F.col("id").alias("vec_id"), values.alias("embedding"), F.lit(0).alias("label"))
    vectors.write.parquet(f"{tmp_path}/embeddings.parquet")
    kept = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "50", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in kept}
    for k, v in kept.items():
        spark.conf.set(k, v)
    try:
        projected, shares = models.projected_classes(Tables(spark, str(tmp_path)))
        assert models.sign_classes(Tables(spark, str(tmp_path))).rdd.getNumPartitions() == 50
        assert projected.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        assert projected.count() == 3000 and len(shares) == max(models.PCA_SIZES)
        projected.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def logistic_rows(spark, n=360):
    rng = random.Random(14)
    rows = [(i, *(max(rng.gauss(m, 1), 0.0) for m in (2.0, 0.5, 30.0)), 4.0) for i in range(n)]
    df = spark.createDataFrame([(*r, float(r[1] - 2 * r[2] + rng.gauss(0, 1) > 0.5)) for r in rows], "id int, a double, b double, c double, d double, label double")
    return features.assemble(df, ["a", "b", "c", "d"]).select("id", "label", "features")


def test_logistic_fits_side_by_side_equal_the_general_search(spark, monkeypatch):
    df = logistic_rows(spark)
    estimator = fits.logistic_regression("label", family="multinomial", maxIter=200, tol=1e-11)
    grid = tuning.param_grid({estimator.regParam: (0.003, 0.3), estimator.elasticNetParam: (0.0, 0.5)})
    slow = tuning.cross_validate(df, ["id"], estimator, grid, metrics.MacroF1(labelCol="label"), 3, 6)
    readings, sums = [], tuning._margin_sums
    monkeypatch.setattr(tuning, "_margin_sums", lambda blocks, points: readings.append(len(points)) or sums(blocks, points))
    monkeypatch.setattr(tuning, "BLOCK", 50)
    quick = tuning.cross_validate_logistic(df, ["id"], estimator, grid, metrics.MacroF1(labelCol="label"), 3, 6)
    assert readings[0] == 12 and len(readings) < 20  # a round serves all 12 fits
    assert quick.avgMetrics == pytest.approx(slow.avgMetrics, abs=1e-12) and quick.stdMetrics == pytest.approx(slow.stdMetrics, abs=1e-12)
    assert tuning.best_params_json(quick) == tuning.best_params_json(slow) and tuning.best_point(quick) == tuning.best_point(slow)
    assert tuning.score_table(quick, df).collect()[3]["params"] == tuning.score_table(slow, df).collect()[3]["params"]


def test_coefficients_of_fits_side_by_side_equal_spark(spark, monkeypatch):
    df, found = logistic_rows(spark), []
    cells = tuning._confusions
    monkeypatch.setattr(tuning, "_confusions", lambda blocks, points: found.extend(points) or cells(blocks, points))
    for penalty, mix in ((0.003, 0.0), (0.1, 0.5)):
        estimator = fits.logistic_regression("label", penalty=penalty, l1=mix, family="multinomial", maxIter=300, tol=1e-12)
        found.clear()
        tuning.cross_validate_logistic(df, ["id"], estimator, [{}], metrics.MacroF1(labelCol="label"), 3, 6)
        for fold, beta in found:
            model = estimator.fit(splits.random_parts(df, ["id"], [1.0] * 3, 6, "k").where(F.col("k") != fold))
            matrix, first = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
            assert beta[1:] == pytest.approx(matrix[1] - matrix[0], abs=2e-5) and beta[0] == pytest.approx(first[1] - first[0], abs=2e-4)


def test_odd_labels_of_fits_side_by_side(spark):
    df, estimator, score = logistic_rows(spark, 60), fits.logistic_regression("label", family="multinomial", maxIter=20), metrics.MacroF1(labelCol="label")
    run = lambda rows: tuning.cross_validate_logistic(rows, ["id"], estimator, [{estimator.regParam: 0.1}], score, 3, 6)
    assert run(df.withColumn("label", F.lit(1.0))).avgMetrics == [1.0] == run(df.withColumn("label", F.lit(0.0))).avgMetrics
    with pytest.raises(Exception, match="labels must be 0 or 1, but got NULL"):
        run(df.withColumn("label", F.when(F.col("id") > 3, F.col("label"))))
    with pytest.raises(Exception, match="labels must be 0 or 1, but got 2"):
        run(df.withColumn("label", F.lit(2.0)))
    with pytest.raises(ValueError, match="folds are empty"):
        run(df.limit(1))
    with pytest.raises(ValueError, match="no rows"):
        run(df.where("false"))


def test_macro_f1_of_counts(spark):
    rng = random.Random(2)
    for size in (0, 1, 3, 40):
        rows = [(float(rng.randrange(2)), float(rng.randrange(2))) for _ in range(size)]
        counts = np.zeros((2, 2))
        for y, p in rows:
            counts[int(y), int(p)] += 1
        exact = metrics.MacroF1()._evaluate(spark.createDataFrame(rows, "label double, prediction double"))
        assert metrics.macro_f1(counts) == pytest.approx(exact)
