"""Stages of tree ensembles, the searches over them, and the tables of results."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tarnwater.functions.random import keyed_uniform
from tarnwater.models import fits, metrics, staged
from tarnwater.operators import features
from tarnwater.plans import REGISTRY, models


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(500).select("id", *[keyed_uniform(i, "id").alias(n) for i, n in enumerate("abc")])
    df = df.withColumns({"label": (F.col("a") + 0.5 * F.col("b") > 0.8).cast("double"), "y": 3 * F.col("a") - F.col("b") * F.col("b")})
    return features.assemble(df, ["a", "b", "c"]).cache()


def test_all_trees_are_the_whole_fit(rows):
    boosted = fits.boosted_trees("label", depth=3, bins=8, rounds=4).fit(rows)
    forest = fits.forest_classifier("label", trees=5, depth=3, bins=8).fit(rows)
    for model, scored in ((boosted, staged.boosted_stages(boosted, rows, [1, 4])), (forest, staged.forest_stages(forest, rows, [2, 5], classes=True))):
        whole = model.transform(scored).withColumn("p", vector_to_array("probability")[1])
        last = max(int(c[5:]) for c in scored.columns if c.startswith("score"))
        assert whole.agg(F.max(F.abs(F.col("p") - F.col(f"score{last}")))).first()[0] < 1e-9
    one = fits.boosted_trees("label", depth=3, bins=8, rounds=1).fit(rows).transform(staged.boosted_stages(boosted, rows, [1]))
    assert one.agg(F.max(F.abs(vector_to_array("probability")[1] - F.col("score1")))).first()[0] < 1e-9
    numbers = fits.forest_regressor("y", trees=6, max_features=2, sample=0.7).fit(rows)
    scored = staged.forest_stages(numbers, rows, [3, 6], classes=False)
    assert numbers.transform(scored).agg(F.max(F.abs(F.col("prediction") - F.col("score6")))).first()[0] < 1e-9


def test_scores_of_stages(rows):
    scored = rows.select("label", "y", F.round("a", 2).alias("score1"), F.lit(0.25).alias("score2"))
    found = staged.class_scores(scored, [1, 2])
    exact = metrics.roc_auc(scored.withColumn("s", F.floor(F.col("score1") * staged.STEPS)), "label", "s").first()[0]
    assert found[1]["auc"] == pytest.approx(exact) and found[2]["auc"] == 0.5
    assert found[2]["accuracy"] == pytest.approx(scored.agg(F.avg(1 - F.col("label"))).first()[0])
    mean = scored.agg(F.avg("y")).first()[0]
    values = staged.value_scores(scored.withColumns({"score1": F.lit(mean), "score2": F.col("y")}), [1, 2], "y")
    assert values[1]["r2"] == pytest.approx(0) and values[2] == {"r2": 1.0, "rmse": 0.0}


def test_search_finds_the_better_setting(rows):
    fit = lambda part, p: fits.boosted_trees("label", depth=p["depth"], bins=16, rounds=3).fit(part)
    found = staged.search(rows, ["id"], [{"depth": 1}, {"depth": 4}], "rounds", [1, 3], fit, lambda m, part: staged.class_scores(staged.boosted_stages(m, part, [1, 3]), [1, 3]), 3, 6)
    assert [json.loads(r["params"]) for r in found.table(rows, "auc").orderBy("point").collect()] == [{"depth": d, "rounds": r} for d in (1, 4) for r in (1, 3)]
    assert found.best("auc") == {"depth": 4, "rounds": 3} and all(0.5 < s["auc"] <= 1 for s in found.scores)


def result(spark, path, name):
    return REGISTRY[name](spark, path).collect()


def test_tables_of_searches(spark, small_dir):
    forest = result(spark, small_dir, "forest_search_table")
    assert len(forest) == 27 and sum(r.is_best for r in forest) == 1
    best = next(r for r in forest if r.is_best)
    assert best.mean_auc == max(r.mean_auc for r in forest) and best.test_auc > 0.9 and best.test_accuracy > 0.8
    assert all(r.test_auc is None for r in forest if not r.is_best)
    penalties = sorted(result(spark, small_dir, "penalty_search_table"), key=lambda r: r.value)
    assert len(penalties) == 5 and [r.is_best for r in penalties].count(True) == 1
    chosen = next(r for r in penalties if r.is_best)
    assert json.loads(chosen.best_params)["regParam"] == chosen.value and chosen.mean_score == min(r.mean_score for r in penalties)


def test_tables_of_results(spark, small_dir):
    majority = {r.model: r for r in result(spark, small_dir, "classifier_scores")}
    assert set(majority) == {"perceptron 64-32-4", "boosted trees", "random forest", "given vectors"}
    assert all(0 <= x <= 1 for r in majority.values() for x in (r.accuracy, r.precision, r.recall, r.f1)) and majority["boosted trees"].f1 > 0.8
    sweep = sorted(result(spark, small_dir, "pca_sweep_accuracy"))
    assert sweep[-1].train_accuracy > sweep[0].train_accuracy and all(0 <= r.test_accuracy <= 1 for r in sweep)
    scores = {(r.model, r.split, r.metric): r.score for r in result(spark, small_dir, "experiment_scores")}
    assert len(scores) == 18 and all(v > 0 for v in scores.values())
    assert all(np.isclose(scores[m, s, "rmse"] ** 2, scores[m, s, "mse"]) for m, s, k in scores if k == "mse")
    clusters = result(spark, small_dir, "cluster_table")
    sizes = [r.n for r in clusters if r.kind == "cluster"]
    customers = spark.read.parquet(f"{small_dir}/orders.parquet").select("o_custkey").distinct().count()
    assert len(sizes) == 5 and 0 < sum(sizes) <= customers and max(sizes) >= customers / 25


def test_cells_stand_for_their_rows(spark):
    df = spark.range(4000).select("id", (F.col("id") % 3).cast("double").alias("few"), (F.col("id") * 7 % 1009).cast("double").alias("many"), (F.col("id") % 2).cast("double").alias("label"))
    table = staged.cells(staged.binned(df, df, ["few", "many"], 8), ["few", "many"], "label").cache()
    assert table.count() <= 3 * 8 * 2 and table.agg(F.sum("n")).first()[0] == 4000
    bins = table.groupBy(vector_to_array("features")[1]).agg(F.sum("n").alias("n")).collect()
    assert len(bins) == 8 and all(abs(r.n - 500) < 40 for r in bins)
    assert staged.binned(df, df, ["few"], 8) is df
    scored, whole = table.withColumn("score1", vector_to_array("features")[0] / 3), df.withColumn("score1", F.col("few") / 3)
    weighted, plain = staged.class_scores(scored, [1], weight="n")[1], staged.class_scores(whole, [1])[1]
    assert weighted == pytest.approx(plain)
    assert metrics.roc_auc(scored, score="score1", weight="n").first()[0] == pytest.approx(metrics.roc_auc(whole, score="score1").first()[0])


def test_cells_of_numbers_keep_all_of_the_error(spark):
    df = spark.range(3000).select("id", (F.col("id") % 5).cast("double").alias("x"), ((F.col("id") % 5) * 2 + keyed_uniform(1, "id")).alias("y"))
    table = staged.value_cells(df, ["x"], "y", ["id"], shares=4).cache()
    assert table.count() == 20 and table.agg(F.sum("n")).first()[0] == 3000
    weighted = staged.value_scores(table.withColumn("score1", vector_to_array("features")[0] * 2), [1], "y", "n", "inner")[1]
    assert weighted == pytest.approx(staged.value_scores(df.withColumn("score1", F.col("x") * 2), [1], "y")[1])


def test_first_levels_of_a_forest_are_the_forest_of_smaller_depth(rows):
    make = lambda depth, **more: fits.forest_classifier("label", trees=5, depth=depth, bins=8, **more).fit(rows)
    deep = make(6, cacheNodeIds=True)
    scored = staged.grown_stages(deep, rows, {f"score{d}": (d, 5) for d in (0, 1, 3, 4, 6, 9)}).cache()
    assert scored.columns == [*rows.columns, *[f"score{d}" for d in (0, 1, 3, 4, 6, 9)]]
    for depth in (0, 1, 3, 4, 6):
        own = make(depth).transform(scored).withColumn("p", vector_to_array("probability")[1])
        assert own.agg(F.max(F.abs(F.col("p") - F.col(f"score{depth}")))).first()[0] < 1e-9
    assert scored.where("score6 != score9").isEmpty() and not scored.where("score3 != score4").isEmpty()


def test_search_over_forests_fits_once_for_all_depths(spark, monkeypatch):
    monkeypatch.setattr(models, "FOREST_GRID", {"depth": (1, 3), "bins": (4, 6), "trees": (2, 3)})
    df = spark.range(900).select(F.col("id").alias("l_orderkey"), (F.col("id") % 7).cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"), *[F.floor(20 * keyed_uniform(i, "id")).cast("double").alias(n) for i, n in enumerate(models._HEAVY[1:])])
    lines = df.withColumns({"label": (F.col("l_quantity") + F.col("l_tax") + 4 * keyed_uniform(9, "l_orderkey") > 20).cast("double"), "part": (F.col("l_orderkey") % 5 == 0).cast("int")})
    fitted, make = [], fits.forest_classifier
    monkeypatch.setattr(fits, "forest_classifier", lambda label, **p: fitted.append(p["depth"]) or make(label, **p))
    found = models.class_search(lines, boosted=False)
    assert fitted == [3] * 6  # two numbers of bins, three folds
    folded = staged.fold_of(lines.where("part = 0").drop("part"), models._LINE_KEYS, models.TUNED_FOLDS, fits.SEED)
    tables = {b: staged.cells(staged.binned(folded, folded, models._HEAVY, b), models._HEAVY, "label", "_fold") for b in (4, 6)}
    fit = lambda part, p: make("label", trees=3, weightCol="n", **p).fit(part)
    score = lambda model, part: staged.class_scores(staged.forest_stages(model, part, (2, 3), classes=True), (2, 3), weight="n")
    each = staged.search_folds(lambda p: tables[p["bins"]], [{"depth": d, "bins": b} for d in (1, 3) for b in (4, 6)], "trees", (2, 3), fit, score, models.TUNED_FOLDS)
    assert found.points == each.points and len(each.points) == 8
    assert all(abs(a["auc"] - b["auc"]) < 0.05 and abs(a["accuracy"] - b["accuracy"]) < 0.05 for a, b in zip(found.scores, each.scores, strict=True))  # rows of cells may come in another order


def test_scores_of_no_rows_and_of_null_labels(spark):
    scored = spark.createDataFrame([(1.0, 0.9), (0.0, 0.2), (0.0, 0.7), (None, 0.8)], "label double, score1 double")
    assert staged.class_scores(scored, [1])[1] == pytest.approx({"accuracy": 0.5, "auc": 1.0})
    assert staged.class_scores(scored.where("false"), [1])[1] == {"accuracy": None, "auc": None}
