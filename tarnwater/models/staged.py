"""Searches over tree ensembles by staged evaluation.

The first m trees of a boosted fit are the fit with m rounds, and the first m trees of a forest are a forest of m trees. So one fit with
the largest number of trees serves every smaller one. A forest grows level by level, so its first levels are the forest of smaller depth,
and one fit with the largest depth serves those too: a grid of depths x bins x tree numbers needs depths x bins fits a fold for boosted
trees and bins fits a fold for forests. All stages of a fit are scored in one pass over the held-out fold. Folds follow from the key and
are cached once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import QuantileDiscretizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwater.operators.features import assemble
from tarnwater.operators.splits import random_parts
from tarnwater.session import materialize, new_path, spread

#: Scores are ranked in so many steps when stages are compared; ties inside a step count half.
STEPS = 1 << 16


def binned(df: DataFrame, train: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """``df`` with the number of the bin in place of the value, in columns of which ``train`` holds more than ``bins`` values; the bins hold
    equal shares of its rows. A tree tells no more values apart."""
    values = train.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if values[c] > bins]
    if not wide:
        return df
    bin_of = {c: f"_bin_{c}" for c in wide}
    coder = QuantileDiscretizer(numBuckets=bins, inputCols=wide, outputCols=list(bin_of.values()), relativeError=0.001, handleInvalid="error")
    return coder.fit(train).transform(df).drop(*wide).withColumnsRenamed({b: c for c, b in bin_of.items()})


def cells(df: DataFrame, columns: Sequence[str], label: str, *keep: str) -> DataFrame:
    """Rows with the same values as one row with their number ``n``, and their columns as ``features``, written once. A weighted fit weighs the
    same splits; what a tree draws is cells."""
    counted = df.groupBy(*columns, label, *keep).agg(F.count("*").cast("double").alias("n"))
    return assemble(spread(materialize(counted, "cells"), *columns, label, *keep), columns).select("features", label, "n", *keep)


def value_cells(df: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str], *keep: str, shares: int = 4) -> DataFrame:
    """The same for numbers: the rows of a cell are dealt over ``shares`` rows by the hash of their key; the label is the mean of its rows and
    ``inner`` the sum of their squared deviations, which no split changes."""
    dealt = df.withColumn("_share", F.pmod(F.xxhash64(*keys), F.lit(shares)))
    moments = dealt.groupBy(*columns, "_share", *keep).agg(F.count("*").cast("double").alias("n"), F.avg(label).alias("_mean"), (F.var_pop(label) * F.count("*")).alias("inner"))
    table = spread(materialize(moments.withColumnRenamed("_mean", label), "cells"), *columns, "_share", *keep)
    return assemble(table, columns).select("features", label, "n", "inner", *keep)


def leaf_values(model) -> list[list[float]]:
    """Predictions of the leaves of every tree of a regression ensemble, from left to right, which is how leaves are numbered."""
    trees: list[list[float]] = []
    for line in model.toDebugString.splitlines():
        words = line.split()
        if words[:1] == ["Tree"]:
            trees.append([])
        elif words[:1] == ["Predict:"]:
            trees[-1].append(float(words[1]))
    return trees


def leaf_shares(model, spark: SparkSession, depths: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of all trees of a forest of two classes, tree after tree and from left to right: the place of every tree's first leaf, and for
    every depth the share of class 1 in the node that is the leaf there when trees are grown to that depth only. As in a fit, a node whose children are
    leaves of one prediction is a leaf itself. The nodes are read from the saved fit; their number is bounded by trees and depth."""
    path = new_path(spark, "forest")
    model.write().session(spark).save(path)
    stats = F.col("nodeData.impurityStats")
    share = F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", *[f"nodeData.{c}" for c in ("id", "leftChild", "rightChild", "prediction")], share.alias("share")).toArrow()
    tree, number, left, right, prediction, share = (c.to_numpy() for c in nodes.columns)
    order = np.lexsort((number, tree))  # numbers are given parent first, then its left side
    number, left, right, prediction, share = (x[order] for x in (number, left, right, prediction, share))
    roots = np.flatnonzero(number == 0)
    own = np.repeat(roots, np.diff(np.append(roots, len(number))))
    is_leaf, left, right = left < 0, left + own, right + own
    levels = [roots]
    while len(inner := levels[-1][~is_leaf[levels[-1]]]):
        levels.append(np.concatenate([left[inner], right[inner]]))
    shares = []
    for depth in depths:
        ends = is_leaf.copy()
        for level in reversed(range(len(levels))):
            inner = levels[level][~is_leaf[levels[level]]]
            l, r = left[inner], right[inner]
            ends[inner] = True if level >= depth else ends[l] & ends[r] & (prediction[l] == prediction[r])
        stands = np.arange(len(ends))  # the leaf above a node, else itself
        for level in levels:
            inner = level[~is_leaf[level]]
            for child in (left[inner], right[inner]):
                stands[child] = np.where(ends[stands[inner]], stands[inner], child)
        shares.append(share[stands[is_leaf]])
    return np.searchsorted(np.flatnonzero(is_leaf), roots), np.array(shares)


def grown_stages(model, df: DataFrame, stages: Mapping[str, tuple[int, int]]) -> DataFrame:
    """``df`` with one column for every stage (depth, m) of a forest of two classes: the mean probability of class 1 by the first m trees grown to that
    depth. One pass gives every tree's leaf, and tasks look the leaves up with numpy."""
    depths = sorted({depth for depth, _ in stages.values()})
    first, shares = leaf_shares(model, df.sparkSession, depths)
    wanted = [(depths.index(depth), m) for depth, m in stages.values()]

    @F.arrow_udf("array<double>")
    def means(leaves: pa.Array) -> pa.Array:
        places = first + leaves.flatten().to_numpy(zero_copy_only=False).reshape(len(leaves), -1).astype(int)
        sums = [np.cumsum(row[places], axis=1) for row in shares]
        found = np.column_stack([sums[i][:, m - 1] / m for i, m in wanted])
        return pa.ListArray.from_arrays(np.arange(0, found.size + 1, len(wanted), dtype=np.int32), pa.array(found.ravel(), from_pandas=True))

    quiet = {model.leafCol: "_leaves", model.predictionCol: "", model.probabilityCol: "", model.rawPredictionCol: ""}
    scored = model.copy(quiet).transform(df).withColumn("_means", means(vector_to_array("_leaves")))
    return scored.withColumns({name: F.get("_means", F.lit(i)) for i, name in enumerate(stages)}).drop("_leaves", "_means")


def _tree_columns(model, df: DataFrame, most: int) -> DataFrame:
    """``df`` with one column per tree of a fit, ``_tree0``, ``_tree1``, ...: the tree's prediction."""
    for i, tree in enumerate(model.trees[:most]):
        df = tree.setPredictionCol(f"_tree{i}").transform(df)
    return df


def _sum(columns: Sequence[Column]) -> Column:
    return F.aggregate(F.array(*columns), F.lit(0.0), lambda a, x: a + x)


def boosted_stages(model, df: DataFrame, stages: Sequence[int]) -> DataFrame:
    """``df`` with ``score<m>`` for every stage m: the probability of class 1 by the first m trees of a boosted fit."""
    weights = model.treeWeights
    columns = _tree_columns(model, df, max(stages))
    margin = lambda m: _sum([F.col(f"_tree{i}") * F.lit(float(weights[i])) for i in range(min(m, len(weights)))])
    scored = columns.withColumns({f"score{m}": 1 / (1 + F.exp(-2 * margin(m))) for m in stages})
    return scored.drop(*[f"_tree{i}" for i in range(max(stages))])


def forest_stages(model, df: DataFrame, stages: Sequence[int], classes: bool) -> DataFrame:
    """``df`` with ``score<m>`` for every stage m: the mean of the first m trees, of the probability of class 1 or of the prediction. For
    numbers, one pass gives every tree's leaf, and the leaves' predictions are a constant of the plan."""
    if not classes:
        leaves = F.from_json(F.lit(json.dumps(leaf_values(model))), "array<array<double>>")
        placed = model.copy({model.leafCol: "_leaves"}).transform(df).withColumn("_own", F.zip_with(leaves, vector_to_array("_leaves"), lambda v, i: F.get(v, i.cast("int"))))
        mean = lambda m: F.aggregate(F.slice("_own", 1, m), F.lit(0.0), lambda a, x: a + x) / m
        return placed.withColumns({f"score{m}": mean(m) for m in stages}).drop("_own", "_leaves", model.getPredictionCol())
    return grown_stages(model, df, {f"score{m}": (model.getMaxDepth(), m) for m in stages})


def class_scores(scored: DataFrame, stages: Sequence[int], label: str = "label", weight: str | None = None) -> dict[int, dict[str, float]]:
    """Accuracy and area under the ROC curve of every stage, from one pass; ``weight`` counts a row more than once."""
    w = F.col(weight) if weight else F.lit(1.0)
    cells = scored.select(F.col(label).alias("y"), w.alias("w"), F.explode(F.array(*[F.struct(F.lit(m).alias("stage"), F.floor(F.col(f"score{m}") * STEPS).alias("step"), (F.col(f"score{m}") > 0.5).alias("high")) for m in stages])).alias("c"))
    side = lambda positive: F.sum(F.when(positive, F.col("w")).otherwise(0.0))
    hit = side(F.col("c.high") == (F.col("y") == 1)).alias("hit")
    counts = cells.groupBy("c.stage", "c.step").agg(side(F.col("y") == 1).alias("pos"), side(F.col("y") != 1).alias("neg"), hit, F.sum("w").alias("all"))  # at most STEPS rows a stage
    below = F.coalesce(F.sum("neg").over(Window.partitionBy("stage").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    area = counts.withColumn("u", F.col("pos") * (below + F.col("neg") / 2)).groupBy("stage")
    area = area.agg((F.sum("hit") / F.sum("all")).alias("accuracy"), F.try_divide(F.sum("u"), F.sum("pos") * F.sum("neg")).alias("auc"))
    found = {r["stage"]: {"accuracy": r["accuracy"], "auc": r["auc"]} for r in area.collect()}
    return {m: found.get(m, {"accuracy": None, "auc": None}) for m in stages}


def value_scores(scored: DataFrame, stages: Sequence[int], label: str, weight: str | None = None, inner: str | None = None) -> dict[int, dict[str, float]]:
    """Share of the variance explained and root mean squared error of every stage, from one pass; a row may stand for ``weight`` rows with its
    label as their mean and ``inner`` as their sum of squared deviations."""
    w, apart = F.col(weight) if weight else F.lit(1.0), F.col(inner) if inner else F.lit(0.0)
    centre = scored.agg(F.sum(w * F.col(label)) / F.sum(w)).first()[0]
    mean = lambda x: F.sum(w * F.pow(F.col(label) - x, 2) + apart) / F.sum(w)
    row = scored.agg(mean(F.lit(centre)).alias("v"), *[mean(F.col(f"score{m}")).alias(f"e{m}") for m in stages]).first()
    return {m: {"r2": 1 - row[f"e{m}"] / row["v"] if row["v"] else None, "rmse": row[f"e{m}"] ** 0.5} for m in stages}


@dataclass(frozen=True)
class Search:
    """Mean scores of all grid points, in the order of the grid."""

    points: tuple[dict, ...]
    scores: tuple[dict[str, float], ...]

    def best(self, metric: str) -> dict:
        """The point with the highest mean score, the first of equal ones."""
        return max(zip(self.points, self.scores, strict=True), key=lambda x: x[1][metric])[0]

    def ordered(self, points: Sequence[dict]) -> Search:
        """The same in the order of ``points``."""
        return Search(tuple(points), tuple(self.scores[self.points.index(p)] for p in points))

    def table(self, df: DataFrame, *metrics: str) -> DataFrame:
        """(point, params as JSON, one mean score per metric)."""
        rows = [(i, json.dumps(p, sort_keys=True), *[float(s[m]) for m in metrics]) for i, (p, s) in enumerate(zip(self.points, self.scores, strict=True))]
        return df.sparkSession.createDataFrame(rows, "point int, params string, " + ", ".join(f"mean_{m} double" for m in metrics))


def search(
    df: DataFrame, keys: Sequence[str], settings: Sequence[dict], stage: str, stages: Sequence[int], fit: Callable[[DataFrame, dict], object],
    score: Callable[[object, DataFrame], dict[int, dict[str, float]]], folds: int, seed: int, parallel: int = 8,
) -> Search:
    """k-fold search over ``settings`` x ``stages``: ``fit(rows, setting)`` makes one fit with the most trees, ``score(model, rows)`` gives every
    stage's scores. A row's fold is the hash of its key."""
    folded = fold_of(df, keys, folds, seed)
    return search_folds(lambda _: folded, settings, stage, stages, fit, score, folds, parallel)


def fold_of(df: DataFrame, keys: Sequence[str], folds: int, seed: int) -> DataFrame:
    """``df`` with its fold as ``_fold``, by the hash of the key."""
    return random_parts(df, keys, [1.0] * folds, seed, "_fold")


def search_folds(
    rows: Callable[[dict], DataFrame], settings: Sequence[dict], stage: str | tuple[str, ...], stages: Sequence[int] | Sequence[tuple[int, ...]],
    fit: Callable[[DataFrame, dict], object], score: Callable[[object, DataFrame], dict], folds: int, parallel: int = 8,
) -> Search:
    """The same over rows that have a ``_fold``; ``rows(setting)`` gives them. With several names as ``stage`` a stage has a value for each."""
    tables = {id(df): df for df in map(rows, settings)}
    for df in tables.values():
        df.cache()
    try:
        jobs = [(s, k) for s in range(len(settings)) for k in range(folds)]

        def one(job: tuple[int, int]) -> dict:
            s, k = job
            folded = rows(settings[s])
            return score(fit(folded.where(F.col("_fold") != k).drop("_fold"), settings[s]), folded.where(F.col("_fold") == k).drop("_fold"))

        with ThreadPoolExecutor(parallel) as pool:
            found = dict(zip(jobs, pool.map(one, jobs), strict=True))
    finally:
        for df in tables.values():
            df.unpersist()
    points, scores = [], []
    for s, setting in enumerate(settings):
        for m in stages:
            parts = [found[s, k][m] for k in range(folds)]
            points.append(setting | (dict(zip(stage, m, strict=True)) if isinstance(stage, tuple) else {stage: m}))
            scores.append({name: sum(p[name] or 0.0 for p in parts) / folds for name in parts[0]})
    return Search(tuple(points), tuple(scores))
