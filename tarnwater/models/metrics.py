"""Exact metrics as one-row or few-row tables."""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.functions.numeric import safe_log_probability
from tarnwater.operators.order import global_running_sum


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """rmse, mse and mae in one aggregate."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae")).select(F.sqrt("mse").alias("rmse"), "mse", "mae")


def rows_of(weight: str | None) -> Column:
    """Number of rows: of those present, or of those that they stand for."""
    return F.sum(weight).cast("bigint") if weight else F.count("*")


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """Share of rows whose prediction equals the label; ``weight`` counts a row more than once."""
    w = F.col(weight) if weight else F.lit(1.0)
    return df.agg((F.sum(F.when(F.col(label) == F.col(prediction), w).otherwise(0.0)) / F.sum(w)).alias("accuracy"))


def macro_scores(df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """Macro precision, recall and F1 over all classes that occur as label or prediction; an undefined share is 0."""
    cells = df.groupBy(F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(rows_of(weight).alias("_n"))
    hit = F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("_l").cast("string").alias("c"), hit.alias("tp"), F.col("_n").alias("actual"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("_p").cast("string").alias("c"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("actual"), F.col("_n").alias("predicted")),
    )
    classes = cells.select(F.inline(sides)).groupBy("c").agg(F.sum("tp").alias("tp"), F.sum("actual").alias("a"), F.sum("predicted").alias("p"))
    share = lambda top, bottom: F.when(bottom > 0, top / bottom).otherwise(0.0)
    tp, a, p = F.col("tp"), F.col("a"), F.col("p")
    return classes.agg(
        F.avg(share(tp, p)).alias("precision"), F.avg(share(tp, a)).alias("recall"), F.avg(share(2 * tp, a + p)).alias("f1")
    )


def macro_f1(cells: np.ndarray) -> float:
    """Macro F1 as in :func:`macro_scores` from the number of rows by label and prediction, a square matrix."""
    both = cells.sum(axis=0) + cells.sum(axis=1)
    present = both > 0
    return float((2 * np.diag(cells)[present] / both[present]).mean()) if present.any() else 0.0


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", weight: str | None = None) -> DataFrame:
    """Exact area under the ROC curve with ties counted half. Rows are first reduced to one per distinct score."""
    positive = F.col(label) == 1
    count = lambda side: F.sum(F.when(side, F.col(weight)).otherwise(0.0)).cast("bigint") if weight else F.count_if(side)
    counts = df.groupBy(F.col(score).alias("_s")).agg(count(positive).alias("pos"), count(~positive).alias("neg"))
    ranked = global_running_sum(counts, ["neg"], ["_s"])
    below = F.col("neg_running") - F.col("neg") + F.col("neg") / 2.0
    sums = ranked.agg(F.sum(F.col("pos") * below).alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return sums.select((F.col("_u") / (F.col("_p").cast("double") * F.col("_n"))).alias("auc"))


def log_loss(df: DataFrame, probability_of_truth: Column) -> DataFrame:
    """Mean cross-entropy from the probability given to the true class."""
    return df.agg((-F.avg(safe_log_probability(probability_of_truth))).alias("log_loss"))


def misclassified(df: DataFrame, label: str = "label", prediction: str = "prediction", probabilities: str = "probabilities") -> DataFrame:
    """Wrong rows with the probability of the winner, of the truth, and their difference (truth - winner)."""
    winner, truth = F.array_max(probabilities), F.get(F.col(probabilities), F.col(label).cast("int"))
    wrong = df.where(F.col(label) != F.col(prediction))
    return wrong.withColumns({"p_max": winner, "p_truth": truth, "difference": truth - winner})


class MacroF1(Evaluator, HasLabelCol, HasPredictionCol):
    """Macro F1 as an evaluator for tuning."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(macro_scores(dataset, self.getLabelCol(), self.getPredictionCol()).first()["f1"] or 0.0)
