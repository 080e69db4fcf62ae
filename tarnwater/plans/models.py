"""Model, metric and tuning queries. Fits with one feature or one binary feature have closed forms in SQL."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwater.functions.random import keyed_uniform
from tarnwater.models import fits, metrics, recommend, staged, tuning, word_vectors
from tarnwater.operators import corpus, features, splits
from tarnwater.operators.combine import union_tagged
from tarnwater.plans import text
from tarnwater.plans.features import PCA_SIZES, WIDTH, vectors
from tarnwater.plans.registry import query, rounded, uniform_sql
from tarnwater.plans.statistics import MEASURES_SQL, measures
from tarnwater.session import Tables, gather, materialize, spread

LAMBDA = 0.1


def table_of(t: Tables, rows: list[tuple], schema: str) -> DataFrame:
    """A small result table."""
    return t.spark.createDataFrame(rows, schema)


def coefficients(t: Tables, estimator, df: DataFrame, names: list[str], digits: int = 5) -> DataFrame:
    """Fitted coefficients, rounded."""
    weights = ["weight"] if "weight" in df.columns else []
    training = df.select("features", estimator.getLabelCol(), *weights).cache()
    model = estimator.fit(training)
    training.unpersist()
    return fits.coefficient_table(model, names, df).withColumn("coefficient", rounded("coefficient", digits))


def one_feature(t: Tables) -> DataFrame:
    """Quantity as the only feature, price in thousands as label."""
    return features.assemble(spread(measures(t)), ["q"])


def _line_sql(slope: str) -> str:
    return f"""
    WITH {MEASURES_SQL}, s AS (SELECT avg(q) AS mq, avg(y) AS my, var_pop(q) AS v, covar_pop(q, y) AS c, stddev_samp(y) AS sy FROM m),
    f AS (SELECT {slope} AS w, mq, my FROM s)
    SELECT 'q' AS term, round(w, 5) AS coefficient FROM f UNION ALL SELECT 'intercept', round(my - w * mq, 5) FROM f"""


# ---- closed forms --------------------------------------------------------------------------------------------------


@query("""
    WITH g AS (SELECT avg(l_quantity) FILTER (l_returnflag <> 'R') AS m0, avg(l_quantity) FILTER (l_returnflag = 'R') AS m1 FROM lineitem)
    SELECT 'intercept' AS term, round(ln(m0), 5) AS coefficient FROM g UNION ALL SELECT 'returned', round(ln(m1 / m0), 5) + 0.0 FROM g""")
def poisson_regression(t: Tables) -> DataFrame:
    rows = t.lineitem.select((F.col("l_returnflag") == "R").cast("double").alias("returned"), "l_quantity")
    rows = fits.compact_rows(rows, ["returned", "l_quantity"])
    estimator = fits.poisson_regression("l_quantity", penalty=0.0, tol=1e-10, weightCol="weight")
    return coefficients(t, estimator, features.assemble(rows, ["returned"]), ["returned"])


@query(_line_sql("sign(c) * greatest(abs(c) - 0.1::DOUBLE, 0) / v"))
def linear_l1(t: Tables) -> DataFrame:
    return coefficients(t, fits.linear_regression("y", penalty=LAMBDA, l1=1.0, standardization=False, solver="auto", tol=1e-12), one_feature(t), ["q"])


@query(_line_sql("c / (v + 0.1::DOUBLE / sy)"))
def linear_l2(t: Tables) -> DataFrame:
    return coefficients(t, fits.linear_regression("y", penalty=LAMBDA, standardization=False), one_feature(t), ["q"])


@query(_line_sql("c / v"))
def linear_ols(t: Tables) -> DataFrame:
    return coefficients(t, fits.linear_regression("y", penalty=0.0), one_feature(t), ["q"])


@query(f"""
    WITH {MEASURES_SQL}, s AS (SELECT avg(q * q) AS v, avg(q * y) AS c FROM m)
    SELECT 'q' AS term, round(sign(c) * greatest(abs(c) - 0.1::DOUBLE, 0) / v, 5) AS coefficient FROM s UNION ALL SELECT 'intercept', 0.0""")
def lasso_fit(t: Tables) -> DataFrame:
    return coefficients(t, fits.lasso("y", alpha=LAMBDA, intercept=False, solver="auto", tol=1e-12), one_feature(t), ["q"])


@query("""
    WITH g AS (SELECT avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) FILTER (o_totalprice <= 150000) AS p0,
        avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) FILTER (o_totalprice > 150000) AS p1 FROM orders)
    SELECT 'intercept' AS term, round(ln(p0 / (1 - p0)), 5) AS coefficient FROM g
    UNION ALL SELECT 'large', round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 5) FROM g""")
def logistic_regression(t: Tables) -> DataFrame:
    rows = t.orders.select((F.col("o_orderstatus") == "F").cast("double").alias("label"), (F.col("o_totalprice") > 150000).cast("double").alias("large"))
    rows = fits.compact_rows(rows, ["label", "large"])
    estimator = fits.logistic_regression("label", penalty=0.0, tol=1e-12, maxIter=200, standardization=False, weightCol="weight")
    return coefficients(t, estimator, features.assemble(rows, ["large"]), ["large"])


# ---- metrics -------------------------------------------------------------------------------------------------------


@query(f"""
    WITH {MEASURES_SQL}, e AS (SELECT y - (1.5::DOUBLE * q + 0.5::DOUBLE) AS r FROM m)
    SELECT round(sqrt(avg(r * r)), 6) AS rmse, round(avg(r * r), 6) AS mse, round(avg(abs(r)), 6) AS mae FROM e""")
def regression_metrics(t: Tables) -> DataFrame:
    scored = measures(t).withColumn("prediction", 1.5 * F.col("q") + 0.5)
    return metrics.regression_metrics(scored, "y").select(*[rounded(c).alias(c) for c in ("rmse", "mse", "mae")])


@query("SELECT round(avg(CASE WHEN toxic = 1 - quality THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM labels")
def classification_accuracy(t: Tables) -> DataFrame:
    return metrics.accuracy(t.labels.withColumn("prediction", 1 - F.col("quality")), "toxic").withColumn("accuracy", rounded("accuracy"))


_RULE = "CASE WHEN l_quantity < 15 THEN 'A' WHEN l_quantity < 30 THEN 'N' ELSE 'R' END"


@query(f"""
    WITH s AS (SELECT l_returnflag AS y, {_RULE} AS p FROM lineitem),
    k AS (SELECT unnest(['A', 'N', 'R']) AS c),
    n AS (SELECT c, count(*) FILTER (y = c AND p = c) AS tp, count(*) FILTER (y = c) AS a, count(*) FILTER (p = c) AS q FROM s, k GROUP BY c)
    SELECT round(avg(tp / q), 6) AS precision, round(avg(tp / a), 6) AS recall, round(avg(2 * tp / (a + q)), 6) AS f1 FROM n""")
def macro_prf(t: Tables) -> DataFrame:
    scored = t.lineitem.select("l_returnflag", F.expr(_RULE).alias("prediction"))
    return metrics.macro_scores(scored, "l_returnflag").select(*[rounded(c).alias(c) for c in ("precision", "recall", "f1")])


@query("""
    WITH s AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_quantity - 100 * l_discount AS score FROM lineitem),
    r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS mid FROM s)
    SELECT round((sum(mid) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
        / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)), 6) AS auc FROM r""")
def roc_auc(t: Tables) -> DataFrame:
    scored = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_quantity") - 100 * F.col("l_discount")).alias("score"))
    return metrics.roc_auc(scored).withColumn("auc", rounded("auc"))


@query("""
    WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_quantity / 50.0 AS p FROM lineitem),
    d AS (SELECT *, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, greatest(p, 1 - p) AS p_max, CASE WHEN label = 1 THEN p ELSE 1 - p END AS p_truth FROM s)
    SELECT label, prediction, count(*) AS n, round(max(p_max), 6) AS p_max, round(min(p_truth), 6) AS p_truth, round(min(p_truth - p_max), 6) AS difference
    FROM d WHERE label <> prediction GROUP BY ALL""")
def error_analysis(t: Tables) -> DataFrame:
    p = F.col("l_quantity") / 50.0
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    scored = t.lineitem.select(label.alias("label"), F.when(p > 0.5, 1).otherwise(0).alias("prediction"), F.array(1 - p, p).alias("probabilities"))
    wrong = metrics.misclassified(scored)
    return wrong.groupBy("label", "prediction").agg(
        F.count("*").alias("n"), rounded(F.max("p_max")).alias("p_max"), rounded(F.min("p_truth")).alias("p_truth"), rounded(F.min("difference")).alias("difference")
    )


@query("""
    WITH s AS (SELECT doc_id, quality AS label, CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END AS prediction, least(n_chars / 4000.0::DOUBLE, 1.0) AS p FROM documents JOIN labels USING (doc_id))
    SELECT doc_id, label, prediction, round(greatest(p, 1 - p), 6) AS p_max, round(CASE WHEN label = 1 THEN p ELSE 1 - p END, 6) AS p_truth
    FROM s WHERE label <> prediction ORDER BY CASE WHEN label = 1 THEN p ELSE 1 - p END - greatest(p, 1 - p) DESC, doc_id LIMIT 10""")
def error_top_list(t: Tables) -> DataFrame:
    p = F.least(F.col("n_chars") / F.lit(4000.0), F.lit(1.0))
    docs = t.documents.select("doc_id", "n_chars").join(t.labels.select("doc_id", F.col("quality").alias("label")), "doc_id")
    scored = docs.select("doc_id", "label", F.when(F.col("n_chars") > 2000, 1).otherwise(0).alias("prediction"), F.array(1 - p, p).alias("probabilities"))
    top = metrics.misclassified(scored).orderBy(F.desc("difference"), "doc_id").limit(10)
    return top.select("doc_id", "label", "prediction", rounded("p_max").alias("p_max"), rounded("p_truth").alias("p_truth"))


# Fits without a closed form. Their targets are rules over the columns with keyed noise, so a sound fit does far better than the largest
# class or the mean, which the SQL twins compute; they state what must hold, and the exact numbers of rows.

_LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey")
_PART_SQL = uniform_sql(6, *_LINE_KEYS)
_NOISE_SQL = uniform_sql(11, *_LINE_KEYS)


def against_majority(t: Tables, scored: DataFrame, label: str, name: str, lead: float = 0.1, weight: str | None = None) -> DataFrame:
    """Rows, share of the largest class, and whether accuracy exceeds it by ``lead``, macro F1 being defined; one scan of the scored rows."""
    cells = scored.groupBy(F.col(label).alias("label"), F.col("prediction").alias("prediction")).agg(metrics.rows_of(weight).alias("n")).collect()
    n = sum(r["n"] for r in cells)
    largest = max((sum(r["n"] for r in cells if r["label"] == c) for c in {r["label"] for r in cells}), default=0)
    hits = sum(r["n"] for r in cells if r["label"] == r["prediction"])
    return table_of(t, [(name, n, round(largest / n, 6), hits / n >= largest / n + lead)], "model string, n_test bigint, majority double, beats_majority boolean")


def sign_classes(t: Tables) -> DataFrame:
    """Embeddings with one of four classes: the signs of the first two positions."""
    sign = lambda i: F.when(F.get("embedding", F.lit(i)) > 0, 1.0).otherwise(0.0)
    labels = t.embeddings.select("vec_id", (2 * sign(0) + sign(1)).alias("label"))
    return splits.random_parts(vectors(t).drop("label").join(labels, "vec_id"), ["vec_id"], [0.8, 0.2], 6)


_SIGNS_SQL = f"signs AS (SELECT CASE WHEN embedding[1] > 0 THEN 2 ELSE 0 END + CASE WHEN embedding[2] > 0 THEN 1 ELSE 0 END AS label, {uniform_sql(6, 'vec_id')} AS u FROM embeddings)"


def projected_classes(t: Tables) -> tuple[DataFrame, list[float]]:
    """The classes of the signs with their components, cached in few partitions, as many fits read them; and the shares of the components."""
    parts = sign_classes(t).cache()
    pca = features.fit_pca(parts.where("part = 0"), max(PCA_SIZES))
    projected = gather(pca.transform(parts)).cache()
    projected.count()
    parts.unpersist()
    return projected, [float(x) for x in pca.explainedVariance.toArray()]


@query(
    f"WITH {_SIGNS_SQL}, n AS (SELECT count(*) FILTER (u < 0.8) AS n_train, count(*) FILTER (u >= 0.8) AS n_test FROM signs) "
    + " UNION ALL ".join(f"SELECT {k} AS k, n_train, n_test, true AS variance_kept, true AS learned FROM n" for k in (*PCA_SIZES, WIDTH))
)
def pca_logistic_sweep(t: Tables) -> DataFrame:
    projected, shares = projected_classes(t)
    sizes = {r["part"]: r["n"] for r in projected.groupBy("part").agg(F.count("*").alias("n")).collect()}
    largest = projected.where("part = 0").groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] / sizes[0]
    rows, before = [], 0.0
    for k in (*PCA_SIZES, None):
        sized = projected.withColumn("features_k", F.col("features")) if k is None else features.component_prefix(projected, k)
        estimator = fits.logistic_regression("label", "features_k", penalty=0.0, family="multinomial", maxIter=50)
        scored = estimator.fit(sized.where("part = 0")).transform(sized)
        accuracy = scored.where("part = 0").agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
        kept = sum(shares[:k]) if k else 1.0
        rows.append((k or WIDTH, sizes[0], sizes[1], before < kept <= 1.0 + 1e-9, accuracy >= (largest + 0.2 if k is None else largest - 0.02)))
        before = kept
    projected.unpersist()
    return table_of(t, rows, "k int, n_train bigint, n_test bigint, variance_kept boolean, learned boolean")


def document_features(t: Tables, learned: bool, dims: int = 16, part: int | None = None) -> DataFrame:
    """Rectified mean word vectors of all documents, or of one part of them, from learned or from given word vectors; label: the document is English.
    The vocabulary is always that of all documents."""
    docs = spread(t.documents.select("doc_id", "text"), "doc_id")
    numbered = text.kept_text_vocabulary(docs)
    if learned:
        known = materialize(corpus.text_word_ids(docs, "doc_id", numbered), "known")
        vectors_ = word_vectors.learn(known, "ids", dims).withColumnRenamed("word", "word_id")
        chosen = in_part(known, part)
    else:
        vectors_ = t.embeddings.select(F.col("vec_id").alias("word_id"), F.col("embedding").alias("vector"))
        dims = WIDTH
        chosen = corpus.text_word_ids(in_part(docs, part), "doc_id", numbered)
    means = corpus.document_vectors(corpus.distinct_ids(chosen, "doc_id"), "doc_id", vectors_, numbered=numbered)
    filled = means.withColumn("vector", F.coalesce("vector", F.array_repeat(F.lit(0.0), dims)))
    rows = filled.select("doc_id", array_to_vector(fits.rectify("vector")).alias("features"))
    labels = in_part(t.documents.select("doc_id", (F.col("lang") == "en").cast("double").alias("label")), part)
    return materialize(text_parts(rows.join(labels, "doc_id")), "features")


def text_parts(docs: DataFrame) -> DataFrame:
    """Documents with their part: 0 for training, 1 held out."""
    return splits.random_parts(docs, ["doc_id"], [0.75, 0.25], 6)


def in_part(docs: DataFrame, part: int | None) -> DataFrame:
    """The documents of one part; all without one."""
    return docs if part is None else text_parts(docs).where(F.col("part") == part).drop("part")


TEXT_CHOICES, CHOICE_FOLDS = (0.003, 0.01, 0.03, 0.1), 3


def text_scores(t: Tables, learned: bool, name: str) -> DataFrame:
    """Train the output layer on document vectors, its penalty chosen by folds, and score the held-out part; the log loss is held against the
    entropy of the classes, which a model that learned nothing reaches."""
    rows = document_features(t, learned)
    estimator = fits.logistic_regression("label", family="multinomial", maxIter=50)
    grid = tuning.param_grid({estimator.regParam: TEXT_CHOICES})
    chosen = tuning.cross_validate(rows.where("part = 0").drop("part"), ["doc_id"], estimator, grid, MulticlassClassificationEvaluator(metricName="logLoss"), CHOICE_FOLDS, fits.SEED)
    scored = materialize(chosen.bestModel.transform(rows.where("part = 1")).select("label", "prediction", "probability"), "scored")
    loss = metrics.log_loss(scored, F.get(vector_to_array("probability"), F.col("label").cast("int")))
    share = F.avg("label")
    entropy = scored.agg((-(share * F.log(share) + (1 - share) * F.log(1 - share))).alias("e")).scalar()
    return against_majority(t, scored, "label", name).withColumns({"entropy": rounded(entropy), "loss_small": loss.scalar() < entropy})


def _text_sql(name: str) -> str:
    return f"""
    WITH d AS (SELECT CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0 END AS label, {uniform_sql(6, "doc_id")} AS u FROM documents)
    SELECT '{name}' AS model, count(*) AS n_test, round(greatest(avg(label), 1 - avg(label)), 6) AS majority, round(-(avg(label) * ln(avg(label)) + (1 - avg(label)) * ln(1 - avg(label))), 6) AS entropy,
        true AS beats_majority, true AS loss_small FROM d WHERE u >= 0.75"""


@query(f"""
    WITH {text.INDEX_SQL}, kept AS (SELECT doc_id, word_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM hits),
    pairs AS (
        SELECT least(x.word_id, y.word_id) AS a, greatest(x.word_id, y.word_id) AS b, count(*) AS n
        FROM kept x JOIN kept y ON x.doc_id = y.doc_id AND y.k - x.k BETWEEN 1 AND 5 GROUP BY ALL
    )
    SELECT a AS word_id, count(*) AS partners, CAST(sum(n) AS BIGINT) AS pairs, max(n) AS most FROM pairs GROUP BY a""")
def cooccurrence_counts(t: Tables) -> DataFrame:
    """Per word of the vocabulary: words within five places that aren't before it in the vocabulary, their pairs, and the most frequent pair."""
    counts = word_vectors.cooccurrences(text.indexed(t), "ids")
    found = counts.groupBy(F.col("a").cast("bigint").alias("word_id"))
    return found.agg(F.count("*").alias("partners"), F.sum("n").alias("pairs"), F.max("n").alias("most"))


@query(_text_sql("learned vectors"))
def text_classifier(t: Tables) -> DataFrame:
    return text_scores(t, True, "learned vectors")


@query(_text_sql("given vectors"))
def text_classifier_pretrained(t: Tables) -> DataFrame:
    return text_scores(t, False, "given vectors")


TEXT_PENALTIES, TEXT_MIXES, TEXT_FOLDS = (0.001, 0.01, 0.1), (0.0, 0.5), 3


@query(f"""
    WITH d AS (SELECT CASE WHEN lang = 'en' THEN 1.0::DOUBLE ELSE 0.0 END AS label, {uniform_sql(6, "doc_id")} AS u FROM documents)
    SELECT CAST({len(TEXT_PENALTIES) * len(TEXT_MIXES)} AS BIGINT) AS n_points, count(*) AS n_train, true AS best_is_good, true AS in_range FROM d WHERE u < 0.75""")
def text_grid_search(t: Tables) -> DataFrame:
    rows = document_features(t, False, part=0)
    estimator = fits.logistic_regression("label", family="multinomial", maxIter=20)
    grid = tuning.param_grid({estimator.regParam: TEXT_PENALTIES, estimator.elasticNetParam: TEXT_MIXES})
    model = tuning.cross_validate_logistic(rows.drop("part"), ["doc_id"], estimator, grid, metrics.MacroF1(labelCol="label"), TEXT_FOLDS, fits.SEED)
    checks = tuning.score_table(model, rows).agg(F.count("*").alias("n_points"), (F.max("mean_score") > 0.7).alias("best_is_good"), F.min(F.col("mean_score").between(0, 1)).alias("in_range"))
    return checks.withColumn("n_train", rows.agg(F.count("*").alias("n")).scalar())


@query(f"""
    WITH {_SIGNS_SQL}, c AS (SELECT label, count(*) AS n FROM signs WHERE u >= 0.8 GROUP BY label)
    SELECT 'perceptron 64-32-4' AS model, CAST(sum(n) AS BIGINT) AS n_test, round(max(n) / sum(n), 6) AS majority, true AS beats_majority FROM c""")
def mlp_classifier(t: Tables) -> DataFrame:
    parts = materialize(sign_classes(t), "parts")
    model = fits.perceptron("label", [WIDTH, 32, 4]).fit(parts.where("part = 0"))
    return against_majority(t, model.transform(parts.where("part = 1")), "label", "perceptron 64-32-4")


_HEAVY_SQL = f"CASE WHEN l_quantity - 200 * l_discount + 20 * ({_NOISE_SQL} - 0.5) > 15 THEN 1.0::DOUBLE ELSE 0.0 END"


_HEAVY = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def heavy_lines(t: Tables) -> DataFrame:
    """Line items with five columns as features; label 1 where quantity outweighs discount, with keyed noise; split 70/30."""
    noise = 20 * (keyed_uniform(11, *_LINE_KEYS) - 0.5)
    label = (F.col("l_quantity") - 200 * F.col("l_discount") + noise > 15).cast("double")
    rows = spread(t.lineitem.select(*_LINE_KEYS, *_HEAVY[1:]), *_LINE_KEYS).withColumn("label", label)
    return splits.random_parts(rows, _LINE_KEYS, [0.7, 0.3], 6)


def heavy_cells(rows: DataFrame, bins: int) -> DataFrame:
    """(features, label, n, part): line items that trees with so many bins can't tell apart are one row; bins follow from the training rows."""
    return staged.cells(staged.binned(rows, rows.where("part = 0"), _HEAVY, bins), _HEAVY, "label", "part")


def tree_scores(t: Tables, make, name: str, settings: dict) -> DataFrame:
    """Fit on 70%; accuracy against the larger class, exact AUC on the score and AUC on the hard label of the other 30%."""
    rows = heavy_cells(heavy_lines(t), settings["bins"])
    scored = make("label", weightCol="n", **settings).fit(rows.where("part = 0")).transform(rows.where("part = 1"))
    scored = materialize(scored.select("label", "prediction", "n", vector_to_array("probability")[1].alias("score")), "scored")
    on_score, on_label = metrics.roc_auc(scored, weight="n"), metrics.roc_auc(scored, score="prediction", weight="n")
    return against_majority(t, scored, "label", name, weight="n").withColumns({"auc_high": on_score.scalar() > 0.9, "auc_hard_high": on_label.scalar() > 0.8})


def _tree_sql(name: str) -> str:
    return f"""
    WITH r AS (SELECT {_HEAVY_SQL} AS y, {_PART_SQL} AS u FROM lineitem)
    SELECT '{name}' AS model, count(*) AS n_test, round(greatest(avg(y), 1 - avg(y)), 6) AS majority, true AS beats_majority, true AS auc_high, true AS auc_hard_high FROM r WHERE u >= 0.7"""


# The tuned parameters of the boosted trees and of the forest, and the grid that is searched.
BOOSTED = {"depth": 8, "bins": 20, "rounds": 15}
FOREST = {"trees": 30, "depth": 12, "bins": 30}


@query(_tree_sql("boosted trees"))
def gbt_classifier(t: Tables) -> DataFrame:
    return tree_scores(t, fits.boosted_trees, "boosted trees", BOOSTED)


@query(_tree_sql("random forest"))
def rf_classifier(t: Tables) -> DataFrame:
    return tree_scores(t, fits.forest_classifier, "random forest", FOREST)


_COST_SQL = f"(2 * l_quantity - 100 * l_discount + 50 * l_tax + 6 * ({_NOISE_SQL} - 0.5))"


_COSTED = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def cost_rows(t: Tables) -> DataFrame:
    """A cost that follows from quantity, discount and tax with keyed noise; split 85/15."""
    cost = 2 * F.col("l_quantity") - 100 * F.col("l_discount") + 50 * F.col("l_tax") + 6 * (keyed_uniform(11, *_LINE_KEYS) - 0.5)
    rows = t.lineitem.select(*_LINE_KEYS, "l_quantity", "l_discount", "l_tax", cost.alias("y"))
    return splits.random_parts(spread(rows, *_LINE_KEYS), _LINE_KEYS, [0.85, 0.15], 6)


def costed_lines(t: Tables) -> DataFrame:
    """The same with the columns as features."""
    return features.assemble(cost_rows(t), _COSTED).select(*_LINE_KEYS, "features", "y", "part")


@query(f"""
    WITH r AS (SELECT {_COST_SQL} AS y, {_PART_SQL} AS u FROM lineitem)
    SELECT count(*) FILTER (u < 0.85) AS n_train, count(*) FILTER (u >= 0.85) AS n_test, round(stddev_pop(y), 4) AS label_std, true AS train_good, true AS test_good FROM r""")
def rf_regressor(t: Tables) -> DataFrame:
    rows = costed_lines(t).cache()
    scored = fits.forest_regressor("y", trees=10, max_features=2, sample=0.5).fit(rows.where("part = 0")).transform(rows)
    error = (F.col("y") - F.col("prediction")) * (F.col("y") - F.col("prediction"))
    good = lambda part: F.sqrt(F.avg(F.when(F.col("part") == part, error))) < 0.5 * F.stddev_pop("y")
    result = scored.agg(
        F.count_if(F.col("part") == 0).alias("n_train"), F.count_if(F.col("part") == 1).alias("n_test"), rounded(F.stddev_pop("y"), 4).alias("label_std"),
        good(0).alias("train_good"), good(1).alias("test_good"),
    )
    rows.unpersist()
    return result


# The grid of the documented search, four values each, its folds, and the sampled share of the training rows, which is a parameter of it.
SEARCH_TREES, SEARCH_SHARES, SEARCH_FEATURES, SEARCH_FOLDS, SEARCH_SAMPLE = (10, 40, 70, 100), (0.1, 0.367, 0.633, 0.9), (1, 2, 3, 4), 5, 0.1


def cost_search(rows: DataFrame) -> staged.Search:
    """Search over forests on a sample of the training rows: 16 fits a fold for 64 points."""
    sample = splits.random_parts(rows.where("part = 0").drop("part"), _LINE_KEYS, [SEARCH_SAMPLE, 1 - SEARCH_SAMPLE], 42).where("part = 0").drop("part")
    table = staged.value_cells(staged.fold_of(sample, _LINE_KEYS, SEARCH_FOLDS, fits.SEED), _COSTED, "y", _LINE_KEYS, "_fold")
    settings = [{"features": f, "sample": s} for f in SEARCH_FEATURES for s in SEARCH_SHARES]
    fit = lambda part, p: fits.forest_regressor("y", trees=max(SEARCH_TREES), max_features=p["features"], sample=p["sample"], weightCol="n").fit(part)
    score = lambda model, part: staged.value_scores(staged.forest_stages(model, part, SEARCH_TREES, classes=False), SEARCH_TREES, "y", "n", "inner")
    return staged.search_folds(lambda _: table, settings, "trees", SEARCH_TREES, fit, score, SEARCH_FOLDS)


@query(f"""
    WITH r AS (SELECT {_COST_SQL} AS y, {_PART_SQL} AS u FROM lineitem)
    SELECT CAST({len(SEARCH_TREES) * len(SEARCH_SHARES) * len(SEARCH_FEATURES)} AS BIGINT) AS n_points, true AS best_explains, count(*) FILTER (u >= 0.85) AS n_test, true AS refit_good FROM r""")
def rf_grid_search(t: Tables) -> DataFrame:
    """The search, then a fit with the best point on all training rows."""
    rows = cost_rows(t)
    found = cost_search(rows)
    best = found.best("r2")
    table = staged.value_cells(rows, _COSTED, "y", _LINE_KEYS, "part")
    model = fits.forest_regressor("y", trees=best["trees"], max_features=best["features"], sample=best["sample"], weightCol="n").fit(table.where("part = 0"))
    test = table.where("part = 1")
    score = staged.value_scores(staged.forest_stages(model, test, [best["trees"]], classes=False), [best["trees"]], "y", "n", "inner")[best["trees"]]
    n_test = test.agg(metrics.rows_of("n")).first()[0]
    # an error below half of the deviation explains more than three quarters of the variance
    return table_of(t, [(len(found.points), bool(max(s["r2"] for s in found.scores) > 0.7), n_test, score["r2"] > 0.75)], "n_points bigint, best_explains boolean, n_test bigint, refit_good boolean")


# Recommender.

FRACTIONS, ITERATIONS = (0.4, 0.6, 0.8), (10, 20)
_RATING_SQL = f"1 + 4 * {uniform_sql(21, 'o_custkey')} * {uniform_sql(22, 'l_partkey')}"
_RATED_SQL = f"""
    rated AS (SELECT o_custkey AS customer, l_partkey AS part, {_RATING_SQL} AS rating, epoch(CAST(o_orderdate AS TIMESTAMP)) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    ends AS (SELECT min(s) AS lo, max(s) AS hi FROM rated)"""


def quantities(t: Tables) -> DataFrame:
    """Customer, part, quantity as rating, and the order time in seconds."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer"), F.unix_timestamp("o_orderdate").alias("time"))
    lines = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("part"), F.col("l_quantity").cast("double").alias("rating"))
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def ratings(t: Tables) -> DataFrame:
    """Who bought what and when, rated 1 to 5 by a taste of the customer times an appeal of the part."""
    return quantities(t).withColumn("rating", 1 + 4 * keyed_uniform(21, "customer") * keyed_uniform(22, "part"))


def numbered_ratings(t: Tables) -> DataFrame:
    """The same with dense ids in place of keys, written once."""
    return materialize(recommend.with_dense_ids(ratings(t), ["customer", "part"]), "ratings")


def _recommenders(iterations: tuple[int, ...], blocks: int = recommend.BLOCKS_BESIDE) -> dict:
    return {f"{n} iterations": recommend.recommender("customer_id", "part_id", "rating", iterations=n, blocks=blocks) for n in iterations}


@query(f"WITH {_RATED_SQL} " + " UNION ALL ".join(
    f"SELECT '{round(100 * f)}:{round(100 - 100 * f)}' AS split, count(*) FILTER (s >= lo + (hi - lo) * {f}::DOUBLE) AS n_test, true AS rmse_squared_is_mse, true AS rmse_below_deviation FROM rated, ends" for f in FRACTIONS
))
def als_recommender(t: Tables) -> DataFrame:
    rows = numbered_ratings(t)
    table = recommend.score_by_time_split(rows, F.col("time"), FRACTIONS, _recommenders(ITERATIONS[:1]), "rating")
    spread_ = rows.agg(F.stddev_pop("rating")).first()[0]
    at = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("score")))
    found = table.groupBy("split").agg((F.abs(at("rmse") * at("rmse") - at("mse")) < 1e-9).alias("rmse_squared_is_mse"), (at("rmse") < 0.8 * spread_).alias("rmse_below_deviation"))
    tests = {f"{round(100 * f)}:{round(100 - 100 * f)}": splits.time_range_split(rows, F.col("time"), f).where("not is_train").agg(F.count("*").alias("n_test")) for f in FRACTIONS}
    return found.join(union_tagged(tests, "split"), "split").select("split", "n_test", "rmse_squared_is_mse", "rmse_below_deviation")


@query(f"WITH {_RATED_SQL}, d AS (SELECT round(stddev_pop(rating), 6) AS label_std FROM rated) " + " UNION ALL ".join(
    f"SELECT '{n} iterations' AS model, '{round(100 * f)}:{round(100 - 100 * f)}' AS split, '{m}' AS metric, label_std, true AS good FROM d" for n in ITERATIONS for f in FRACTIONS for m in ("rmse", "mse", "mae")
))
def experiment_table(t: Tables) -> DataFrame:
    rows = numbered_ratings(t)
    table = recommend.score_by_time_split(rows, F.col("time"), FRACTIONS, _recommenders(ITERATIONS), "rating")
    deviation = rows.agg(F.stddev_pop("rating").alias("s")).scalar()
    limit = F.when(F.col("metric") == "mse", 0.64 * deviation * deviation).otherwise(0.8 * deviation)
    return table.select("model", "split", "metric", rounded(deviation).alias("label_std"), ((F.col("score") > 0) & (F.col("score") < limit)).alias("good"))


def clusters(t: Tables) -> DataFrame:
    """Cluster of every customer by the recommender's factors: (customer, cluster), written once."""
    rows = numbered_ratings(t)
    members = recommend.user_clusters(_recommenders(ITERATIONS[:1], recommend.BLOCKS)["10 iterations"].fit(rows))
    names = rows.select(F.col("customer_id").alias("id"), "customer").distinct()
    return materialize(members.join(names, "id").select("customer", "cluster"), "clusters")


@query(f"""
    WITH {_RATED_SQL}, n AS (SELECT count(DISTINCT customer) AS n_customers FROM rated)
    SELECT n_customers, {recommend.TOP_CLUSTERS} AS n_shown, true AS largest_first, true AS within FROM n""")
def user_clusters(t: Tables) -> DataFrame:
    members = clusters(t)
    top = [r["size"] for r in recommend.largest_groups(members, "cluster").collect()]
    facts = members.agg(F.countDistinct("customer").alias("n_customers"), F.countDistinct("cluster").alias("k"))
    return facts.select("n_customers", F.lit(len(top)).alias("n_shown"), F.lit(top == sorted(top, reverse=True)).alias("largest_first"), (F.col("k") <= recommend.CLUSTERS).alias("within"))


@query("""
    WITH types AS (SELECT count(DISTINCT p_type) AS n_types FROM part)
    SELECT n_types, true AS at_most_ten, true AS counts_fit, true AS sorted FROM types""")
def cluster_top_categories(t: Tables) -> DataFrame:
    members = recommend.members_of_largest(clusters(t), "cluster").select("customer")
    items = t.part.select(F.col("p_partkey").alias("part"), "p_type")
    rows = recommend.liked_categories(ratings(t), members, items, "customer", "part", "rating", "p_type", liked=1.5).collect()
    sizes = {r["p_type"]: r["n"] for r in t.part.groupBy("p_type").agg(F.count("*").alias("n")).collect()}
    counts = [r["n"] for r in rows]
    checks = (len(sizes), 0 < len(rows) <= recommend.TOP_CATEGORIES, all(0 < r["n"] <= sizes[r["p_type"]] for r in rows), counts == sorted(counts, reverse=True))
    return table_of(t, [checks], "n_types bigint, at_most_ten boolean, counts_fit boolean, sorted boolean")


@query("SELECT count(*) AS n_rows, 10 AS n_clusters, true AS all_assigned FROM embeddings")
def kmeans_sizes(t: Tables) -> DataFrame:
    from pyspark.ml.clustering import KMeans

    rows = vectors(t).cache()
    clustered = KMeans(k=10, seed=fits.SEED).fit(rows).transform(rows)
    sizes = recommend.largest_groups(clustered, "prediction", 10)
    rows.unpersist()
    return sizes.agg(F.sum("size").alias("n_rows"), F.count("*").cast("int").alias("n_clusters"), (F.min("size") > 0).alias("all_assigned"))


@query("""
    WITH seg AS (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*) DESC, c_mktsegment LIMIT 1),
    mine AS (SELECT l_partkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = (SELECT c_mktsegment FROM seg)),
    loved AS (SELECT l_partkey FROM mine GROUP BY 1 HAVING avg(l_quantity) >= 30)
    SELECT p_type, count(*) AS n FROM loved JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY n DESC, p_type LIMIT 10""")
def segment_top_categories(t: Tables) -> DataFrame:
    members = recommend.members_of_largest(t.customer, "c_mktsegment").select(F.col("c_custkey").alias("customer"))
    items = t.part.select(F.col("p_partkey").alias("part"), "p_type")
    return recommend.liked_categories(quantities(t), members, items, "customer", "part", "rating", "p_type", liked=30.0)


# Tuning.

# Penalties and folds of the search over linear fits.
SEARCH_PENALTIES, PENALTY_FOLDS = (0.001, 0.01, 0.1, 1.0, 10.0), 10


def search(t: Tables):
    """Search over the penalties of a linear fit."""
    rows = cost_rows(t).drop("part")
    estimator = fits.linear_regression("y")
    return estimator, tuning.cross_validate_ridge(rows, _LINE_KEYS, _COSTED, estimator, SEARCH_PENALTIES, PENALTY_FOLDS, fits.SEED), rows


@query(f"SELECT {len(SEARCH_PENALTIES)} AS n_points, true AS scores_positive, true AS deviations_small, true AS best_is_smallest, count(*) AS n_rows FROM lineitem")
def cross_validate(t: Tables) -> DataFrame:
    _, model, rows = search(t)
    table = tuning.score_table(model, rows)
    best = float(json.loads(tuning.best_params_json(model))["regParam"])
    expected = float(json.loads(table.orderBy("mean_score").first()["params"])["regParam"])
    checks = table.agg(
        F.count("*").cast("int").alias("n_points"), (F.min("mean_score") > 0).alias("scores_positive"),
        (F.max(F.col("std_score") / F.col("mean_score")) < 0.2).alias("deviations_small"), F.lit(best == expected).alias("best_is_smallest"),
    )
    return checks.withColumn("n_rows", rows.agg(F.count("*").alias("n")).scalar())


@query(f"""
    WITH s AS (SELECT round(stddev_pop({_COST_SQL}), 4) AS label_std FROM lineitem)
    SELECT v AS value, label_std, true AS below_half_deviation, true AS not_below_smaller_penalty FROM s, (SELECT unnest([{", ".join(f"{v}::DOUBLE" for v in SEARCH_PENALTIES)}]) AS v)""")
def validation_curve(t: Tables) -> DataFrame:
    estimator, model, rows = search(t)
    curve = tuning.validation_curve(model, estimator.regParam, rows)
    deviation = rows.agg(F.stddev_pop("y").alias("s")).scalar()
    before = F.coalesce(F.lag("mean_score").over(Window.orderBy("value")), F.lit(0.0))
    return curve.select("value", rounded(deviation, 4).alias("label_std"), (F.col("mean_score") < deviation / 2).alias("below_half_deviation"), (F.col("mean_score") > before - 0.01).alias("not_below_smaller_penalty"))


@query("SELECT count(*) AS n_rows, true AS equals_grid_best, true AS small_penalty FROM lineitem")
def best_params_json(t: Tables) -> DataFrame:
    _, model, rows = search(t)
    found = float(json.loads(tuning.best_params_json(model))["regParam"])
    best = float(json.loads(tuning.score_table(model, rows).orderBy("mean_score").first()["params"])["regParam"])
    return rows.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(found == best).alias("equals_grid_best"), F.lit(found <= 0.1).alias("small_penalty"))


# The grids of the documented searches over forests and boosted trees, three values each, and their folds.
FOREST_GRID = {"depth": (4, 8, 12), "bins": (10, 20, 30), "trees": (15, 25, 30)}
BOOSTED_GRID = {"depth": (4, 8, 12), "bins": (7, 15, 20), "rounds": (5, 10, 15)}
TUNED_FOLDS = 3


def class_search(rows: DataFrame, boosted: bool) -> staged.Search:
    """Search over the training rows, 27 points: 9 fits a fold of boosted trees, 3 fits a fold of forests."""
    grid = BOOSTED_GRID if boosted else FOREST_GRID
    folded = staged.fold_of(rows.where("part = 0").drop("part"), _LINE_KEYS, TUNED_FOLDS, fits.SEED)
    tables = {b: staged.cells(staged.binned(folded, folded, _HEAVY, b), _HEAVY, "label", "_fold") for b in grid["bins"]}
    if boosted:
        settings, rounds = [{"depth": d, "bins": b} for d in grid["depth"] for b in grid["bins"]], grid["rounds"]
        fit = lambda part, p: fits.boosted_trees("label", weightCol="n", **p, rounds=max(rounds)).fit(part)
        score = lambda model, part: staged.class_scores(staged.boosted_stages(model, part, rounds), rounds, weight="n")
        return staged.search_folds(lambda p: tables[p["bins"]], settings, "rounds", rounds, fit, score, TUNED_FOLDS)
    stages = [(d, m) for d in grid["depth"] for m in grid["trees"]]
    fit = lambda part, p: tuned_forest(depth=max(grid["depth"]), trees=max(grid["trees"]), **p).fit(part)

    def score(model, part: DataFrame) -> dict:
        scored = staged.grown_stages(model, part, {f"score{i}": stage for i, stage in enumerate(stages)})
        found = staged.class_scores(scored, range(len(stages)), weight="n")
        return {stage: found[i] for i, stage in enumerate(stages)}

    found = staged.search_folds(lambda p: tables[p["bins"]], [{"bins": b} for b in grid["bins"]], ("depth", "trees"), stages, fit, score, TUNED_FOLDS)
    return found.ordered([{"depth": d, "bins": b, "trees": m} for d in grid["depth"] for b in grid["bins"] for m in grid["trees"]])


def tuned_forest(**point):
    """A forest of the search. Its trees are deep, so tasks remember the node of every row instead of going down from the roots in every level; the
    splits are the same."""
    return fits.forest_classifier("label", weightCol="n", cacheNodeIds=True, checkpointInterval=-1, **point)


def _tuned_sql(name: str, grid: dict) -> str:
    points = len(grid["depth"]) * len(grid["bins"]) * len(grid.get("trees", grid.get("rounds")))
    return f"""
    WITH r AS (SELECT {_HEAVY_SQL} AS y, {_PART_SQL} AS u FROM lineitem)
    SELECT '{name}' AS model, CAST({points} AS BIGINT) AS n_points, count(*) AS n_test, round(greatest(avg(y), 1 - avg(y)), 6) AS majority,
        true AS beats_majority, true AS best_score_high FROM r WHERE u >= 0.7"""


def tuned(t: Tables, boosted: bool, name: str) -> DataFrame:
    """The search, then a fit with the best point on all training rows, scored on the others."""
    rows = heavy_lines(t)
    found = class_search(rows, boosted)
    best = found.best("auc")
    table = heavy_cells(rows, best["bins"])
    estimator = fits.boosted_trees("label", weightCol="n", **best) if boosted else tuned_forest(**best)
    scored = estimator.fit(table.where("part = 0")).transform(table.where("part = 1"))
    result = against_majority(t, scored, "label", name, weight="n")
    return result.withColumns({"n_points": F.lit(len(found.points)).cast("bigint"), "best_score_high": F.lit(bool(max(s["auc"] for s in found.scores) > 0.9))})


@query(_tuned_sql("best forest", FOREST_GRID))
def classifier_tuning(t: Tables) -> DataFrame:
    return tuned(t, False, "best forest")


@query(_tuned_sql("best boosted trees", BOOSTED_GRID))
def boosted_tuning(t: Tables) -> DataFrame:
    return tuned(t, True, "best boosted trees")


# Results as such. The fits' random draws have no SQL, so these queries have no twin; tests hold them against bounds that a bad fit breaks.


@query()
def forest_search_table(t: Tables) -> DataFrame:
    """Every point of the search over forests with its mean scores, and the refit's scores on the held-out rows beside the best point."""
    rows = heavy_lines(t)
    found = class_search(rows, False)
    best = found.best("auc")
    table = heavy_cells(rows, best["bins"])
    model = tuned_forest(**best).fit(table.where("part = 0"))
    test = staged.class_scores(staged.forest_stages(model, table.where("part = 1"), [best["trees"]], classes=True), [best["trees"]], weight="n")[best["trees"]]
    is_best = F.col("params") == json.dumps(best, sort_keys=True)
    table = found.table(t.lineitem, "accuracy", "auc").withColumn("is_best", is_best)
    return table.withColumns({f"test_{m}": F.when(F.col("is_best"), F.lit(test[m])) for m in ("accuracy", "auc")})


@query()
def cost_search_table(t: Tables) -> DataFrame:
    """Every point of the search over cost forests with its mean scores."""
    found = cost_search(cost_rows(t))
    return found.table(t.lineitem, "r2", "rmse").withColumn("is_best", F.col("params") == json.dumps(found.best("r2"), sort_keys=True))


@query()
def penalty_search_table(t: Tables) -> DataFrame:
    """The curve over the penalties: value, mean score and deviation over the folds, and all parameters of the best model as JSON beside its row."""
    estimator, model, rows = search(t)
    curve = tuning.score_table(model, rows).drop("params").withColumn("value", F.element_at(F.array(*[F.lit(v) for v in SEARCH_PENALTIES]), F.col("point") + 1))
    best = F.col("value") == float(tuning.best_point(model)[estimator.regParam])
    return curve.select("value", "mean_score", "std_score", best.alias("is_best"), F.when(best, F.lit(tuning.best_params_json(model))).alias("best_params"))


def scores_of(scored: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    """Rows, accuracy, and macro precision, recall and F1 of scored rows."""
    counts = scored.agg(metrics.rows_of(weight).alias("n_test"))
    return counts.crossJoin(metrics.accuracy(scored, weight=weight)).crossJoin(metrics.macro_scores(scored, "label", weight=weight)).select(F.lit(name).alias("model"), "n_test", "accuracy", "precision", "recall", "f1")


@query()
def classifier_scores(t: Tables) -> DataFrame:
    """Scores of the network, of both tree ensembles and of the text classifier on their held-out rows."""
    parts = materialize(sign_classes(t), "parts")
    network = fits.perceptron("label", [WIDTH, 32, 4]).fit(parts.where("part = 0")).transform(parts.where("part = 1"))
    lines, trees = heavy_lines(t), {}
    for name, make, settings in (("boosted trees", fits.boosted_trees, BOOSTED), ("random forest", fits.forest_classifier, FOREST)):
        cells = heavy_cells(lines, settings["bins"])
        trees[name] = make("label", weightCol="n", **settings).fit(cells.where("part = 0")).transform(cells.where("part = 1"))
    docs = document_features(t, False)
    text_model = fits.logistic_regression("label", penalty=0.03, family="multinomial", maxIter=50).fit(docs.where("part = 0")).transform(docs.where("part = 1"))
    scored = {"perceptron 64-32-4": network, **trees, "given vectors": text_model}
    one = lambda rows: rows.select("label", "prediction", "n" if "n" in rows.columns else F.lit(1.0).alias("n"))
    tables = [scores_of(materialize(one(rows), "scored"), name, "n") for name, rows in scored.items()]
    return reduce(DataFrame.unionByName, tables)


@query()
def pca_sweep_accuracy(t: Tables) -> DataFrame:
    """Training and test accuracy of logistic regression on the first k components."""
    projected, _ = projected_classes(t)
    rows = []
    for k in PCA_SIZES:
        sized = features.component_prefix(projected, k)
        model = fits.logistic_regression("label", "features_k", penalty=0.0, family="multinomial", maxIter=50).fit(sized.where("part = 0"))
        right = model.transform(sized).groupBy("part").agg(F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("a")).collect()
        share = {r["part"]: r["a"] for r in right}
        rows.append((k, share.get(0), share.get(1)))
    projected.unpersist()
    return table_of(t, rows, "k int, train_accuracy double, test_accuracy double")


@query()
def experiment_scores(t: Tables) -> DataFrame:
    """The results table: model x split x metric with its score."""
    rows = numbered_ratings(t)
    return recommend.score_by_time_split(rows, F.col("time"), FRACTIONS, _recommenders(ITERATIONS), "rating").select("model", "split", "metric", "score")


#: Fixed value: the mean rating from which an item counts as liked.
LIKED = 4.0


@query()
def cluster_table(t: Tables) -> DataFrame:
    """The largest clusters of customers with their sizes, and the categories that the largest one likes."""
    found = clusters(t)
    sizes = recommend.largest_groups(found, "cluster")
    members = recommend.members_of_largest(found, "cluster").select("customer")
    items = t.part.select(F.col("p_partkey").alias("part"), "p_type")
    liked = recommend.liked_categories(ratings(t), members, items, "customer", "part", "rating", "p_type", liked=LIKED)
    top = sizes.select(F.lit("cluster").alias("kind"), F.col("cluster").cast("string").alias("name"), F.col("size").alias("n"))
    return top.unionByName(liked.select(F.lit("category").alias("kind"), F.col("p_type").alias("name"), "n"))
