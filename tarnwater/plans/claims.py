"""Insurance claims end to end: encode, split, fit with penalties, score. Line items stand in for policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions.random import keyed_uniform
from tarnwater.models import metrics, penalised
from tarnwater.operators import splits
from tarnwater.plans.registry import query, rounded, uniform_sql
from tarnwater.session import Tables, spread

KEYS = ("l_orderkey", "l_linenumber", "l_partkey")
FEATURES = ("returned", "filled", "quantity", "discount", "tax")
#: Penalty and training share of the documented regressions.
PENALTY, TRAINED = 0.01, 0.7
LASSO_PENALTY = 0.02


def claims(t: Tables) -> DataFrame:
    """Policies with encoded and scaled features, the number of claims, whether there are two or more, and the part (0: training)."""
    rate = 1 + 2 * F.col("returned") + F.col("quantity")
    rows = t.lineitem.select(
        *KEYS, (F.col("l_returnflag") == "R").cast("double").alias("returned"), (F.col("l_linestatus") == "F").cast("double").alias("filled"),
        (F.col("l_quantity") / 10).alias("quantity"), (F.col("l_discount") * 10).alias("discount"), (F.col("l_tax") * 10).alias("tax"),
    )
    counted = spread(rows, *KEYS).withColumn("claims", F.floor(keyed_uniform(31, *KEYS) * rate).cast("double"))
    return splits.random_parts(counted.withColumn("several", (F.col("claims") >= 2).cast("double")), KEYS, [TRAINED, 1 - TRAINED], 6)


_CLAIMS_SQL = f"""
    f AS (
        SELECT 1.0::DOUBLE AS x0, CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0 END AS x1, CASE WHEN l_linestatus = 'F' THEN 1.0::DOUBLE ELSE 0.0 END AS x2,
            l_quantity / 10 AS x3, l_discount * 10 AS x4, l_tax * 10 AS x5, {uniform_sql(31, *KEYS)} AS u, {uniform_sql(6, *KEYS)} AS v FROM lineitem
    ), c AS MATERIALIZED (
        SELECT x0, x1, x2, x3, x4, x5, floor(u * (1 + 2 * x1 + x3)) AS claims, CASE WHEN floor(u * (1 + 2 * x1 + x3)) >= 2 THEN 1.0::DOUBLE ELSE 0.0 END AS several, v FROM f
    ), r AS MATERIALIZED (SELECT * FROM c WHERE v < {TRAINED})"""

_D = range(len(FEATURES) + 1)
_MEAN_SQL = {"logistic": "1 / (1 + exp(-eta))", "poisson": "exp(eta)"}
_SLOPE_SQL = {"logistic": "mu * (1 - mu)", "poisson": "mu"}


def _newton_sql(name: str, family: str, label: str, absolute: float, square: float, rounds: int, sweeps: int = 30) -> str:
    """Common tables whose last, ``<name>_fit``, is the row b0, b1, ... of the penalised fit: each round sums gradient and Hessian over all
    training rows, and coordinate descent solves the penalised quadratic problem. The first coefficient is the intercept."""
    names = ", ".join(f"b{i}" for i in _D)
    start = f"ln(avg({label}))" if family == "poisson" else "0.0::DOUBLE"
    sql = [f"{name}_0 AS (SELECT {start} AS b0, {', '.join(f'0.0::DOUBLE AS b{i}' for i in _D if i)} FROM r)"]
    for k in range(rounds):
        at = f"{name}_{k}"
        eta = " + ".join(f"b{i} * x{i}" for i in _D)
        sums = [f"sum((mu - y) * x{i}) AS g{i}" for i in _D] + [f"sum({_SLOPE_SQL[family]} * x{i} * x{j}) AS h{i}_{j}" for i in _D for j in _D if i <= j]
        sql.append(f"""{at}_s AS MATERIALIZED (
            SELECT count(*) AS n, {', '.join(sums)}, {', '.join(f'any_value(b{i}) AS a{i}' for i in _D)}
            FROM (SELECT *, {_MEAN_SQL[family]} AS mu FROM (SELECT r.*, {label} AS y, b.*, {eta} AS eta FROM r, {at} b)))""")
        h = lambda i, j: f"h{min(i, j)}_{max(i, j)}"
        sweep = f"SELECT * FROM {at}_w, {at}_s WHERE it < {sweeps}"
        for j in _D:
            pull = f"h{j}_{j} * b{j} - g{j} - ({' + '.join(f'{h(j, i)} * ({"n" if i < j else "b"}{i} - a{i})' for i in _D)})"
            solved = f"sign(p{j}) * greatest(abs(p{j}) - n * {absolute}::DOUBLE, 0) / (h{j}_{j} + n * {square}::DOUBLE)" if j else "p0 / h0_0"
            sweep = f"SELECT *, {solved} AS n{j} FROM (SELECT *, {pull} AS p{j} FROM ({sweep}))"
        sql.append(f"""{at}_w AS (
            SELECT 0 AS it, {', '.join(f'a{i} AS b{i}' for i in _D)} FROM {at}_s
            UNION ALL SELECT it + 1, {', '.join(f'n{i}' for i in _D)} FROM ({sweep}))""")
        sql.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT {names} FROM {at}_w WHERE it = {sweeps})")
    sql.append(f"{name}_fit AS (SELECT {names} FROM {name}_{rounds})")
    return ",\n    ".join(sql)


#: Rounds of the twins: the change is below a thousandth of the last digit shown long before.
_POISSON_SQL = _newton_sql("poisson", "poisson", "claims", 0.0, PENALTY, 7)
_RIDGE_SQL = _newton_sql("ridge", "logistic", "several", 0.0, PENALTY, 7)
_LASSO_SQL = _newton_sql("lasso", "logistic", "several", LASSO_PENALTY, 0.0, 9)


def _coefficients_sql(tables: str, name: str) -> str:
    rows = " UNION ALL ".join(f"SELECT '{'intercept' if not i else FEATURES[i - 1]}' AS term, round(b{i}, 5) + 0.0 AS coefficient FROM {name}_fit" for i in _D)
    return f"WITH RECURSIVE {_CLAIMS_SQL}, {tables} {rows}"


def _fitted(rows: DataFrame, label: str, family: penalised.Family, penalty: float, l1: float) -> penalised.Penalised:
    """A fit on the training part."""
    return penalised.fit(rows.where("part = 0"), FEATURES, label, family, penalty, l1)


def _coefficients(t: Tables, label: str, family: penalised.Family, penalty: float, l1: float) -> DataFrame:
    rows = claims(t).cache()
    found = _fitted(rows, label, family, penalty, l1).table(rows)
    rows.unpersist()
    return found.select("term", rounded("coefficient", 5).alias("coefficient"))


@query(_coefficients_sql(_POISSON_SQL, "poisson"))
def claim_poisson(t: Tables) -> DataFrame:
    """Numbers of claims: Poisson, log link, L2."""
    return _coefficients(t, "claims", penalised.POISSON, PENALTY, 0.0)


@query(_coefficients_sql(_RIDGE_SQL, "ridge"))
def claim_logistic_l2(t: Tables) -> DataFrame:
    """Two claims or more: logistic, L2."""
    return _coefficients(t, "several", penalised.LOGISTIC, PENALTY, 0.0)


@query(_coefficients_sql(_LASSO_SQL, "lasso"))
def claim_logistic_l1(t: Tables) -> DataFrame:
    """Two claims or more: logistic, L1, which drops features."""
    return _coefficients(t, "several", penalised.LOGISTIC, LASSO_PENALTY, 1.0)


def _eta(name: str) -> str:
    return " + ".join(f"{name}_fit.b{i} * x{i}" for i in _D)


def _class_scores_sql(name: str) -> str:
    return f"""
        SELECT '{name}' AS model, metric, value FROM (
            SELECT avg(CASE WHEN (p > 0.5) = (several = 1) THEN 1.0 ELSE 0.0 END) AS accuracy, avg(-ln(greatest(least(CASE WHEN several = 1 THEN p ELSE 1 - p END, 1 - 1e-8), 1e-8))) AS log_loss,
                (sum(rank) FILTER (several = 1) - count(*) FILTER (several = 1) * (count(*) FILTER (several = 1) + 1) / 2) / (CAST(count(*) FILTER (several = 1) AS DOUBLE) * count(*) FILTER (several = 0)) AS auc
            FROM (SELECT several, p, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS rank FROM (
                SELECT several, 1 / (1 + exp(-({_eta(name)}))) AS p, round(p, 9) AS s FROM c, {name}_fit WHERE v >= {TRAINED}))
        ) UNPIVOT (value FOR metric IN (accuracy, log_loss, auc))"""


@query(f"""
    WITH RECURSIVE {_CLAIMS_SQL}, {_POISSON_SQL}, {_RIDGE_SQL}, {_LASSO_SQL}, scores AS (
        SELECT 'poisson' AS model, metric, value FROM (
            SELECT sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(e * e) AS mse FROM (SELECT claims - exp({_eta("poisson")}) AS e FROM c, poisson_fit WHERE v >= {TRAINED})
        ) UNPIVOT (value FOR metric IN (rmse, mae, mse))
        UNION ALL {_class_scores_sql("ridge")} UNION ALL {_class_scores_sql("lasso")}
    ) SELECT model, metric, round(value, 4) AS score FROM scores""")
def claim_scores(t: Tables) -> DataFrame:
    """Scores of the three fits on the other part."""
    rows = claims(t).cache()
    count = _fitted(rows, "claims", penalised.POISSON, PENALTY, 0.0)
    test = rows.where("part = 1")
    errors = metrics.regression_metrics(test.withColumn("prediction", F.exp(count.prediction())), "claims")
    tables = [errors.unpivot([], ["rmse", "mae", "mse"], "metric", "score").withColumn("model", F.lit("poisson"))]
    for name, penalty, l1 in (("ridge", PENALTY, 0.0), ("lasso", LASSO_PENALTY, 1.0)):
        eta = _fitted(rows, "several", penalised.LOGISTIC, penalty, l1).prediction()
        p = penalised.LOGISTIC.mean(eta)
        scored = test.select("several", p.alias("p"), F.round(p, 9).alias("s"), (p > 0.5).cast("double").alias("prediction"))
        truth = F.when(F.col("several") == 1, F.col("p")).otherwise(1 - F.col("p"))
        facts = metrics.accuracy(scored, "several").crossJoin(metrics.log_loss(scored, truth)).withColumn("auc", metrics.roc_auc(scored, "several", "s").scalar())
        tables.append(facts.unpivot([], ["accuracy", "log_loss", "auc"], "metric", "score").withColumn("model", F.lit(name)))
    result = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return result.select("model", "metric", rounded("score", 4).alias("score"))
