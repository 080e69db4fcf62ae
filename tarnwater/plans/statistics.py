"""Statistics and linear-algebra queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions import arrays
from tarnwater.operators import stats
from tarnwater.plans.registry import CELLS_SQL, query, rounded
from tarnwater.session import Tables

FEATURES = ("q", "d", "x")
WEIGHTS = (0.5, -3.0, 2.0)
ALPHA = 0.1


def measures(t: Tables) -> DataFrame:
    """Line items as features: quantity, discount, tax and the price in thousands as label."""
    return t.lineitem.select(
        F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_tax").alias("x"), (F.col("l_extendedprice") / 1000.0).alias("y")
    )


MEASURES_SQL = "m AS (SELECT l_quantity AS q, l_discount AS d, l_tax AS x, l_extendedprice / 1000.0::DOUBLE AS y FROM lineitem)"
_ERROR_SQL = "(q * 0.5::DOUBLE + d * -3.0::DOUBLE + x * 2.0::DOUBLE - y)"


def _area_sql(limit: str, steps: int = 2000) -> str:
    """Simpson's rule for the integral of cos(u)^(df - 1) from 0."""
    return f"(SELECT {limit} / {3 * steps} * sum(CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(cos({limit} * i / {steps}), df - 1)) FROM range(0, {steps + 1}) AS k(i))"


@query(f"""
    WITH s AS (
        SELECT count(*) FILTER (o_orderstatus = 'F') AS n1, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS m1, var_samp(o_totalprice) FILTER (o_orderstatus = 'F') AS v1,
            count(*) FILTER (o_orderstatus = 'O') AS n2, avg(o_totalprice) FILTER (o_orderstatus = 'O') AS m2, var_samp(o_totalprice) FILTER (o_orderstatus = 'O') AS v2
        FROM orders
    ), f AS (SELECT (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS t, n1 + n2 - 2 AS df FROM s),
    a AS (SELECT *, least(pi() / 2, 40 / sqrt(df)) AS whole, least(atan(abs(t) / sqrt(df)), least(pi() / 2, 40 / sqrt(df))) AS inside FROM f)
    SELECT round(t, 6) AS t, df, round(greatest(1 - {_area_sql("inside")} / {_area_sql("whole")}, 0), 6) AS p_value FROM a""")
def t_test(t: Tables) -> DataFrame:
    found = stats.t_test(t.orders, "o_orderstatus", "o_totalprice", "F", "O")
    return found.select(rounded("t").alias("t"), "df", rounded(stats.p_value(F.col("t"), F.col("df"))).alias("p_value"))


@query(
    f"WITH {MEASURES_SQL} "
    + " UNION ALL ".join(f"SELECT '{a}' AS i, '{b}' AS j, round(covar_samp({a}, {b}), 6) + 0.0 AS covariance FROM m" for a in "qdxy" for b in "qdxy")
)
def covariance_matrix(t: Tables) -> DataFrame:
    return stats.covariance_matrix(measures(t), ["q", "d", "x", "y"]).withColumn("covariance", rounded("covariance"))


_EIGEN_SQL = """
    e AS (SELECT (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS e1, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS e2 FROM s)"""


@query(f"""
    WITH {MEASURES_SQL}, s AS (SELECT var_samp(q) AS a, covar_samp(q, y) AS b, var_samp(y) AS c FROM m), {_EIGEN_SQL}
    SELECT 1 AS component, round(e1, 5) AS eigenvalue, round(e1 / (e1 + e2), 6) AS share, round(e1 / (e1 + e2), 6) AS cumulative FROM e
    UNION ALL SELECT 2, round(e2, 5), round(e2 / (e1 + e2), 6), 1.0::DOUBLE FROM e""")
def explained_variance(t: Tables) -> DataFrame:
    table = stats.explained_variance(measures(t), ["q", "y"])
    return table.select("component", rounded("eigenvalue", 5).alias("eigenvalue"), rounded("share").alias("share"), rounded("cumulative").alias("cumulative"))


@query(f"""
    WITH {MEASURES_SQL}, s AS (SELECT sum(q * q) AS a, sum(q * y) AS b, sum(y * y) AS c FROM m), {_EIGEN_SQL}
    SELECT 1 AS component, round(sqrt(e1), 4) AS singular_value FROM e UNION ALL SELECT 2, round(sqrt(e2), 4) FROM e""")
def svd_singular_values(t: Tables) -> DataFrame:
    return stats.singular_values(measures(t), ["q", "y"]).withColumn("singular_value", rounded("singular_value", 4))


@query(f"""
    WITH {CELLS_SQL} SELECT a.vec_id, round(sum(a.x * a.x), 6) AS norm2, round(sum(a.x * b.x), 6) AS mirrored
    FROM cells a JOIN cells b ON a.vec_id = b.vec_id AND b.pos = 63 - a.pos GROUP BY a.vec_id""")
def dot_product(t: Tables) -> DataFrame:
    v = F.col("embedding")
    dots = {"norm2": arrays.dot(v, v), "mirrored": arrays.dot(v, F.reverse(v))}
    return t.embeddings.select("vec_id", *[rounded(d).alias(name) for name, d in dots.items()])


@query("""
    SELECT p_partkey, i, j, round((CASE i WHEN 0 THEN p_size ELSE p_retailprice END) * (CASE j WHEN 0 THEN p_size WHEN 1 THEN p_retailprice ELSE 1 END), 4) AS value
    FROM part, (SELECT unnest(range(0, 2)) AS i), (SELECT unnest(range(0, 3)) AS j)""")
def outer_product(t: Tables) -> DataFrame:
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")
    matrix = t.part.select("p_partkey", arrays.outer(F.array(size, price), F.array(size, price, F.lit(1.0))).alias("m"))
    rows = matrix.select("p_partkey", F.posexplode("m").alias("i", "r")).select("p_partkey", "i", F.posexplode("r").alias("j", "value"))
    return rows.select("p_partkey", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), rounded("value", 4).alias("value"))


@query("SELECT l_suppkey, round(sum(l_quantity * p_retailprice), 2) AS product FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey")
def sparse_matvec(t: Tables) -> DataFrame:
    prices = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    product = stats.sparse_matvec(t.lineitem, prices, "l_suppkey", "l_partkey", "l_quantity", "p_retailprice")
    return product.select("l_suppkey", rounded("product", 2).alias("product"))


@query(
    f"WITH {MEASURES_SQL} "
    + " UNION ALL ".join(f"SELECT '{a}' AS i, '{b}' AS j, round(sum({a} * {b}) / count(*), 6) AS value FROM m" for a in FEATURES for b in (*FEATURES, "y"))
)
def gram_matrix(t: Tables) -> DataFrame:
    rows = measures(t)
    gram = stats.gram_matrix(rows, FEATURES, "y")
    n = rows.agg(F.count("*").alias("n"))
    return gram.select("i", "j", rounded(F.col("value") / n.scalar()).alias("value"))


@query(f"WITH {MEASURES_SQL} SELECT round(sum({_ERROR_SQL} * {_ERROR_SQL}) / count(*), 6) AS mean_sse FROM m")
def ols_objective(t: Tables) -> DataFrame:
    rows = measures(t)
    n = rows.agg(F.count("*").alias("n"))
    return stats.squared_error(rows, FEATURES, "y", WEIGHTS).select(rounded(F.col("sse") / n.scalar()).alias("mean_sse"))


@query(
    f"WITH {MEASURES_SQL} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(2.0 * sum({c} * {_ERROR_SQL}) / count(*), 6) AS gradient FROM m" for c in FEATURES)
)
def ols_gradient(t: Tables) -> DataFrame:
    rows = measures(t)
    n = rows.agg(F.count("*").alias("n"))
    gradient = stats.squared_error_gradient(rows, FEATURES, "y", WEIGHTS)
    return gradient.select("feature", rounded(F.col("gradient") / n.scalar()).alias("gradient"))


@query(f"WITH {MEASURES_SQL} SELECT round(avg({_ERROR_SQL} * {_ERROR_SQL}) / 2 + 0.1::DOUBLE * 5.5, 6) AS objective FROM m")
def lasso_objective(t: Tables) -> DataFrame:
    return stats.lasso_objective(measures(t), FEATURES, "y", WEIGHTS, ALPHA).select(rounded("objective").alias("objective"))


@query(
    f"WITH {MEASURES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c} * {_ERROR_SQL}) + 0.1::DOUBLE * {1 if w > 0 else -1}, 6) AS gradient FROM m" for c, w in zip(FEATURES, WEIGHTS)
    )
)
def lasso_gradient(t: Tables) -> DataFrame:
    return stats.lasso_gradient(measures(t), FEATURES, "y", WEIGHTS, ALPHA).withColumn("gradient", rounded("gradient"))


_VECTORS_SQL = f"""
    {MEASURES_SQL}, s AS (SELECT sum(q * q) AS a, sum(q * y) AS b, sum(y * y) AS c FROM m), {_EIGEN_SQL},
    v AS (
        SELECT 1 AS component, sqrt(e1) AS singular_value, b / sqrt(b * b + (e1 - a) * (e1 - a)) AS q, (e1 - a) / sqrt(b * b + (e1 - a) * (e1 - a)) AS y FROM s, e
        UNION ALL SELECT 2, sqrt(e2), b / sqrt(b * b + (e2 - a) * (e2 - a)), (e2 - a) / sqrt(b * b + (e2 - a) * (e2 - a)) FROM s, e
    ), w AS (SELECT component, singular_value, q * g AS q, y * g AS y FROM (SELECT *, CASE WHEN abs(q) >= abs(y) THEN sign(q) ELSE sign(y) END AS g FROM v))"""


@query(f"""
    WITH {_VECTORS_SQL}
    SELECT component, round(singular_value, 4) AS singular_value, 'q' AS column_name, round(q, 6) + 0.0 AS value FROM w
    UNION ALL SELECT component, round(singular_value, 4), 'y', round(y, 6) + 0.0 FROM w""")
def svd_right_vectors(t: Tables) -> DataFrame:
    """Singular values with the right vectors."""
    rows = measures(t)
    table = stats.singular_vectors(rows, ["q", "y"]).right_table(rows)
    return table.select("component", rounded("singular_value", 4).alias("singular_value"), "column_name", rounded("value").alias("value"))


@query(f"""
    WITH {_VECTORS_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey,
        round((l_quantity * w1.q + l_extendedprice / 1000.0::DOUBLE * w1.y) / w1.singular_value, 9) + 0.0 AS u1, round((l_quantity * w2.q + l_extendedprice / 1000.0::DOUBLE * w2.y) / w2.singular_value, 9) + 0.0 AS u2
    FROM lineitem, w w1, w w2 WHERE w1.component = 1 AND w2.component = 2""")
def svd_left_vectors(t: Tables) -> DataFrame:
    """The row of U of every row."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("q"), (F.col("l_extendedprice") / 1000.0).alias("y"))
    return stats.singular_vectors(rows, ["q", "y"]).left(rows).select("l_orderkey", "l_linenumber", "l_partkey", rounded("u1", 9).alias("u1"), rounded("u2", 9).alias("u2"))


_CENTRED_SQL = "z AS (SELECT l_quantity / 50 - 0.5 AS a, l_discount * 10 - 0.5 AS b, l_tax * 12 - 0.5 AS c, l_extendedprice / 1000.0::DOUBLE AS y FROM lineitem)"


@query(f"""
    WITH RECURSIVE {_CENTRED_SQL}, s AS (
        SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(a * c) AS ac, sum(b * b) AS bb, sum(b * c) AS bc, sum(c * c) AS cc, sum(a * y) AS ay, sum(b * y) AS b_y, sum(c * y) AS cy FROM z
    ), d AS (
        SELECT 0 AS step, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc
        UNION ALL SELECT step + 1, wa - ga / (aa + bb + cc), wb - gb / (aa + bb + cc), wc - gc / (aa + bb + cc) FROM (
            SELECT *, aa * wa + ab * wb + ac * wc - ay AS ga, ab * wa + bb * wb + bc * wc - b_y AS gb, ac * wa + bc * wb + cc * wc - cy AS gc FROM d, s
        ) WHERE step < 1000 AND sqrt(ga * ga + gb * gb + gc * gc) > 1e-6 * sqrt(ay * ay + b_y * b_y + cy * cy)
    ), last AS (SELECT * FROM d ORDER BY step DESC LIMIT 1)
    SELECT term, round(w, 4) + 0.0 AS coefficient, step AS steps FROM last UNPIVOT (w FOR term IN (wa, wb, wc))""")
def ols_descent(t: Tables) -> DataFrame:
    """Least squares by own gradient descent."""
    rows = t.lineitem.select(
        (F.col("l_quantity") / 50 - 0.5).alias("wa"), (F.col("l_discount") * 10 - 0.5).alias("wb"), (F.col("l_tax") * 12 - 0.5).alias("wc"), (F.col("l_extendedprice") / 1000.0).alias("y")
    ).cache()
    found = stats.gradient_descent(rows, ["wa", "wb", "wc"], "y")
    rows.unpersist()
    table = t.spark.createDataFrame(list(zip(["wa", "wb", "wc"], found.weights, strict=True)), "term string, coefficient double")
    return table.select("term", rounded("coefficient", 4).alias("coefficient"), F.lit(found.steps).alias("steps"))
