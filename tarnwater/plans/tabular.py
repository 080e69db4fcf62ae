"""Chains over whole tables: a lasso from a raw table, and counts projected on two components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.models import tabular
from tarnwater.plans.registry import query, rounded
from tarnwater.session import Tables

# The documented penalty and test share.
ALPHA, TEST_SHARE = 0.1, 0.15
NUMERIC = ("quantity", "discount", "tax")
FLAGS = ("A", "N", "R")
TERMS = (*NUMERIC, *[f"flag_{f}" for f in FLAGS])
ORDER = ("shipped", "price", "quantity", "discount", "tax", "flag")


def prepared(t: Tables) -> tabular.Prepared:
    """Line items in order of shipping, with a price that follows from quantity and flag besides its own noise; a tax of zero counts as missing."""
    price = F.col("l_extendedprice") / 1000 + F.col("l_quantity") + F.when(F.col("l_returnflag") == "R", 20.0).otherwise(0.0)
    rows = t.lineitem.select(
        price.alias("price"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax"), F.col("l_returnflag").alias("flag"), F.col("l_shipdate").alias("shipped"),
    )
    return tabular.prepare(rows, "price", NUMERIC, "flag", ORDER, TEST_SHARE)


_D = range(1, len(TERMS) + 1)
_SWEEPS = 300


def _lasso_sql() -> str:
    """Common tables: all standardised rows z (y, x1, ..., is_train) and the fit b (b0, b1, ...), by coordinate descent on sums over the training rows."""
    numeric = [f"CAST({c} AS DOUBLE)" for c in NUMERIC]
    flags = [f"CASE WHEN flag = '{f}' THEN 1.0::DOUBLE ELSE 0.0 END" for f in FLAGS]
    raw = ", ".join(f"{x} AS r{i}" for i, x in zip(_D, [*numeric, *flags], strict=True))
    moments = ", ".join(f"avg(r{i}) AS m{i}, stddev_samp(r{i}) AS s{i}" for i in _D)
    sums = [f"sum(x{i} * (y - mean_y)) AS c{i}" for i in _D] + [f"sum(x{i} * x{j}) AS h{i}_{j}" for i in _D for j in _D if i <= j]
    h = lambda i, j: f"h{min(i, j)}_{max(i, j)}"
    sweep = f"SELECT * FROM w, g WHERE it < {_SWEEPS}"
    for j in _D:
        others = " + ".join(f"{h(j, i)} * {'n' if i < j else 'b'}{i}" for i in _D if i != j)
        sweep = f"SELECT *, sign(p{j}) * greatest(abs(p{j}) - n * {ALPHA}::DOUBLE, 0) / h{j}_{j} AS n{j} FROM (SELECT *, c{j} - ({others}) AS p{j} FROM ({sweep}))"
    return f"""
    k AS (
        SELECT l_extendedprice / 1000 + l_quantity + CASE WHEN l_returnflag = 'R' THEN 20.0::DOUBLE ELSE 0.0 END AS price, l_quantity AS quantity, l_discount AS discount, nullif(l_tax, 0) AS tax, l_returnflag AS flag, l_shipdate AS shipped FROM lineitem
        WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND l_discount IS NOT NULL AND nullif(l_tax, 0) IS NOT NULL AND l_returnflag IS NOT NULL
    ), f AS MATERIALIZED (
        SELECT price AS y, {raw}, row_number() OVER (ORDER BY {', '.join(ORDER)}) <= count(*) OVER () - ceil(count(*) OVER () * {TEST_SHARE}::DOUBLE) AS is_train FROM k
    ), m AS (SELECT avg(y) AS mean_y, {moments} FROM f WHERE is_train),
    z AS MATERIALIZED (SELECT is_train, y, mean_y, {', '.join(f'(r{i} - m{i}) / s{i} AS x{i}' for i in _D)} FROM f, m),
    g AS MATERIALIZED (SELECT count(*) AS n, any_value(mean_y) AS b0, {', '.join(sums)} FROM z WHERE is_train),
    w AS (
        SELECT 0 AS it, {', '.join(f'0.0::DOUBLE AS b{i}' for i in _D)}
        UNION ALL SELECT it + 1, {', '.join(f'n{i}' for i in _D)} FROM ({sweep})
    ), b AS (SELECT b0, {', '.join(f'b{i}' for i in _D)} FROM w, g WHERE it = {_SWEEPS})"""


@query(
    f"WITH RECURSIVE {_lasso_sql()} SELECT 'intercept' AS term, round(b0, 4) + 0.0 AS coefficient FROM b"
    + "".join(f" UNION ALL SELECT '{c}', round(b{i}, 4) + 0.0 FROM b" for i, c in zip(_D, TERMS, strict=True))
)
def tabular_lasso_terms(t: Tables) -> DataFrame:
    """Coefficients of the lasso on standardised features and the one-hot columns of the flag."""
    data = prepared(t)
    return tabular.lasso(data, ALPHA).table(data.rows).select("term", rounded("coefficient", 4).alias("coefficient"))


@query(f"""
    WITH RECURSIVE {_lasso_sql()}
    SELECT is_train, count(*) AS n, round(sqrt(avg(pow(y - (b0 + {' + '.join(f'b{i} * x{i}' for i in _D)}), 2))), 4) AS rmse, round(stddev_pop(y), 4) AS deviation FROM z, b GROUP BY is_train""")
def tabular_lasso_errors(t: Tables) -> DataFrame:
    """Error of the lasso before and after the split, beside the deviation of the target."""
    data = prepared(t)
    found = tabular.errors_by_side(data, tabular.lasso(data, ALPHA).prediction())
    return found.select("is_train", "n", rounded("rmse", 4).alias("rmse"), rounded("deviation", 4).alias("deviation"))


def projected(t: Tables) -> tabular.Projection:
    """Suppliers by line number, quantities summed."""
    return tabular.wide_projection(t.lineitem, "l_suppkey", "l_linenumber", "l_quantity")


_SQUARINGS = 16


def _component_sql(name: str, covariance: str) -> str:
    """Common tables: ``<name>_v`` (i, v), the first eigenvector of a covariance table (i, j, c) by repeated squaring, its largest entry positive, and
    ``<name>_e`` (e), the eigenvalue."""
    sql = [f"{name}_0 AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM {covariance} WHERE i = j) AS c FROM {covariance})"]
    for k in range(_SQUARINGS):
        sql.append(f"{name}_{k}s AS MATERIALIZED (SELECT a.i, b.j, sum(a.c * b.c) AS c FROM {name}_{k} a JOIN {name}_{k} b ON a.j = b.i GROUP BY a.i, b.j)")
        sql.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT i, j, c / (SELECT sum(c) FROM {name}_{k}s WHERE i = j) AS c FROM {name}_{k}s)")
    last = f"{name}_{_SQUARINGS}"
    sql.append(f"{name}_v AS MATERIALIZED (SELECT i, c / (SELECT sqrt(max(c)) FROM {last} WHERE i = j) AS v FROM {last} WHERE j = (SELECT j FROM {last} WHERE i = j ORDER BY c DESC, j LIMIT 1))")
    sql.append(f"{name}_e AS MATERIALIZED (SELECT sum(a.v * c * b.v) AS e FROM {covariance} JOIN {name}_v a USING (i) JOIN (SELECT i AS j, v FROM {name}_v) b USING (j))")
    return ", ".join(sql)


_PROJECTION_SQL = f"""
    names AS (SELECT DISTINCT l_linenumber AS i FROM lineitem), suppliers AS (SELECT DISTINCT l_suppkey FROM lineitem),
    sums AS (SELECT l_suppkey, l_linenumber AS i, CAST(sum(l_quantity) AS DOUBLE) AS x FROM lineitem GROUP BY ALL),
    wide AS MATERIALIZED (SELECT l_suppkey, i, coalesce(x, 0.0::DOUBLE) AS x FROM (SELECT * FROM suppliers, names) LEFT JOIN sums USING (l_suppkey, i)),
    scaled AS MATERIALIZED (SELECT l_suppkey, i, x / (stddev_samp(x) OVER (PARTITION BY i)) AS x FROM wide),
    cov AS MATERIALIZED (SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS c FROM scaled a JOIN scaled b USING (l_suppkey) GROUP BY a.i, b.i),
    {_component_sql("one", "cov")},
    rest AS MATERIALIZED (SELECT cov.i, cov.j, c - e * a.v * b.v AS c FROM cov, one_e JOIN one_v a ON a.i = cov.i JOIN one_v b ON b.i = cov.j),
    {_component_sql("two", "rest")}"""


@query(f"""
    WITH {_PROJECTION_SQL}
    SELECT l_suppkey, round(sum(x * a.v), 4) + 0.0 AS pc1, round(sum(x * b.v), 4) + 0.0 AS pc2 FROM scaled JOIN one_v a USING (i) JOIN two_v b USING (i) GROUP BY l_suppkey""")
def counts_two_components(t: Tables) -> DataFrame:
    """Every supplier's quantities by line number, scaled to unit deviation, on two components."""
    return projected(t).rows.select("l_suppkey", rounded("pc1", 4).alias("pc1"), rounded("pc2", 4).alias("pc2"))


@query(f"""
    WITH {_PROJECTION_SQL}, loads AS (SELECT i, a.v AS x, b.v AS y FROM one_v a JOIN two_v b USING (i)),
    s AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c FROM loads)
    SELECT 1 AS component, round(one_e.e / (one_e.e + two_e.e), 5) AS share, round((a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b), 5) + 0.0 AS eigenvalue FROM one_e, two_e, s
    UNION ALL SELECT 2, round(two_e.e / (one_e.e + two_e.e), 5), round((a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b), 5) + 0.0 FROM one_e, two_e, s""")
def counts_retained_shares(t: Tables) -> DataFrame:
    """Share of each of the two components in their variance, and the eigenvalues of the covariance of their loadings."""
    found = projected(t)
    rows = [(i + 1, share, value) for i, (share, value) in enumerate(zip(found.shares, found.eigenvalues, strict=True))]
    return t.spark.createDataFrame(rows, "component int, share double, eigenvalue double").select("component", rounded("share", 5).alias("share"), rounded("eigenvalue", 5).alias("eigenvalue"))
