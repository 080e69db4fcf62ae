"""Feature-engineering queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.operators import features, splits, table
from tarnwater.plans.registry import CELLS_SQL, long_vector, query, rounded, uniform_sql
from tarnwater.plans.relational import PRIORITIES
from tarnwater.plans.statistics import MEASURES_SQL, measures
from tarnwater.session import Tables

# Numbers of components; those above the data's width are left out.
ALL_PCA_SIZES = (2, 5, 20, 30, 40, 100, 160)
WIDTH = 64
PCA_SIZES = tuple(k for k in ALL_PCA_SIZES if k <= WIDTH)
_KEYS = ("l_orderkey", "l_linenumber")


def _index_sql(source: str, column: str) -> str:
    return f"SELECT '{column}' AS column_name, {column} AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS idx, count(*) AS n FROM {source} GROUP BY {column}"


@query(_index_sql("lineitem", "l_returnflag") + " UNION ALL " + _index_sql("lineitem", "l_linestatus") + " UNION ALL " + _index_sql("orders", "o_orderpriority"))
def string_index(t: Tables) -> DataFrame:
    lines = features.string_index(t.lineitem.select("l_returnflag", "l_linestatus"), ["l_returnflag", "l_linestatus"])
    orders = features.string_index(t.orders.select("o_orderpriority"), ["o_orderpriority"])

    def mapping(df: DataFrame, column: str) -> DataFrame:
        counted = df.groupBy(F.col(column).alias("value"), F.col(f"{column}_index").alias("idx")).agg(F.count("*").alias("n"))
        return counted.select(F.lit(column).alias("column_name"), "value", "idx", "n")

    return mapping(lines, "l_returnflag").unionByName(mapping(lines, "l_linestatus")).unionByName(mapping(orders, "o_orderpriority"))


@query("""
    WITH ids AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx, count(*) OVER () AS k FROM part GROUP BY p_type)
    SELECT p_partkey, array_to_string(list_transform(range(0, k - 1), lambda i: CASE WHEN i = idx THEN 1 ELSE 0 END), ',') AS code FROM part JOIN ids USING (p_type)""")
def one_hot_drop_last(t: Tables) -> DataFrame:
    indexed = features.string_index(t.part.select("p_partkey", "p_type"), ["p_type"])
    encoded = features.one_hot(indexed, ["p_type_index"])
    code = vector_to_array("p_type_index_onehot").cast("array<int>").cast("array<string>")
    return encoded.select("p_partkey", F.array_join(code, ",").alias("code"))


@query("SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS \"is_{p}\"" for p in PRIORITIES) + " FROM orders")
def one_hot_columns(t: Tables) -> DataFrame:
    return table.one_hot_columns(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "is").drop("o_orderpriority")


@query("SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem")
def vector_assemble(t: Tables) -> DataFrame:
    rows = features.assemble(t.lineitem, ["l_quantity", "l_discount", "l_tax"]).withColumn("a", vector_to_array("features"))
    return rows.select(*_KEYS, *[F.col("a")[i].alias(f"f{i}") for i in range(3)])


@query("""
    WITH s AS (SELECT stddev_samp(l_quantity) AS a, stddev_samp(l_discount) AS b, stddev_samp(l_tax) AS c FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(l_quantity / a, 6) AS f0, round(l_discount / b, 6) AS f1, round(l_tax / c, 6) AS f2 FROM lineitem, s""")
def standard_scale(t: Tables) -> DataFrame:
    rows = features.scale_unit_std(features.assemble(t.lineitem, ["l_quantity", "l_discount", "l_tax"])).withColumn("a", vector_to_array("scaled"))
    return rows.select(*_KEYS, *[rounded(F.col("a")[i]).alias(f"f{i}") for i in range(3)])


@query(f"""
    WITH parted AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d, {uniform_sql(6, *_KEYS)} < 0.85 AS is_train FROM lineitem),
    s AS (SELECT avg(q) AS mq, stddev_samp(q) AS sq, avg(d) AS md, stddev_samp(d) AS sd FROM parted WHERE is_train)
    SELECT l_orderkey, l_linenumber, is_train, round((q - mq) / sq, 6) + 0.0 AS q, round((d - md) / sd, 6) + 0.0 AS d FROM parted, s""")
def standardise_columns(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*_KEYS, F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"))
    parted = splits.random_parts(rows, _KEYS, [0.85, 0.15], 6).withColumn("is_train", F.col("part") == 0).drop("part")
    train, test = features.standardise_columns(parted.where("is_train"), ["q", "d"], parted.where("not is_train"))
    return train.unionByName(test).select(*_KEYS, "is_train", rounded("q").alias("q"), rounded("d").alias("d"))


@query(f"""
    WITH {CELLS_SQL}
    SELECT vec_id, pos, round((x - avg(x) OVER (PARTITION BY pos)) / sqrt(var_pop(x) OVER (PARTITION BY pos) + 0.001::DOUBLE), 6) + 0.0 AS value FROM cells""")
def batch_normalise(t: Tables) -> DataFrame:
    rows = features.batch_normalise(t.embeddings.select("vec_id", "embedding"), "embedding", 0.001, "v")
    return long_vector(rows, ["vec_id"], "v").withColumn("pos", F.col("pos").cast("bigint"))


def vectors(t: Tables) -> DataFrame:
    """Embeddings as ML vectors (vec_id, label, features)."""
    return features.to_vector(t.embeddings, "embedding").select("vec_id", "label", "features")


@query(f"""
    WITH {CELLS_SQL}, n AS (SELECT count(DISTINCT vec_id) AS n FROM cells)
    SELECT component, n AS n_rows, true AS share_matches, true AS mean_matches FROM n, (SELECT unnest(range(1, 6)) AS component)""")
def pca_project(t: Tables) -> DataFrame:
    rows = vectors(t)
    model = features.fit_pca(rows, 5)
    total = rows.agg(Summarizer.variance(F.col("features")).alias("v")).select(F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    centre = rows.agg(Summarizer.mean(F.col("features")).alias("features"))
    expected = model.transform(centre).select(F.posexplode(vector_to_array("projected")).alias("component", "mean"))
    cells = model.transform(rows).select(F.posexplode(vector_to_array("projected")).alias("component", "p"))
    moments = cells.groupBy("component").agg(F.count("*").alias("n_rows"), F.var_samp("p").alias("v"), F.avg("p").alias("m"))
    shares = F.array(*[F.lit(float(x)) for x in model.explainedVariance.toArray()])
    close = lambda a, b: F.abs(a - b) < 1e-9
    return moments.join(F.broadcast(expected), "component").select(
        (F.col("component") + 1).cast("bigint").alias("component"), "n_rows",
        close(F.col("v") / total.scalar(), F.get(shares, "component")).alias("share_matches"), close(F.col("m"), F.col("mean")).alias("mean_matches"),
    )


@query("SELECT count(*) AS n_rows, true AS reaches_share, true AS is_smallest FROM embeddings")
def pca_by_variance(t: Tables) -> DataFrame:
    rows = vectors(t)
    model = features.fit_pca(rows, 64)
    k = features.components_for_variance(model, 0.97)
    shares = [float(x) for x in model.explainedVariance.toArray()]
    kept = features.component_prefix(model.transform(rows), k).where(F.size(vector_to_array("features_k")) == k)
    return kept.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(sum(shares[:k]) >= 0.97).alias("reaches_share"), F.lit(sum(shares[: k - 1]) < 0.97).alias("is_smallest"))


@query(
    f"WITH {CELLS_SQL}, n AS (SELECT count(DISTINCT vec_id) AS n_rows FROM cells) "
    + " UNION ALL ".join(f"SELECT {k} AS k, n_rows, {k} * n_rows AS n_cells, true AS between_neighbours FROM n" for k in PCA_SIZES)
)
def pca_sweep(t: Tables) -> DataFrame:
    rows = vectors(t)
    parts = splits.random_parts(rows, ["vec_id"], [0.8, 0.2], 6)
    model = features.fit_pca(parts.where("part = 0"), max(PCA_SIZES))
    projected = model.transform(parts)
    shares = [float(x) for x in model.explainedVariance.toArray()]
    result, before = None, 0.0
    for k in PCA_SIZES:
        reached = sum(shares[:k])
        sized = features.component_prefix(projected, k).select(F.size(vector_to_array("features_k")).cast("bigint").alias("s"))
        row = sized.agg(F.count("*").alias("n_rows"), F.sum("s").alias("n_cells")).select(
            F.lit(k).alias("k"), "n_rows", "n_cells", F.lit(before < reached <= 1.0 + 1e-9).alias("between_neighbours")
        )
        result, before = row if result is None else result.unionByName(row), reached
    return result


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS BIGINT) AS cell, CAST(sum(CAST({c} AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY ALL" for c in ("l_linenumber", "l_quantity")
    )
)
def count_value_histogram(t: Tables) -> DataFrame:
    return features.count_value_histogram(t.lineitem, ["l_linenumber", "l_quantity"])


@query(f"""
    WITH {MEASURES_SQL}, s AS (SELECT var_samp(q) AS a, covar_samp(q, y) AS b, var_samp(y) AS c FROM m),
    e AS (SELECT (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS e1, a + c AS total FROM s)
    SELECT 1 AS component, round(e1 / total, 6) AS share FROM e UNION ALL SELECT 2, round(1 - e1 / total, 6) FROM e""")
def retained_variance(t: Tables) -> DataFrame:
    model = features.fit_pca(features.assemble(measures(t), ["q", "y"]), 2)
    rows = [(i + 1, s) for i, s in enumerate(features.retained_variance(model))]
    return t.spark.createDataFrame(rows, "component int, share double").withColumn("share", rounded("share"))
