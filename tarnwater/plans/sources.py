"""Scan and sink queries: tables written in the source format to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions import arrays, random
from tarnwater.operators.order import head_and_tail
from tarnwater.plans.logs import LINES_SQL, render_lines
from tarnwater.plans.registry import day_text, long_vector, query, rounded, uniform_sql
from tarnwater.session import Tables, new_path
from tarnwater.sources import delimited, generate, text


@query(f"WITH {LINES_SQL} SELECT value FROM lines")
def scan_text_lines(t: Tables) -> DataFrame:
    path = new_path(t.spark, "lines")
    text.write_lines(render_lines(t), path, compression="gzip")
    return text.read_lines(t.spark, path)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders")
def scan_csv_typed(t: Tables) -> DataFrame:
    path = new_path(t.spark, "orders")
    orders = t.orders
    delimited.write_csv(orders, path)
    return delimited.read_csv(t.spark, path, schema=orders.schema).withColumn("o_orderdate", day_text("o_orderdate"))


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 'int' AS size_type, 'double' AS price_type FROM part")
def scan_csv_inferred(t: Tables) -> DataFrame:
    path = new_path(t.spark, "part")
    delimited.write_csv(t.part, path)
    part = delimited.read_csv(t.spark, path, infer=True)
    types = {"size_type": F.typeof("p_size"), "price_type": F.typeof("p_retailprice")}
    return part.withColumns(types).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem")
def scan_csv_headerless(t: Tables) -> DataFrame:
    path = new_path(t.spark, "lineitem")
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    delimited.write_csv(t.lineitem.select(label, "l_quantity", "l_extendedprice", "l_discount", "l_tax"), path, header=False, compression="gzip")
    return delimited.read_csv_positional(t.spark, path, ["label", "quantity", "price", "discount", "tax"])


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_index(t: Tables) -> DataFrame:
    path = new_path(t.spark, "supplier")
    supplier = t.supplier.select("s_name", "s_nationkey", "s_suppkey", "s_acctbal")
    delimited.write_csv(supplier, path)
    return delimited.read_csv_indexed(t.spark, path, "s_suppkey", schema=supplier.schema)


@query("SELECT l_orderkey AS x, l_partkey AS y FROM lineitem")
def scan_int_pairs(t: Tables) -> DataFrame:
    path = new_path(t.spark, "pairs")
    text.write_lines(t.lineitem.select(F.concat_ws(" ", "l_orderkey", "l_partkey").alias("value")), path)
    return text.read_int_pairs(t.spark, path)


@query("""
    SELECT 'w' || p_partkey AS word, coalesce(len(embedding), 64) AS n_dims,
        round(coalesce(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 0), 6) AS total
    FROM part LEFT JOIN embeddings ON vec_id = p_partkey""")
def load_word_vectors(t: Tables) -> DataFrame:
    path = new_path(t.spark, "vectors")
    word = F.concat(F.lit("w"), F.col("vec_id").cast("string"))
    text.write_lines(t.embeddings.select(F.concat_ws(" ", word, F.col("embedding").cast("array<string>")).alias("value")), path)
    words = t.part.select(F.concat(F.lit("w"), F.col("p_partkey").cast("string")).alias("word"))
    loaded = text.vectors_for_vocabulary(words, text.read_word_vectors(t.spark, path), 64)
    n_dims = F.size("vector").cast("bigint").alias("n_dims")
    return loaded.select("word", n_dims, rounded(arrays.array_sum(F.col("vector").cast("array<double>"))).alias("total"))


@query("""
    SELECT level, days, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN (VALUES ('1-URGENT', 'top', 1), ('2-HIGH', 'top', 3), ('3-MEDIUM', 'usual', 7),
        ('4-NOT SPECIFIED', 'usual', 7), ('5-LOW', 'usual', 14)) AS r(o_orderpriority, level, days) USING (o_orderpriority)
    GROUP BY level, days""")
def inline_rows(t: Tables) -> DataFrame:
    rules = generate.inline_rows(
        t.spark,
        [("1-URGENT", "top", 1), ("2-HIGH", "top", 3), ("3-MEDIUM", "usual", 7), ("4-NOT SPECIFIED", "usual", 7), ("5-LOW", "usual", 14)],
        "o_orderpriority string, level string, days int",
    )
    joined = t.orders.join(F.broadcast(rules), "o_orderpriority")
    return joined.groupBy("level", "days").agg(F.count("*").alias("n_orders"), rounded(F.sum("o_totalprice"), 2).alias("total"))


@query("""
    SELECT vec_id, i - 1 AS pos,
        round(floor((least(greatest(CAST(embedding[i] AS DOUBLE), -1.0), 1.0) + 1.0) * 127.5) / 255.0, 6) AS value
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def image_flatten_scale(t: Tables) -> DataFrame:
    pixel = F.transform(arrays.clip_array(F.col("embedding").cast("array<double>"), -1.0, 1.0), lambda x: F.floor((x + 1.0) * 127.5))
    images = t.embeddings.select("vec_id", pixel.alias("pixels")).select("vec_id", arrays.reshape(F.col("pixels"), 8, 8).alias("image"))
    flat = images.select("vec_id", F.transform(F.flatten("image"), lambda x: x / 255.0).alias("flat"))
    return long_vector(flat, ["vec_id"], "flat").withColumn("pos", F.col("pos").cast("bigint"))


@query(f"""
    WITH bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
    days AS (SELECT strftime(unnest(generate_series(a, b, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM bounds),
    counts AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY 1)
    SELECT day, coalesce(n, 0) AS n_orders, round({uniform_sql(6, 'day')}, 6) AS draw FROM days LEFT JOIN counts USING (day)""")
def gen_ranges(t: Tables) -> DataFrame:
    orders = t.orders
    bounds = orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    days = generate.date_range(bounds, F.col("a"), F.col("b")).select(day_text("day").alias("day"))
    counts = orders.groupBy(day_text("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    drawn = rounded(random.keyed_uniform(6, "day")).alias("draw")
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n_orders"), drawn)


@query("""
    SELECT 'head' AS side, c_custkey, c_name, c_acctbal FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT 5)
    UNION ALL
    SELECT 'tail', c_custkey, c_name, c_acctbal FROM (SELECT * FROM customer ORDER BY c_custkey DESC LIMIT 5)""")
def head_tail(t: Tables) -> DataFrame:
    return head_and_tail(t.customer.select("c_custkey", "c_name", "c_acctbal"), "c_custkey", 5)
