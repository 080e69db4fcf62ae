"""String, math and bit function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions import arrays, bits, numeric
from tarnwater.operators.candidates import bit_at
from tarnwater.plans.registry import CELLS_SQL, long_vector, query, rounded
from tarnwater.session import Tables


@query("""
    SELECT doc_id, len(regexp_extract_all(text, '[0-9]+')) AS n_numbers, array_to_string(regexp_extract_all(text, '[0-9]+'), ',') AS numbers
    FROM documents""")
def regex_find_all(t: Tables) -> DataFrame:
    found = t.documents.select("doc_id", F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1)).alias("found"))
    return found.select("doc_id", F.size("found").cast("bigint").alias("n_numbers"), F.array_join("found", ",").alias("numbers"))


@query("""
    SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, length(c_name) AS n_chars, lower(c_mktsegment) AS segment,
        replace(c_name, '#', '') AS cleaned FROM customer""")
def string_basics(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.concat_ws("/", "c_name", "c_mktsegment").alias("joined"), F.length("c_name").cast("bigint").alias("n_chars"),
        F.lower("c_mktsegment").alias("segment"), F.regexp_replace("c_name", "#", "").alias("cleaned"),
    )


@query("""
    WITH b AS (SELECT o_orderkey, bin(o_orderkey) AS d, bin(o_orderkey + 8589934592) AS w FROM orders)
    SELECT o_orderkey, CASE WHEN length(d) < 32 THEN lpad(d, 32, '0') ELSE d END AS bits, CASE WHEN length(w) < 32 THEN lpad(w, 32, '0') ELSE w END AS wide FROM b""")
def binary_text(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select("o_orderkey", bits.binary_text(key, 32).alias("bits"), bits.binary_text(key + F.lit(1 << 33), 32).alias("wide"))


@query("SELECT l_orderkey, l_quantity, round(ln(l_quantity + 0.5), 6) AS log_quantity FROM lineitem")
def log_shift(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_quantity", rounded(numeric.log_shift(F.col("l_quantity"))).alias("log_quantity"))


@query("""
    SELECT p_partkey, round(p_retailprice + p_size, 2) AS added, round(p_retailprice * p_size, 2) AS multiplied, round(p_retailprice / p_size, 6) AS divided,
        round(pow(p_size, 2), 2) AS squared, round(sqrt(p_retailprice), 6) AS root, round(exp(p_size / 10.0), 6) AS exponential
    FROM part""")
def scalar_math(t: Tables) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return t.part.select(
        "p_partkey", rounded(price + size, 2).alias("added"), rounded(price * size, 2).alias("multiplied"), rounded(price / size).alias("divided"),
        rounded(F.pow(size, F.lit(2)), 2).alias("squared"), rounded(F.sqrt(price)).alias("root"), rounded(F.exp(size / F.lit(10.0))).alias("exponential"),
    )


@query("SELECT c_custkey, abs(c_acctbal) AS size, CAST(sign(c_acctbal) AS DOUBLE) AS sign FROM customer")
def abs_sign(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("size"), F.signum("c_acctbal").alias("sign"))


@query(f"WITH {CELLS_SQL} SELECT vec_id, pos, round(least(greatest(x, -0.1), 0.1), 6) AS value FROM cells")
def clip_values(t: Tables) -> DataFrame:
    clipped = t.embeddings.select("vec_id", arrays.clip_array(F.col("embedding").cast("array<double>"), -0.1, 0.1).alias("v"))
    return long_vector(clipped, ["vec_id"], "v").withColumn("pos", F.col("pos").cast("bigint"))


@query(f"""
    WITH {CELLS_SQL}, marked AS (SELECT vec_id, CASE WHEN x < 0 THEN 'nan'::DOUBLE ELSE x END AS x FROM cells)
    SELECT vec_id, CAST(sum(CASE WHEN isnan(x) THEN 1 ELSE 0 END) AS BIGINT) AS n_nan, round(sum(CASE WHEN NOT isnan(x) THEN x END), 6) AS total
    FROM marked GROUP BY vec_id""")
def nan_flags(t: Tables) -> DataFrame:
    marked = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(x < 0, F.lit(float("nan"))).otherwise(x))
    rows = t.embeddings.select("vec_id", marked.alias("v"))
    n_nan = F.size(F.filter("v", lambda x: F.isnan(x))).cast("bigint").alias("n_nan")
    kept = F.filter("v", lambda x: ~F.isnan(x))
    return rows.select("vec_id", n_nan, rounded(arrays.array_sum(kept)).alias("total"))


@query("""
    SELECT o_orderkey, xor(o_orderkey, o_custkey) AS x, o_orderkey & o_custkey AS a, o_orderkey >> 3 AS r, (o_orderkey & 255) << 2 AS l,
        (o_orderkey >> 4) & 1 AS bit4, CAST(bit_count(o_orderkey & 240) % 2 AS INTEGER) AS parity
    FROM orders""")
def bit_ops(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", key.bitwiseXOR(F.col("o_custkey")).alias("x"), key.bitwiseAND(F.col("o_custkey")).alias("a"), F.shiftright(key, 3).alias("r"),
        F.shiftleft(key.bitwiseAND(F.lit(255)), 2).alias("l"), bit_at(key, 4).cast("bigint").alias("bit4"), bits.parity(key, 240).alias("parity"),
    )


@query(f"""
    WITH {CELLS_SQL}, powers AS (SELECT vec_id, pos, exp(x - max(x) OVER (PARTITION BY vec_id)) AS e FROM cells)
    SELECT vec_id, pos, round(e / sum(e) OVER (PARTITION BY vec_id), 8) AS value FROM powers""")
def softmax_rows(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", arrays.softmax(F.col("embedding")).alias("p"))
    return long_vector(rows, ["vec_id"], "p", 8).withColumn("pos", F.col("pos").cast("bigint"))


@query("""
    WITH scored AS (SELECT l_returnflag = 'R' AS y, least(greatest(l_quantity / 50.0, 0.0), 1.0) AS p FROM lineitem)
    SELECT round(-avg(ln(least(greatest(CASE WHEN y THEN p ELSE 1 - p END, 1e-8), 1.0 - 1e-8))), 6) AS log_loss FROM scored""")
def cross_entropy(t: Tables) -> DataFrame:
    p = numeric.clip(F.col("l_quantity") / 50.0, 0.0, 1.0)
    truth = F.when(F.col("l_returnflag") == "R", p).otherwise(1 - p)
    return t.lineitem.agg(rounded(-F.avg(numeric.safe_log_probability(truth))).alias("log_loss"))
