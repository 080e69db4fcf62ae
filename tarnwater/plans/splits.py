"""Split and sample queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.operators import splits
from tarnwater.operators.combine import union_tagged
from tarnwater.plans.registry import digest_sql, query, uniform_sql
from tarnwater.session import Tables

FRACTIONS = (0.4, 0.6, 0.8)
SHARES = {"1-URGENT": 0.7, "2-HIGH": 0.5, "3-MEDIUM": 0.3, "4-NOT SPECIFIED": 0.9}


@query(
    "WITH e AS (SELECT CAST(epoch_us(ts) AS DOUBLE) AS s FROM events), b AS (SELECT min(s) AS lo, max(s) AS hi FROM e) "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS fraction, s < lo + (hi - lo) * {f}::DOUBLE AS is_train, count(*) AS n FROM e, b GROUP BY ALL" for f in FRACTIONS
    )
)
def time_range_split(t: Tables) -> DataFrame:
    seconds = t.events.select(F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("s"))
    parts = {str(f): splits.time_range_split(seconds, F.col("s"), f).groupBy("is_train").agg(F.count("*").alias("n")) for f in FRACTIONS}
    return union_tagged(parts, "fraction")


@query("""
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= count(*) OVER () - ceil(count(*) OVER () * 0.15::DOUBLE) AS is_train
    FROM orders""")
def ordered_split(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return splits.ordered_split(rows, ["o_orderdate", "o_orderkey"], 0.15).select("o_orderkey", "is_train")


_SHARE_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SHARES.items()) + " ELSE 0 END"
_SAMPLE_SQL = f"{uniform_sql(6, 'o_orderkey')} < {_SHARE_SQL}"


def _sampled(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return splits.stratified_flag(rows, "o_orderpriority", SHARES, ["o_orderkey"], 6)


@query(f"SELECT o_orderkey, o_orderpriority FROM orders WHERE {_SAMPLE_SQL}")
def stratified_sample(t: Tables) -> DataFrame:
    return _sampled(t).where("in_sample").drop("in_sample")


@query(f"SELECT o_orderkey, o_orderpriority FROM orders WHERE NOT ({_SAMPLE_SQL})")
def sample_complement(t: Tables) -> DataFrame:
    return _sampled(t).where("not in_sample").drop("in_sample")


@query(f"""
    SELECT o_custkey, o_orderpriority FROM orders
    EXCEPT SELECT o_custkey, o_orderpriority FROM orders WHERE {_SAMPLE_SQL}""")
def sample_complement_distinct(t: Tables) -> DataFrame:
    flagged = splits.stratified_flag(t.orders, "o_orderpriority", SHARES, ["o_orderkey"], 6)
    columns = ["o_custkey", "o_orderpriority"]
    return splits.complement(flagged.select(columns), flagged.where("in_sample").select(columns), columns, semantics="distinct")


_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(f"""
    SELECT CASE WHEN {uniform_sql(6, *_LINE_KEYS)} < 0.99 THEN 0 ELSE 1 END AS outer_part,
        CASE WHEN {uniform_sql(7, *_LINE_KEYS)} < 0.7 THEN 0 ELSE 1 END AS inner_part, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
    FROM lineitem GROUP BY ALL""")
def random_split(t: Tables) -> DataFrame:
    rows = splits.random_parts(t.lineitem.select(_LINE_KEYS), _LINE_KEYS, [0.99, 0.01], 6, "outer_part")
    rows = splits.random_parts(rows, _LINE_KEYS, [0.7, 0.3], 7, "inner_part")
    return rows.groupBy("outer_part", "inner_part").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"))


@query(f"SELECT c_custkey, c_name FROM customer ORDER BY {digest_sql(6, 'c_custkey')}, c_custkey LIMIT 100")
def exact_sample(t: Tables) -> DataFrame:
    return splits.exact_sample(t.customer.select("c_custkey", "c_name"), ["c_custkey"], 100, 6)


@query(f"SELECT c_custkey, row_number() OVER (ORDER BY {digest_sql(6, 'c_custkey')}, c_custkey) - 1 AS position FROM customer")
def shuffle_rows(t: Tables) -> DataFrame:
    return splits.shuffle_rows(t.customer.select("c_custkey"), ["c_custkey"], 6)
