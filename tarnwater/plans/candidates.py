"""Candidate scoring queries over order keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.functions.bits import inverse_permutation
from tarnwater.operators import candidates
from tarnwater.plans.registry import query, rounded
from tarnwater.session import Tables

_REVERSE = inverse_permutation(candidates.SUBSTITUTION)


def pairs(t: Tables) -> DataFrame:
    """A pair of bytes per order."""
    key = F.col("o_orderkey")
    return t.orders.select(key.bitwiseAND(F.lit(255)).alias("x"), (7 * key + F.col("o_custkey")).bitwiseAND(F.lit(255)).alias("y"))


def _bias_sql(masks: tuple[int, int]) -> str:
    return f"""
    WITH observed AS (SELECT o_orderkey & 255 AS x, (7 * o_orderkey + o_custkey) & 255 AS y FROM orders),
    tried AS (SELECT k, x, xor(y, k) AS z FROM observed, (SELECT unnest(range(0, 256)) AS k)),
    decoded AS (SELECT k, x, (({_REVERSE})[(z >> 4) + 1] << 4) | ({_REVERSE})[(z & 15) + 1] AS u FROM tried)
    SELECT k AS candidate, CAST(sum(CASE WHEN (bit_count(u & {masks[0]}) + bit_count(x & {masks[1]})) % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_even,
        round(abs(sum(CASE WHEN (bit_count(u & {masks[0]}) + bit_count(x & {masks[1]})) % 2 = 0 THEN 1 ELSE 0 END) / count(*) - 0.5), 6) AS bias
    FROM decoded GROUP BY k"""


def _scored(t: Tables, masks: tuple[int, int]) -> DataFrame:
    scores = candidates.candidate_bias(pairs(t), masks)
    return scores.select(F.col("candidate").cast("bigint").alias("candidate"), "n_even", rounded("bias").alias("bias"))


@query(_bias_sql(candidates.FIRST_MASKS))
def candidate_bias(t: Tables) -> DataFrame:
    return _scored(t, candidates.FIRST_MASKS)


@query(_bias_sql(candidates.SECOND_MASKS))
def candidate_bias_second(t: Tables) -> DataFrame:
    return _scored(t, candidates.SECOND_MASKS)


@query(f"SELECT candidate, bias FROM ({_bias_sql(candidates.FIRST_MASKS)}) ORDER BY bias DESC, candidate LIMIT 2")
def candidate_best(t: Tables) -> DataFrame:
    return candidates.best_candidates(_scored(t, candidates.FIRST_MASKS).select("candidate", "bias"))


@query(
    "WITH observed AS (SELECT o_orderkey & 15 AS x, o_custkey & 15 AS y FROM orders), masks AS (SELECT unnest(range(0, 16)) AS i) SELECT i, "
    + ", ".join(f"CAST(sum(CASE WHEN (bit_count(x & i) + bit_count(y & {j})) % 2 = 0 THEN 1 ELSE 0 END) - count(*) / 2 AS DOUBLE) AS m{j:x}" for j in range(16))
    + " FROM observed, masks GROUP BY i"
)
def parity_table(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderkey").bitwiseAND(F.lit(15)).alias("x"), F.col("o_custkey").bitwiseAND(F.lit(15)).alias("y"))
    return candidates.parity_table(rows).withColumn("i", F.col("i").cast("bigint"))
