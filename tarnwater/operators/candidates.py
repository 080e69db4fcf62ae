"""Scoring of candidate keys over observed pairs of bytes.

Every candidate needs every observation, but observations only matter through a few bits: counting those first leaves
a table whose size does not depend on the data, and only that table is expanded by the candidates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.functions.bits import inverse_permutation, nibble_lookup, parity

# The four-bit substitution table, and the (output, input) bit masks of the two approximations.
SUBSTITUTION = (0xE, 0x4, 0xD, 0x1, 0x2, 0xF, 0xB, 0x8, 0x3, 0xA, 0x6, 0xC, 0x5, 0x9, 0x0, 0x7)
FIRST_MASKS = (0xF8, 0x70)
SECOND_MASKS = (0x3F, 0x07)


def candidate_bias(
    pairs: DataFrame, masks: tuple[int, int] = FIRST_MASKS, table: Sequence[int] = SUBSTITUTION, x: str = "x", y: str = "y"
) -> DataFrame:
    """Bias of every candidate byte: |share of pairs with even parity - 1/2|; (candidate, n_even, bias)."""
    output_mask, input_mask = masks
    observed = pairs.groupBy(F.col(y).alias("y"), parity(F.col(x), input_mask).alias("x_parity")).agg(F.count("*").alias("n"))
    tried = observed.withColumn("candidate", F.explode(F.sequence(F.lit(0), F.lit(255))))
    decoded = nibble_lookup(F.col("y").cast("int").bitwiseXOR(F.col("candidate")), inverse_permutation(table))
    even = parity(decoded, output_mask) == F.col("x_parity")
    scores = tried.groupBy("candidate").agg(F.sum(F.when(even, F.col("n")).otherwise(0)).alias("n_even"), F.sum("n").alias("_n"))
    return scores.select("candidate", "n_even", F.abs(F.col("n_even") / F.col("_n") - 0.5).alias("bias"))


def parity_table(pairs: DataFrame, bits: int = 4, x: str = "x", y: str = "y") -> DataFrame:
    """For all mask pairs (i, j): pairs whose masked parities agree, minus half of all; one row per i, one column per j."""
    size = 1 << bits
    observed = pairs.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("n"))
    masks = F.sequence(F.lit(0), F.lit(size - 1))
    tried = observed.withColumn("i", F.explode(masks))
    agree = lambda j: parity(F.col("x"), F.col("i").cast("bigint")) == parity(F.col("y"), j)
    half = F.sum("n") / 2
    cell = lambda j: (F.sum(F.when(agree(j), F.col("n")).otherwise(0)) - half).alias(f"m{j:x}")
    return tried.groupBy("i").agg(*[cell(j) for j in range(size)])


def best_candidates(scores: DataFrame, n: int = 2) -> DataFrame:
    """The n candidates with the largest bias; the smaller candidate first among equals."""
    return scores.orderBy(F.desc("bias"), F.asc("candidate")).limit(n)


def bit_at(value: Column, place: int) -> Column:
    """Bit at a place, counted from the least significant."""
    return F.getbit(value, F.lit(place))
