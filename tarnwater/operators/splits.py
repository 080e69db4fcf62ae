"""Reproducible splits and samples.

Random splits compare a keyed hash with a share: no shuffle, the same rows on every attempt, and the complement is the
negated condition instead of a set difference.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnwater.functions.random import keyed_digest, share_limit
from tarnwater.operators.order import row_positions


def time_range_split(df: DataFrame, time: Column, fraction: float, name: str = "is_train") -> DataFrame:
    """Flag rows before ``min + (max - min) * fraction`` of the time range. The bounds are one scalar subquery."""
    cut = df.select(time.alias("_t")).agg((F.min("_t") + (F.max("_t") - F.min("_t")) * F.lit(fraction)).alias("cut"))
    return df.withColumn(name, time < cut.scalar())


def ordered_split(df: DataFrame, order_by: Sequence[str | Column], test_share: float, name: str = "is_train") -> DataFrame:
    """Flag all but the last ``ceil(test_share * n)`` rows in the given (unique) order."""
    placed = row_positions(df, order_by, "_position")
    train_rows = placed.agg((F.count("*") - F.ceil(F.count("*") * F.lit(test_share))).alias("n"))
    return placed.withColumn(name, F.col("_position") < train_rows.scalar()).drop("_position")


def random_parts(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int, name: str = "part") -> DataFrame:
    """Assign every row to part 0, 1, ... with the given weights, by the hash of its key."""
    total = float(sum(weights))
    limits = [w / total for w in accumulate(weights)]
    draw = keyed_digest(seed, *keys)
    part = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        part = F.when(F.col("_draw") < share_limit(limits[i]), i).otherwise(part)
    return df.withColumn("_draw", draw).withColumn(name, part).drop("_draw")


def stratified_flag(df: DataFrame, column: str, fractions: Mapping, keys: Sequence[str], seed: int, name: str = "in_sample") -> DataFrame:
    """Flag a stratified sample without replacement: each stratum has its own share; unlisted strata have none."""
    limit = F.lit(share_limit(0.0))
    for value, fraction in fractions.items():
        limit = F.when(F.col(column) == value, F.lit(share_limit(float(fraction)))).otherwise(limit)
    return df.withColumn(name, keyed_digest(seed, *keys) < limit)


def complement(df: DataFrame, sample: DataFrame, keys: Sequence[str], semantics: str = "key") -> DataFrame:
    """Rows of ``df`` outside ``sample``: by key (every other row is kept), or ``distinct`` for EXCEPT DISTINCT."""
    if semantics == "distinct":
        return df.subtract(sample)
    return df.join(sample.select(*keys), list(keys), "left_anti")


_BUCKET_DIGITS = 5


def exact_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """Exactly n rows (all when there are fewer), drawn without replacement by the hash order of a unique key.

    The hash range is cut into buckets by the first hex digits. Whole buckets below the n-th row are kept by a filter;
    only the one bucket that holds the n-th row is ranked. No sort of the table, whatever the size of n.
    """
    rows = df.withColumn("_digest", keyed_digest(seed, *keys)).withColumn("_bucket", F.substring("_digest", 1, _BUCKET_DIGITS))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    edge = counts.where(F.col("_upto") >= n).agg(F.min(F.struct("_upto", "_bucket", "_n")).alias("e"))
    edge = edge.select(F.coalesce(F.col("e._bucket"), F.lit("g")).alias("bucket"), (F.lit(n) - F.col("e._upto") + F.col("e._n")).alias("need"))
    whole = rows.where(F.col("_bucket") < edge.select("bucket").scalar())
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", *keys))
    partial = rows.where(F.col("_bucket") == edge.select("bucket").scalar()).withColumn("_rank", rank)
    partial = partial.where(F.col("_rank") <= edge.select("need").scalar()).drop("_rank")
    return whole.unionByName(partial).drop("_digest", "_bucket")


def shuffle_rows(df: DataFrame, keys: Sequence[str], seed: int, name: str = "position") -> DataFrame:
    """Random but reproducible order, given as a position column."""
    drawn = df.withColumn("_digest", keyed_digest(seed, *keys))
    return row_positions(drawn, ["_digest", *keys], name).drop("_digest")
