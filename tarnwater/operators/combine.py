"""Joins and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key occurs in ``keys``: a semi-join, so the key set is never collected."""
    return df.join(keys, on, "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return df.join(keys, on, "left_anti")


def equal_to_scalar(df: DataFrame, column: str, one_row: DataFrame) -> DataFrame:
    """Rows whose column equals the single value of a one-row, one-column table (a scalar subquery)."""
    return df.where(F.col(column) == one_row.scalar())


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on columns of the same name where NULL matches NULL, so that the NULL group is not lost."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, same)).drop(*[f"_right_{k}" for k in keys])


def except_all(left: DataFrame, right: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Rows of ``left`` minus rows of ``right``, repeats counted. Rows are counted and subtracted per distinct row; each remaining number is then
    dealt out in chunks, so a row that occurs very often doesn't come out of one task."""
    columns = left.columns
    signed = left.withColumn("_n", F.lit(1)).union(right.toDF(*columns).withColumn("_n", F.lit(-1)))
    rest = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n > 0")
    chunks = rest.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / chunk)))).repartition(*columns, "_chunk")
    repeats = F.least(F.lit(chunk), F.col("_n") - F.col("_chunk") * chunk).cast("int")
    return chunks.select(*columns, F.explode(F.array_repeat(F.lit(0), repeats)).alias("_i")).select(*columns)


def sums_by_dimension(facts: DataFrame, dimension: DataFrame, key: str, group: str, value: str, count: str = "n", total: str = "total") -> DataFrame:
    """Rows and value sum of the facts per attribute of a dimension with a unique key. Facts are summed per key before
    the join: a key with a large share of the rows shrinks to one row in the map tasks."""
    per_key = facts.groupBy(key).agg(F.count("*").alias(count), F.sum(value).alias(total))
    joined = per_key.join(dimension.select(key, group), key)
    return joined.groupBy(group).agg(F.sum(count).alias(count), F.sum(total).alias(total))


def union_tagged(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL by name, each part marked with its label."""
    tagged = [df.withColumn(tag, F.lit(label)) for label, df in parts.items()]
    result = tagged[0]
    for df in tagged[1:]:
        result = result.unionByName(df)
    return result


def side_by_side(parts: dict[str, DataFrame], rank: str) -> DataFrame:
    """Ranked short lists pasted next to each other: row i of each, NULL where a list is shorter."""
    result = None
    for label, df in parts.items():
        renamed = df.select(rank, *[F.col(c).alias(f"{label}_{c}") for c in df.columns if c != rank])
        result = renamed if result is None else result.join(renamed, rank, "full")
    return result
