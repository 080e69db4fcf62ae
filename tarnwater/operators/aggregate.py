"""Grouping, moments, pivots and transposes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.operators.combine import join_null_safe
from tarnwater.operators.order import exact_quantiles
from tarnwater.operators.table import numeric_columns


# Bound of the columns that a pivot or transpose makes.
MOST_COLUMNS = 1000


def group_count(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def group_sum(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Sum of all (or the given) numeric columns per key, named ``sum_<column>``."""
    names = columns or [c for c in numeric_columns(df) if c not in keys]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(f"sum_{c}") for c in names])


def column_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample and population deviation as one row per column; one pass over the table."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std_sample"), F.stddev_pop(c).alias("std_population")
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.inline(F.array(*columns)))


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, one row per column."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("minimum"),
                F.max(c).cast("double").alias("maximum"),
            ).alias(c)
            for c in columns
        ]
    ).select(F.inline(F.array(*columns)))
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    at = lambda p, name: F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
    wide = quartiles.groupBy("column_name").agg(at(0.25, "q25"), at(0.5, "q50"), at(0.75, "q75"))
    return stats.join(wide, "column_name", "left")


def column_values(df: DataFrame, column: str, most: int = MOST_COLUMNS) -> list:
    """All values of a column in order, NULL first; an error if there are more than ``most``."""
    found = [r[0] for r in df.select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(found, key=lambda v: (v is not None, v))


def pivot(df: DataFrame, keys: Sequence[str], column: str, value: Column, fill=None, most: int = MOST_COLUMNS) -> DataFrame:
    """Aggregate per key, one column for every value of ``column``; an error if there are more than ``most``."""
    wide = df.groupBy(*keys).pivot(column, column_values(df, column, most)).agg(value)
    return wide if fill is None else wide.na.fill(fill)


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Columns to rows."""
    return df.unpivot(list(ids), list(columns), name, value)


def transpose(df: DataFrame, key: str, columns: Sequence[str], name: str = "measure", most: int = MOST_COLUMNS) -> DataFrame:
    """Swap rows and columns: one row per column, one column per row label; an error if there are more than ``most`` labels."""
    labels = column_values(df, key, most)
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    long = unpivot(long, [key], columns, name, "_value")
    return long.groupBy(name).pivot(key, labels).agg(F.first("_value", ignorenulls=True))


def value_share(counts: DataFrame, keys: Sequence[str], count: str = "n", name: str = "percent") -> DataFrame:
    """Percent of the group total, of the whole table without keys; ``counts`` holds the already aggregated rows."""
    if not keys:
        return counts.withColumn(name, 100.0 * F.col(count) / counts.agg(F.sum(count).alias("_total")).scalar())
    totals = counts.groupBy(*keys).agg(F.sum(count).alias("_total"))
    return join_null_safe(counts, totals, keys).withColumn(name, 100.0 * F.col(count) / F.col("_total")).drop("_total")


def arg_max(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row: the largest value and its key; the smallest key among equals."""
    best = F.max_by(F.struct(key, value), F.struct(F.col(value), -F.col(key)))
    return df.agg(best.alias("_best")).select("_best.*")
