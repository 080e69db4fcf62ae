"""Inline and generated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(list(rows), schema)


def number_range(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "id") -> DataFrame:
    """Half-open integer range as a distributed table."""
    return spark.range(start, stop, step).withColumnRenamed("id", name)


def date_range(bounds: DataFrame, first: Column, last: Column, name: str = "day") -> DataFrame:
    """One row per calendar day between two dates, both included, for each row of ``bounds``."""
    days = F.sequence(first.cast("date"), last.cast("date"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))
