"""Projection, filters, NULL handling and labelled access."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename some columns in one projection."""
    return df.withColumnsRenamed(dict(names))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str], tolerant: bool = True) -> DataFrame:
    """Cast several columns; when tolerant, text that does not parse becomes NULL."""
    to = lambda name, dtype: F.col(name).try_cast(dtype) if tolerant else F.col(name).cast(dtype)
    return df.withColumns({name: to(name, dtype) for name, dtype in types.items()})


def sort_column_names(df: DataFrame, descending: bool = False) -> DataFrame:
    """Same rows, columns in order of their names."""
    return df.select(*sorted(df.columns, reverse=descending))


def shape_of(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_columns)."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column in one pass, plus ``any_null``."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counted.withColumn("any_null", reduce(lambda a, b: a | b, [F.col(c) > 0 for c in names]))


def mask_cells(df: DataFrame, threshold: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep numeric cells above the threshold, NULL elsewhere; other columns are unchanged."""
    names = list(columns or numeric_columns(df))
    return df.withColumns({c: F.when(F.col(c) > threshold, F.col(c)) for c in names})


def set_cell(df: DataFrame, key: str, label, column: str, value) -> DataFrame:
    """Replace the cell of one column in the rows with the given key."""
    new = F.lit(value).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(F.col(key) == F.lit(label), new).otherwise(F.col(column)))


def label_slice(df: DataFrame, key: str, first, last, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key lies between two labels, both included."""
    rows = df.where(F.col(key).between(F.lit(first), F.lit(last)))
    return rows.select(*columns) if columns else rows


def one_hot_columns(df: DataFrame, column: str, prefix: str | None = None, most: int = 1000) -> DataFrame:
    """One 0/1 column for every category of the table, in order; an error if there are more than ``most``. A NULL gives zeros."""
    stem = column if prefix is None else prefix
    categories = sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().limit(most + 1).collect())
    if len(categories) > most:
        raise ValueError(f"{column} has more than {most} categories")
    return df.withColumns({f"{stem}_{c}": F.when(F.col(column) == c, 1).otherwise(0) for c in categories})


def one_hot_array(value: Column, categories: Sequence, drop_last: bool = False) -> Column:
    """0/1 array in the order of the categories."""
    kept = list(categories)[:-1] if drop_last else list(categories)
    return F.array(*[F.when(value == c, 1).otherwise(0) for c in kept])
