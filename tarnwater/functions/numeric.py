"""Scalar arithmetic, flags and buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_shift(value: Column, shift: float = 0.5) -> Column:
    """ln(value + shift): a log that is defined at zero."""
    return F.log(value + F.lit(shift))


def clip(value: Column, low: Column | float, high: Column | float) -> Column:
    """Value limited to [low, high]; NULL stays NULL and NaN stays NaN."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    limited = F.least(F.greatest(value, as_column(low)), as_column(high))
    return F.when(value.isNull() | F.isnan(value.cast("double")), value).otherwise(limited)


def bucket_label(value: Column, limit: float, below: str, otherwise: str) -> Column:
    """``below`` under the limit, ``otherwise`` from the limit on, NULL for NULL."""
    return F.when(value < limit, F.lit(below)).when(value >= limit, F.lit(otherwise))


def flag_above(value: Column, threshold: float) -> Column:
    """1 when value > threshold, else 0 (also for NULL)."""
    return F.when(value > threshold, 1).otherwise(0)


def row_mean(*values: Column) -> Column:
    """Mean across columns of one row."""
    total = values[0]
    for value in values[1:]:
        total = total + value
    return total / F.lit(float(len(values)))


def safe_log_probability(probability: Column, epsilon: float = 1e-8) -> Column:
    """ln of a probability kept away from 0 and 1."""
    return F.log(clip(probability, epsilon, 1.0 - epsilon))


def map_values(value: Column, mapping: dict, default: Column | None = None) -> Column:
    """Replace values by a small literal dictionary; values without an entry give ``default`` (NULL)."""
    result: Column | None = None
    for key, new in mapping.items():
        result = F.when(value == key, new) if result is None else result.when(value == key, new)
    if result is None:
        raise ValueError("the mapping is empty")
    return result.otherwise(default) if default is not None else result
