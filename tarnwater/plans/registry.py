"""Query registry: a builder from tables to a DataFrame, and the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwater.session import Tables


@dataclass(frozen=True)
class Query:
    """One registered query; ``sql`` is None where no SQL statement gives the same rows."""

    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark, path: str) -> DataFrame:
        return self.build(Tables(spark, path))


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register the decorated builder under its function name."""

    def register(build):
        if build.__name__ in REGISTRY:
            raise ValueError(f"query {build.__name__} is registered twice")
        REGISTRY[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded double; adding zero turns -0.0 into 0.0."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def day_text(value: Column | str) -> Column:
    """Date as yyyy-MM-dd text."""
    return F.date_format(value, "yyyy-MM-dd")


def long_vector(df: DataFrame, ids: list[str], array: str, digits: int = 6) -> DataFrame:
    """Array column as rows (ids, pos, value). The outer form keeps the array from being computed once more for a
    filter on its size; rows of a missing array are dropped afterwards."""
    rows = df.select(*ids, F.posexplode_outer(array).alias("pos", "value")).where(F.col("pos").isNotNull())
    return rows.select(*ids, "pos", rounded("value", digits).alias("value"))


def uniform_sql(seed: int, *keys: str) -> str:
    """SQL twin of the keyed uniform number."""
    return f"(CAST('0x' || substr({digest_sql(seed, *keys)}, 1, 8) AS BIGINT) / 4294967296.0)"


def digest_sql(seed: int, *keys: str) -> str:
    """SQL twin of the keyed digest."""
    return f"md5(concat_ws(':', '{seed}', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))"


# SQL: embeddings as rows (vec_id, label, pos, x), pos from 0.
CELLS_SQL = """
    cells AS (
        SELECT vec_id, label, i - 1 AS pos, CAST(embedding[i] AS DOUBLE) AS x
        FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    )"""
