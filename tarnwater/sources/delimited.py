"""CSV scans and the CSV sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True, infer: bool = False
) -> DataFrame:
    """CSV scan. A schema is best: without one every column is a string, and ``infer`` costs an extra pass."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_csv_positional(spark: SparkSession, path: str, names: Sequence[str], dtype: str = "double") -> DataFrame:
    """Headerless CSV whose columns are named by position and all cast to one type."""
    strings = StructType([StructField(name, StringType()) for name in names])
    raw = spark.read.schema(strings).csv(path)
    return raw.select([F.col(f"`{name}`").cast(dtype).alias(name) for name in names])


def read_csv_indexed(spark: SparkSession, path: str, index: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with an index column, which becomes the first ordinary column."""
    table = read_csv(spark, path, schema=schema, infer=schema is None)
    return table.select(index, *[c for c in table.columns if c != index])


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str = "none") -> None:
    """CSV sink, one file per partition."""
    df.write.option("header", header).option("compression", compression).csv(path)
