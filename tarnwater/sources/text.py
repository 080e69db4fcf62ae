"""Plain-text scans: lines, integer pairs, word vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = r"[ \t\n\r\f]+"


def read_lines(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """One row per line in column ``value``. A gzip file is a single split: with only a few such files, give
    ``partitions`` to spread the lines before any further work."""
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def write_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write a one-column string table as text, optionally gzip compressed."""
    df.write.option("compression", compression).text(path)


def read_int_pairs(spark: SparkSession, path: str, names: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Two blank-separated integers per line; text that is no number becomes NULL."""
    parts = F.split(F.trim("value"), BLANKS)
    columns = [F.get(parts, F.lit(i)).try_cast("bigint").alias(name) for i, name in enumerate(names)]
    return read_lines(spark, path).select(*columns)


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Word followed by its numbers, blank separated, to (word, vector array<float>)."""
    rows = read_lines(spark, path).select(F.split("value", " ").alias("parts"))
    numbers = F.slice("parts", F.lit(2), F.size("parts") - 1).cast("array<float>")
    return rows.select(F.get("parts", F.lit(0)).alias("word"), numbers.alias("vector"))


def vectors_for_vocabulary(vocabulary: DataFrame, vectors: DataFrame, dims: int, word: str = "word") -> DataFrame:
    """Every vocabulary row with its vector, zeros where the vector file has none. The join side is left to the
    optimizer: the vocabulary may be small, but neither side is assumed to be."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dims)
    joined = vocabulary.join(vectors, word, "left")
    return joined.withColumn("vector", F.coalesce("vector", zeros))
