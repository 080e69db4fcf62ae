"""Encoding, assembling, scaling and projection of features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, OneHotEncoder, PCAModel, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.operators.aggregate import column_values
from tarnwater.operators.order import row_positions


#: A value that more than one in so many rows have is hot: at most as many values are. Its rows are dealt out over SALTS tasks.
HOT, SALTS = 64, 32


def value_positions(df: DataFrame, column: str) -> DataFrame:
    """The column's values with (n, position): 0 for the most frequent one, equal counts in order of the value. NULL has none. Written once, by
    ranges of (count, value); no value reaches the driver."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return row_positions(counts, [F.desc("n"), column], "position")


def string_index(df: DataFrame, columns: Sequence[str], handle_invalid: str = "error") -> DataFrame:
    """Add ``<column>_index``: 0 for the most frequent value, equal counts in order of the value.

    The dictionary is a table and meets the rows in a shuffle join; the rows of a hot value are dealt out over several tasks. A NULL is an
    error, or with ``handle_invalid`` ``skip`` its row goes, with ``keep`` it gets the number after the last value's.
    """
    for c in columns:
        known = value_positions(df, c)
        # Fewer than HOT values can have more than one in HOT rows each.
        facts = known.agg(F.struct(F.sum("n").alias("total"), F.count("*").alias("values")).alias("f"))
        hot = known.where(F.col("n") * HOT > facts.scalar()["total"]).agg(F.collect_list(c).alias("hot")).scalar()
        is_hot = F.coalesce(F.array_contains("_hot", F.col(c)), F.lit(False))
        dealt = df.withColumn("_hot", hot).withColumn("_salt", F.when(is_hot, F.monotonically_increasing_id() % SALTS).otherwise(0)).drop("_hot")
        salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        salted = known.withColumn("_hot", hot).select(F.col(c).alias("_value"), F.col("position").cast("double").alias(f"{c}_index"), F.explode(salts).alias("_code"))
        same = (F.col("_salt") == F.col("_code")) & (F.col(c) == F.col("_value"))
        joined = dealt.join(salted, same, "inner" if handle_invalid == "skip" else "left").drop("_salt", "_value", "_code")
        if handle_invalid == "error":
            joined = joined.withColumn(f"{c}_index", F.coalesce(f"{c}_index", F.raise_error(F.lit(f"{c} holds NULL")).cast("double")))
        elif handle_invalid == "keep":
            joined = joined.withColumn(f"{c}_index", F.coalesce(f"{c}_index", facts.scalar()["values"].cast("double")))
        df = joined
    return df


def one_hot(df: DataFrame, columns: Sequence[str], drop_last: bool = True) -> DataFrame:
    """Add ``<column>_onehot`` vectors for index columns."""
    encoder = OneHotEncoder(inputCols=list(columns), outputCols=[f"{c}_onehot" for c in columns], dropLast=drop_last)
    return encoder.fit(df).transform(df)


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Add one vector column; a NULL is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)


def scale_unit_std(df: DataFrame, column: str = "features", name: str = "scaled", center: bool = False) -> DataFrame:
    """Divide each vector position by its sample deviation, optionally after subtracting the mean."""
    return StandardScaler(inputCol=column, outputCol=name, withStd=True, withMean=center).fit(df).transform(df)


def standardise_columns(train: DataFrame, columns: Sequence[str], *others: DataFrame) -> list[DataFrame]:
    """Zero mean and unit sample deviation for the columns; the moments come from ``train`` and are applied to all.

    The moments are one row, used as a scalar subquery, so nothing is collected.
    """
    moments = train.agg(F.struct(*[f(F.col(c)).alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("m", F.avg), ("s", F.stddev_samp))]).alias("m"))

    def apply(df: DataFrame) -> DataFrame:
        scaled = df.withColumn("_m", moments.scalar())
        return scaled.withColumns({c: (F.col(c) - F.col(f"_m.m{i}")) / F.col(f"_m.s{i}") for i, c in enumerate(columns)}).drop("_m")

    return [apply(df) for df in (train, *others)]


def batch_normalise(df: DataFrame, column: str, epsilon: float = 1e-3, name: str | None = None) -> DataFrame:
    """Each array position minus its mean, divided by sqrt(population variance + epsilon)."""
    vector = array_to_vector(F.col(column).cast("array<double>"))
    stats = df.agg(Summarizer.metrics("mean", "variance", "count").summary(vector).alias("s"))
    shrink = (F.col("s.count") - 1) / F.col("s.count")
    size = F.size(vector_to_array("s.mean"))
    spread = F.zip_with(vector_to_array("s.variance"), F.array_repeat(shrink, size), lambda v, k: F.sqrt(v * k + epsilon))
    stats = stats.select(F.struct(vector_to_array("s.mean").alias("mean"), spread.alias("spread")).alias("s"))
    located = df.withColumn("_s", stats.scalar())
    centred = F.zip_with(F.col(column).cast("array<double>"), F.col("_s.mean"), lambda x, m: x - m)
    return located.withColumn(name or column, F.zip_with(centred, F.col("_s.spread"), lambda x, s: x / s)).drop("_s")


def to_vector(df: DataFrame, column: str, name: str = "features") -> DataFrame:
    """Array column as an ML vector column."""
    return df.withColumn(name, array_to_vector(F.col(column).cast("array<double>")))


def fit_pca(df: DataFrame, k: int, column: str = "features", name: str = "projected") -> PCAModel:
    """Principal components. The d x d covariance is summed on the executors; d may be a few thousand."""
    return PCA(k=k, inputCol=column, outputCol=name).fit(df)


def components_for_variance(model: PCAModel, share: float) -> int:
    """Smallest number of leading components whose variance reaches the share."""
    total = 0.0
    for i, value in enumerate(model.explainedVariance.toArray()):
        total += float(value)
        if total >= share - 1e-12:
            return i + 1
    return len(model.explainedVariance)


def retained_variance(model: PCAModel) -> list[float]:
    """Share of each kept component in the variance of the kept ones."""
    values = model.explainedVariance.toArray()
    return [float(v) for v in values / values.sum()]


def component_prefix(df: DataFrame, k: int, column: str = "projected", name: str = "features_k") -> DataFrame:
    """First k positions of a projected vector: one fit serves every smaller k."""
    return VectorSlicer(inputCol=column, outputCol=name, indices=list(range(k))).transform(df)


def count_value_histogram(df: DataFrame, columns: Sequence[str], name: str = "column_name") -> DataFrame:
    """Per column and every cell value, the sum of the cells with that value (value x occurrences): (name, cell, total). NULL cells are left out."""
    cells = df.select(*[F.col(c).cast("bigint").alias(c) for c in columns]).unpivot([], list(columns), name, "cell")
    return cells.where(F.col("cell").isNotNull()).groupBy(name, "cell").agg(F.sum("cell").alias("total"))


def wide_histogram(histogram: DataFrame, name: str = "column_name", most: int = 1000) -> DataFrame:
    """The same with one column ``v<value>`` for every value that occurs, missing as 0; an error above ``most`` values."""
    values = column_values(histogram, "cell", most)
    wide = histogram.groupBy(name).pivot("cell", values).agg(F.sum("total")).na.fill(0)
    return wide.select(name, *[F.col(f"`{v}`").alias(f"v{v}") for v in values])
