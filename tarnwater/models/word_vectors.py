"""Word vectors from the corpus: windowed co-occurrence counts, positive mutual information, and a randomised range finder.

The information matrix A (words x words, sparse, symmetric) is factorised without ever being put together: A times a thin random
matrix, made orthonormal by its k x k Gram matrix, A applied to that again, and the k x k projection solved. Only k x k numbers reach
the driver; counts, cells and vectors are keyed rows, so neither vocabulary nor corpus has a bound.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnwater.session import materialize


# Places of a batch whose pairs a task counts at once.
PIECE = 1 << 21


def cooccurrences(rows: DataFrame, column: str, window: int = 5) -> DataFrame:
    """How often two words of the array ``column`` stand at most ``window`` places apart: (a, b, n) with a <= b. Tasks count the pairs of a piece
    of their rows with numpy, so that only different pairs become rows; a NULL array or element takes no part."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten()
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            place = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())[known]
            coded = flat.drop_null().dictionary_encode()
            codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            for start in range(0, len(codes), PIECE):
                found = []
                for gap in range(1, window + 1):
                    later = slice(start + gap, start + gap + PIECE)
                    n = len(codes[later])
                    same = place[start : start + n] == place[later]
                    x, y = codes[start : start + n][same], codes[later][same]
                    found.append(np.minimum(x, y) * len(words) + np.maximum(x, y))
                cells = np.concatenate(found)
                cells.sort()
                last = np.flatnonzero(np.append(cells[1:] != cells[:-1], np.ones(min(len(cells), 1), bool)))
                cells, times = cells[last], np.diff(last, prepend=-1)
                yield pa.RecordBatch.from_arrays([words.take(pa.array(cells // len(words))), words.take(pa.array(cells % len(words))), pa.array(times)], ["_x", "_y", "_n"])

    words = rows.select(F.col(column).alias("_words"))
    kind = words.schema["_words"].dataType.elementType
    counted = words.mapInArrow(pairs, StructType().add("_x", kind).add("_y", kind).add("_n", "long"))
    return counted.groupBy(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b")).agg(F.sum("_n").alias("n"))


def information(counts: DataFrame) -> DataFrame:
    """Positive mutual information of both orders of every pair: (word, other, value); pairs as frequent as chance or rarer are left out."""
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    cells = counts.select("n", F.explode(both).alias("p")).select(F.col("p.a").alias("word"), F.col("p.b").alias("other"), "n")
    sums = cells.groupBy("word").agg(F.sum("n").alias("_sum"))
    total = sums.agg(F.sum("_sum").cast("double")).scalar()
    known = cells.join(sums, "word").join(sums.select(F.col("word").alias("other"), F.col("_sum").alias("_other")), "other")
    value = F.log(F.col("n") * total / (F.col("_sum") * F.col("_other").cast("double")))
    return known.select("word", "other", value.alias("value")).where(F.col("value") > 0)


def _mapped(thin: DataFrame, matrix: np.ndarray) -> DataFrame:
    """Rows (word, y array) of a thin matrix times a small one, which is a constant of the plan."""
    columns = F.from_json(F.lit(json.dumps(matrix.T.tolist())), "array<array<double>>")
    dot = lambda column: F.aggregate(F.zip_with("y", column, lambda x, m: x * m), F.lit(0.0), lambda s, x: s + x)
    return thin.select("word", F.transform(columns, dot).alias("y"))


def _inner(rows: DataFrame, left: str, right: str, k: int) -> np.ndarray:
    """k x k sums of products of two array columns, combined in the map tasks."""
    products = F.flatten(F.transform(left, lambda x, i: F.transform(right, lambda y, j: F.struct((i * k + j).alias("cell"), (x * y).alias("product")))))
    out = np.zeros(k * k)
    for r in rows.select(F.inline(products)).groupBy("cell").agg(F.sum("product").alias("s")).collect():  # k * k numbers
        out[r["cell"]] = r["s"] or 0.0
    return out.reshape(k, k)


def _orthonormal(thin: DataFrame, k: int) -> DataFrame:
    """The same range with orthonormal columns; directions that vanish become zero."""
    values, vectors = np.linalg.eigh(_inner(thin, "y", "y", k))
    scale = np.where(values > max(values.max(initial=0.0), 0.0) * 1e-12, 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    return _mapped(thin, vectors * scale)


def _applied(cells: DataFrame, thin: DataFrame, k: int, name: str = "y") -> DataFrame:
    """The sparse symmetric matrix times a thin one: cells meet the rows by ``other`` and are summed by ``word``."""
    met = cells.join(thin.withColumnRenamed("word", "other"), "other")
    sums = met.groupBy("word").agg(*[F.sum(F.col("value") * F.get("y", F.lit(i))).alias(f"_{i}") for i in range(k)])
    return sums.select("word", F.array(*[f"_{i}" for i in range(k)]).alias(name))


def factorise(cells: DataFrame, dims: int, spare: int = 8, rounds: int = 1, seed: int = 6) -> DataFrame:
    """(word, vector array<double>): the ``dims`` leading directions of the symmetric matrix (word, other, value), each scaled by the root of its
    eigenvalue's size, with a sum of components that isn't negative. Fewer words than ``dims`` leave zeros. ``rounds`` sharpen the range."""
    k = dims + spare
    cells = materialize(cells, "information")
    sign = lambda i: F.when(F.xxhash64("other", F.lit(i), F.lit(seed)) % 2 == 0, 1.0).otherwise(-1.0)
    sums = cells.groupBy("word").agg(*[F.sum(F.col("value") * sign(i)).alias(f"_{i}") for i in range(k)])
    thin = materialize(sums.select("word", F.array(*[f"_{i}" for i in range(k)]).alias("y")), "range")
    for _ in range(rounds):
        thin = materialize(_applied(cells, _orthonormal(thin, k), k), "range")
    basis = materialize(_orthonormal(thin, k), "basis")
    image = basis.join(_applied(cells, basis, k, "image"), "word")
    small = _inner(image, "y", "image", k)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values), kind="stable")[:dims]
    scaled = materialize(_mapped(basis, vectors[:, order] * np.sqrt(np.abs(values[order]))), "vectors")
    total = scaled.agg(*[F.sum(F.get("y", F.lit(i))).alias(f"s{i}") for i in range(dims)]).first()
    signs = F.array(*[F.lit(-1.0 if (total[f"s{i}"] or 0.0) < 0 else 1.0) for i in range(dims)])
    return scaled.select("word", F.zip_with("y", signs, lambda x, s: x * s).alias("vector"))


def learn(rows: DataFrame, column: str, dims: int, window: int = 5) -> DataFrame:
    """Word vectors of a corpus of word arrays: (word, vector)."""
    return factorise(information(cooccurrences(rows, column, window)), dims)
