"""Exact centroid clustering of integer vectors by a tournament over bisectors.

For centroids a and b with a < b, a vector x is nearer to b exactly where <x, 2 (b - a)> > |b|^2 - |a|^2: one integer normal and one
threshold per pair, computed once a round. The champion starts as centroid 0 and meets 1, 2, ... in turn; the sign of one
linear test eliminates the loser, and on the bisector (zero) the smaller number stays. After k - 1 tests the champion is the nearest
centroid, ties included, and only its distance is computed. All numbers are integers, so results are exact.

Centroids, normals and sums are bounded by k and the dimension. Each task adds up its own vectors per cluster, so a round moves k
rows a task, however many vectors are equal or fall into one cluster; the vectors themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwater.llm.encode import lean
from tarnwater.session import materialize

DIM, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Components up to this size are added and multiplied in 64 bits without overflow; vectors beyond take Python's whole numbers.
SAFE = 1 << 25
BATCH = 4096


def whole_vectors(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors with exactly ``dim`` components, none null or not finite, and floor(scale * x) of them as whole floats."""
    column = column.cast(pa.list_(pa.float64()))
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(size == dim)
    flat = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)  # a null reads as NaN
    finite = np.isfinite(flat).all(1)
    return right[finite], np.floor(scale * flat[finite])


class Bisectors:
    """Normals and thresholds of all pairs of some centroids, the champion of each vector and its squared distance."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        self.safe = all(abs(c) <= SAFE for row in centroids for c in row)
        exact = np.array(centroids, object)
        squares = (exact * exact).sum(1)
        kind = np.int64 if self.safe else object
        self.points = exact.astype(kind)
        self.normals = (2 * (exact[None, :, :] - exact[:, None, :])).astype(kind)
        self.thresholds = (squares[None, :] - squares[:, None]).astype(kind)

    def champions(self, x: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row, the smaller one of equally near ones."""
        best = np.zeros(len(x), np.int64)
        for challenger in range(1, len(self.centroids)):
            normal, threshold = self.normals[best, challenger], self.thresholds[best, challenger]
            best[((x * normal).sum(1) > threshold).astype(bool)] = challenger
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        difference = x - self.points[best]
        return (difference * difference).sum(1)

    def groups(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, rows as integers) of whole floats: in 64 bits where all fit, else as Python's numbers."""
        fit = (np.abs(x) <= SAFE).all(1) if self.safe else np.zeros(len(x), bool)
        if fit.any():
            yield np.flatnonzero(fit), x[fit].astype(np.int64)
        if not fit.all():
            yield np.flatnonzero(~fit), np.array([[int(c) for c in row] for row in x[~fit]], object).reshape(-1, x.shape[1])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield batch.slice(start, BATCH)


def first_centroids(table: DataFrame, id_column: str, vector: str, k: int, dim: int, scale: int, seed: int) -> list[list[int]]:
    """The k vectors whose ``seed:id`` has the smallest sha256, in that order; of equal ones the smaller vector first, without id last."""
    x = F.col(vector).cast("array<double>")
    valid = (F.size(x) == dim) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    name = F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string"))
    rows = table.where(F.col(vector).isNotNull() & valid).select(F.sha2(name, 256).alias("hash"), x.alias("x"))
    chosen = rows.orderBy(F.col("hash").asc_nulls_last(), F.transform("x", lambda c: F.floor(scale * c).cast("decimal(38,0)"))).limit(k).collect()  # k rows
    return [[int(np.floor(scale * c)) for c in r["x"]] for r in chosen]


def next_centroids(table: DataFrame, vector: str, centroids: list[list[int]], dim: int, scale: int) -> list[list[int]]:
    """floor(sum / count) of each centroid's vectors, by component; a centroid without vectors stays."""
    judge = Bisectors(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dim), object)
        for batch in _batches(batches):
            _, whole = whole_vectors(batch.column(0), dim, scale)
            for _, x in judge.groups(whole):
                best = judge.champions(x)
                counts += np.bincount(best, minlength=len(centroids))
                for c in np.unique(best).tolist():
                    sums[c] += x[best == c].sum(0)
        hit = np.flatnonzero(counts).tolist()
        columns = [pa.array(hit, pa.int32()), pa.array(counts[hit]), pa.array([[str(v) for v in sums[c]] for c in hit], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = table.select(F.col(vector)).mapInArrow(lean(add), "cluster int, n bigint, sums array<string>")
    totals = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim)]
    moved = list(centroids)
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():  # at most k rows
        moved[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dim)]
    return moved


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE, seed: int = 1
) -> tuple[DataFrame, list[list[int]]]:
    """(rows, centroids): one row per vector with exactly ``dim`` components, none null or not finite: (vec_id, cluster, distance (squared)),
    written once; and the final centroids.

    Components become floor(scale * x). Rounds of assignment and of moving the centroids, then one more assignment. Fewer than k vectors give
    as many centroids; equal centroids are allowed, and the smaller number then takes all. Null and repeated ids are rows of their own. A squared
    distance beyond 64 bits is null. Empty tables give no rows; other columns are ignored.
    """
    centroids = first_centroids(table, id_column, vector, k, dim, scale, seed)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(table, vector, centroids, dim, scale)
    judge = Bisectors(centroids) if centroids else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            places, whole = whole_vectors(batch.column(1), dim, scale)
            if not len(places):
                continue
            best, distance = np.zeros(len(places), np.int32), [None] * len(places)
            for at, x in judge.groups(whole):
                best[at] = judge.champions(x)
                for i, d in zip(at.tolist(), judge.distances(x, best[at]).tolist(), strict=True):
                    distance[i] = d if d < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), pa.array(best), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    rows = table.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector))
    return materialize(rows.mapInArrow(lean(assign), "vec_id bigint, cluster int, distance bigint"), "clusters"), centroids


def cluster_report(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Each vector's row with the sums of distances over its cluster and over all, and the sha256 of its centroid."""
    spark = rows.sparkSession
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = sums.agg(F.sum("cluster_inertia").alias("inertia")).scalar()
    names = spark.createDataFrame([(i, centroid_digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    facts = names.join(sums, "cluster").withColumn("inertia", inertia)
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
