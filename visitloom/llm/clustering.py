"""Integer k-means, with centroids ruled out in rotated coordinates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.llm.common import checkpointed

#: Components beyond this are cut to it, so that a squared distance fits a long.
LARGEST = 1 << 27
#: Vectors looked at together.
ROWS = 4096
#: Share of the squared norms by which rounding may raise a lower bound: what is left of a norm after
#: its leading part is a difference, whose root keeps half of the digits only.
SLACK = 1e-6


def integer_vectors(embeddings: DataFrame, width: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and vector (``width`` whole numbers, floor of ``scale`` times the component) of the
    embeddings that have exactly ``width`` components, none null or non-finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    kept = kept.where((F.size("embedding") == width) & finite)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    return kept.select("vec_id", whole.alias("vector"))


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width).astype(np.int64)


@dataclass
class Rotation:
    """The leading principal axes, one a column, and the mean."""

    mean: np.ndarray
    axes: np.ndarray

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        """Leading rotated coordinates of each vector, and the norm of what they leave out."""
        moved = vectors - self.mean
        leading = moved @ self.axes
        left = np.maximum((moved * moved).sum(axis=1) - (leading * leading).sum(axis=1), 0)
        return np.concatenate([leading, np.sqrt(left)[:, None]], axis=1)


def fit_rotation(vectors: DataFrame, width: int, leading: int) -> Rotation:
    """Principal axes of all vectors. Tasks send sums of components and of their products, which Spark adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = matrix_of(batch.column(0).slice(at, ROWS), width).astype(float)
                part = np.concatenate([part, np.ones((len(part), 1))], axis=1)
                total += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["cell", "total"])

    sums = vectors.select("vector").mapInArrow(run, "cell long, total double").groupBy("cell").agg(F.sum("total"))
    total = np.zeros((width + 1) ** 2)
    for cell, value in sums.collect():
        total[cell] = value
    total = total.reshape(width + 1, width + 1)
    mean = total[width, :width] / max(1, total[width, width])
    spread = total[:width, :width] / max(1, total[width, width]) - np.outer(mean, mean)
    # The largest eigenvalues come last.
    return Rotation(mean, np.linalg.eigh(spread)[1][:, ::-1][:, :leading])


def nearest(
    vectors: np.ndarray, rotated: np.ndarray, centroids: np.ndarray, rotated_centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (the first of equal ones), the squared distance, and how many
    distances were taken in whole numbers.

    Squared distances of the leading coordinates plus the squared difference of the norms of the rest
    are no larger than those of the vectors. The centroid with the least bound is verified, then each
    other one whose bound is not beyond that distance.
    """
    bound = ((rotated[:, None, :] - rotated_centroids[None, :, :]) ** 2).sum(axis=2)
    first = bound.argmin(axis=1)
    distance = ((vectors - centroids[first]) ** 2).sum(axis=1)
    size = (rotated**2).sum(axis=1)[:, None] + (rotated_centroids**2).sum(axis=1)[None, :]
    left = bound - SLACK * (size + 1) <= distance[:, None]
    left[np.arange(len(first)), first] = False
    row, other = np.nonzero(left)
    whole = np.full(bound.shape, np.iinfo(np.int64).max)
    whole[np.arange(len(first)), first] = distance
    whole[row, other] = ((vectors[row] - centroids[other]) ** 2).sum(axis=1)
    best = whole.argmin(axis=1)
    return best, whole[np.arange(len(best)), best], len(first) + len(row)


def _assigned(part: pa.RecordBatch, centroids: np.ndarray, rotation: Rotation) -> Iterator[tuple]:
    """By some rows at a time: the rows, their vectors, nearest centroids and distances."""
    rotated_centroids = rotation(centroids)
    width = centroids.shape[1]
    for at in range(0, part.num_rows, ROWS):
        some = part.slice(at, ROWS)
        vectors = matrix_of(some.column(1), width)
        rotated = some.column(2).flatten().to_numpy().reshape(some.num_rows, -1)
        yield some, vectors, *nearest(vectors, rotated, centroids, rotated_centroids)[:2]


def moved_centroids(stored: DataFrame, centroids: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Each centroid as the floored mean of its vectors; one without vectors stays."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            for _, vectors, cluster, _ in _assigned(batch, centroids, rotation):
                np.add.at(total, cluster, np.concatenate([vectors, np.ones((len(vectors), 1), np.int64)], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["cell", "total"])

    # As many rows as components of centroids and one more each; both numbers are parameters.
    sums = stored.mapInArrow(run, "cell long, total long").groupBy("cell").agg(F.sum("total")).collect()
    total = np.zeros(k * (width + 1), np.int64)
    for cell, value in sums:
        total[cell] = value
    total = total.reshape(k, width + 1)
    some = total[:, width] > 0
    out = centroids.copy()
    out[some] = total[some, :width] // total[some, width:]
    return out


def seeds(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the least hashes, at most ``k``; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], np.int64)


def cluster(
    embeddings: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, width: int = 64, scale: int = 64, leading: int = 16
) -> DataFrame:
    """Cluster of every vector: vec_id, cluster, distance (squared), cluster_inertia and inertia (sums
    of distance in the cluster and over all), centroid (whole numbers).

    Vectors are made whole numbers (``integer_vectors``; components beyond 2**27 count as that).
    Centroids start as the ``k`` vectors whose ``seed:vec_id`` has the least SHA-256. Each of ``rounds``
    rounds assigns all vectors to the nearest centroid, the first of equal ones, and moves each centroid
    to the floored mean of its vectors; then all are assigned once more. Each vector's ``leading``
    principal coordinates and the norm of the rest are stored once; they rule out centroids, and
    the others are compared in whole numbers, so the result does not depend on rounding.

    Null embeddings and others that do not count have no row. Null and repeated ids stay rows of their
    own. Fewer than ``k`` vectors give as many centroids, none no rows; other columns are dropped.
    """
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings, width, scale)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = seeds(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        )
    rotation = fit_rotation(vectors, width, leading)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                rotated = rotation(matrix_of(some.column(1), width))
                cuts = pa.array(np.arange(0, rotated.size + 1, rotated.shape[1]), pa.int32())
                lists = pa.ListArray.from_arrays(cuts, pa.array(rotated.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], ["vec_id", "vector", "rotated"])

    kinds = T.StructType([*vectors.schema, T.StructField("rotated", T.ArrayType(T.DoubleType()))])
    stored = checkpointed(vectors.mapInArrow(rotate, kinds))
    for _ in range(rounds):
        centroids = moved_centroids(stored, centroids, rotation)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, _, number, distance in _assigned(batch, centroids, rotation):
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    assigned = checkpointed(stored.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"))
    sums = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}
    told = [(n, sums.get(n, 0), sum(sums.values()), row) for n, row in enumerate(centroids.tolist())]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    # A row for each centroid.
    return assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )

