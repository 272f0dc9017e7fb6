"""Integer k-means against a version in plain Python and against SQL."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.compare import connect, duck_rows, spark_rows
from visitloom.llm import catalog, clustering

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, rounds, width):
    """By row: id, cluster, distance, sums, centroid; whole numbers of any size."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == width and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [max(-(1 << 27), min(1 << 27, math.floor(64 * float(np.float32(v))))) for v in x]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [r[1] for r in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    told = [(i, *nearest(v)) for i, v in kept]
    sums = Counter()
    for _, d, c in told:
        sums[c] += d
    return Counter((i, c, d, sums[c], sum(sums.values()), tuple(centroids[c])) for i, d, c in told)


def found(df):
    return Counter((*tuple(r)[:5], tuple(r["centroid"])) for r in df.collect())


@pytest.mark.parametrize(("k", "rounds", "leading"), [(5, 3, 2), (1, 1, 4), (40, 2, 1), (7, 0, 4)])
def test_equals_brute_force(spark, k, rounds, leading):
    rng = random.Random(k)
    # Few different values: many ties and repeated vectors.
    rows = [(n, [rng.choice([-0.5, 0.0, 0.25, 3.0]) for _ in range(4)]) for n in range(200)]
    rows += [(None, [0.0] * 4), (3, [1.0] * 4), (3, [1.0] * 4), (500, None), (501, []), (502, [1.0] * 5), (503, [1.0, None, 1.0, 1.0])]
    rows += [(504, [math.nan] * 4), (505, [math.inf, 0.0, 0.0, 0.0]), (506, [-math.inf] * 4), (507, [-0.0, 0.001, -0.001, 1e-30])]
    told = clustering.cluster(spark.createDataFrame(rows, SCHEMA).repartition(4), k, rounds, width=4, leading=leading)
    assert told.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert found(told) == brute(rows, k, rounds, 4)


def test_very_large_components_count_as_the_largest(spark):
    rows = [(1, [3e30, 0.0]), (2, [-3e30, 0.0]), (3, [0.5, 1.0]), (4, [0.25, 1.0])]
    told = clustering.cluster(spark.createDataFrame(rows, SCHEMA), 2, 1, width=2, leading=1)
    assert found(told) == brute(rows, 2, 1, 2)


def test_few_and_no_vectors_and_other_columns(spark):
    told = clustering.cluster(spark.createDataFrame([(1, [1.0] * 64)], SCHEMA))
    assert [tuple(r)[:5] for r in told.collect()] == [(1, 0, 0, 0, 0)]
    none = spark.createDataFrame([(1, None)], SCHEMA)
    assert clustering.cluster(none).count() == 0 and clustering.cluster(none).columns == told.columns
    extra = SCHEMA + ", cluster string, vector string, rotated int, digest int"
    rows = [(n, [float(n)] * 64, "x", "y", 1, 2) for n in range(5)]
    assert clustering.cluster(spark.createDataFrame(rows, extra), 2).count() == 5


def test_bounds_rule_out_centroids_and_lose_none():
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 40, (16, 64))
    vectors = np.floor(centre[rng.integers(0, 16, 3000)] + rng.normal(0, 6, (3000, 64))).astype(np.int64)
    centroids = np.floor(centre).astype(np.int64)
    axes = np.linalg.eigh(np.cov(vectors.T))[1][:, ::-1][:, :16]
    rotation = clustering.Rotation(vectors.mean(axis=0), axes)
    number, distance, looked = clustering.nearest(vectors, rotation(vectors), centroids, rotation(centroids))
    whole = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
    assert looked < 0.1 * whole.size


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_equals_sql(spark, sf):
    sf, name = f"/root/testdata/sf{sf}", "op13_centroid_clustering"
    columns, rows = spark_rows(catalog.QUERIES[name](spark, sf))
    assert (columns, rows) == duck_rows(connect(sf), catalog.ORACLE_SQL[name])
