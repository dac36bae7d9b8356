import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from munimetrics.operators import clustering, partitional


def frame_of(spark, points):
    return spark.createDataFrame([(n, *map(float, p)) for n, p in enumerate(points)], "id long, x double, y double, z double")


def same_parts(a, b):
    return len({*zip(a, b)}) == len(set(a)) == len(set(b))


def brute_force_ward(points, k):
    """All pairs of clusters tried in every step."""
    clusters = [[n] for n in range(len(points))]
    while len(clusters) > k:
        best = None
        for i in range(len(clusters)):
            for j in range(i):
                a, b = points[clusters[i]], points[clusters[j]]
                cost = len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()
                if best is None or cost < best[0]:
                    best = cost, i, j
        _, i, j = best
        clusters[j] += clusters.pop(i)
    label = np.zeros(len(points), int)
    for n, c in enumerate(clusters):
        label[c] = n
    return label


@pytest.mark.parametrize("k", [1, 3, 6])
def test_ward_equals_trying_all_pairs(spark, k):
    points = np.random.default_rng(k).normal(0, 1, (60, 3)) * [1, 5, 2]
    points = np.concatenate([points, points[:7]])  # equal rows
    got = partitional.ward_clusters(frame_of(spark, points), "id", ["x", "y", "z"], k).orderBy("id").toPandas().label
    assert same_parts(got.tolist(), brute_force_ward(points, k).tolist())
    sizes = got.value_counts().sort_index().tolist()
    assert sizes == sorted(sizes, reverse=True)


def test_ward_over_grid_features(spark):
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 4, 3000)
    points = np.array([[0, 0, 0], [50, 0, 0], [0, 50, 0], [0, 0, 50]])[truth] + rng.normal(0, 2, (3000, 3))
    got = partitional.ward_clusters(frame_of(spark, points), "id", ["x", "y", "z"], 4, most=300).orderBy("id").toPandas().label
    assert same_parts(got.tolist(), truth.tolist())
    assert partitional.ward_clusters(frame_of(spark, points).limit(0), "id", ["x", "y", "z"], 4).count() == 0
    assert {r.label for r in partitional.ward_clusters(frame_of(spark, points[:2]), "id", ["x", "y", "z"], 4).collect()} == {0, 1}


def lloyd(points, centres, tolerance=1e-4):
    while True:
        near = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        moved = np.array([points[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        if np.sqrt(((moved - centres) ** 2).sum(1)).max() <= tolerance:
            return ((points[:, None] - moved[None]) ** 2).sum(2).min(1).sum()
        centres = moved


def test_kmeans_shares_its_passes(spark):
    rng = np.random.default_rng(7)
    centres = rng.uniform(-20, 20, (6, 3))
    points = centres[rng.integers(0, 6, 900)] + rng.normal(0, 1, (900, 3))
    rows = partitional.hashed_rows(frame_of(spark, points), "id", ["x", "y", "z"])
    fits = {n: partitional.fit_kmeans(rows, 6, n, 3) for n in (1, 20)}
    seeding = 1 + partitional.SEED_PASSES + 1
    for n, fit in fits.items():
        assert fit.scans == seeding + max(fit.passes) + 1 and len(fit.costs) == n and all(fit.rested)
        assert fit.costs[fit.best] == pytest.approx(min(fit.costs))
    true = lloyd(points, centres)
    assert fits[20].costs[fits[20].best] == pytest.approx(true, rel=1e-9)
    label = clustering.kmeans_best_of(frame_of(spark, points), "id", ["x", "y", "z"], 6, 20, 3).orderBy("id").toPandas().label
    near = ((points[:, None] - fits[20].centres[None]) ** 2).sum(2).argmin(1)
    assert (label.to_numpy() == near).all()


def test_kmeans_tells_a_reached_limit(spark):
    points = np.random.default_rng(2).uniform(0, 1, (400, 3))
    rows = partitional.hashed_rows(frame_of(spark, points), "id", ["x", "y", "z"])
    with pytest.warns(RuntimeWarning, match="did not come to rest in 2 passes"):
        fit = partitional.fit_kmeans(rows, 5, 3, iterations=2)
    assert fit.rested == [False] * 3 and fit.passes == [2] * 3
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert all(partitional.fit_kmeans(rows, 5, 3).rested)


def test_kmeans_passes_read_packed_blocks(spark):
    points = np.random.default_rng(4).normal(0, 1, (3000, 3))
    packed = partitional._Passes(partitional.hashed_rows(frame_of(spark, points), "id", ["x", "y", "z"])).rows
    assert packed.count() <= 2 * spark.sparkContext.defaultParallelism  # not a row of arrays per row
    found = np.concatenate([np.frombuffer(r["rows"]).reshape(-1, 3) for r in packed.collect()])
    assert (found[np.lexsort(found.T)] == points[np.lexsort(points.T)]).all()


def test_kmeans_few_rows(spark):
    frame = frame_of(spark, [[1, 1, 1]] * 5 + [[2, 2, 2]] * 3)
    labels = clustering.kmeans_best_of(frame, "id", ["x", "y", "z"], 5, 4)
    assert labels.select("label").distinct().count() == 2 and labels.filter(F.col("id") < 5).select("label").distinct().count() == 1
    assert clustering.kmeans_best_of(frame.limit(0), "id", ["x", "y", "z"], 5, 4).count() == 0
