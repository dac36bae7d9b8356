import numpy as np
import pytest
from pyspark.sql import functions as F

from munimetrics.operators import features, layout


def nearest(points, k):
    gaps = ((points[:, None] - points[None]) ** 2).sum(2)
    np.fill_diagonal(gaps, np.inf)
    return np.argsort(gaps, 1, kind="stable")[:, :k]


def shared(a, b):
    return np.mean([len(set(x) & set(y)) / len(x) for x, y in zip(a, b)])


def rows_of(spark, points):
    return spark.createDataFrame([(n, [float(v) for v in p]) for n, p in enumerate(points)], "id long, row array<double>")


@pytest.mark.parametrize("kind", ["even", "clustered"])
def test_recall_of_fifteen_neighbours(spark, kind):
    rng = np.random.default_rng(3)
    points = rng.normal(0, 1, (2000, 8))
    if kind == "clustered":
        points = points * 0.1 + rng.normal(0, 2, (12, 8))[rng.integers(0, 12, 2000)]
    graph = layout.neighbour_graph(rows_of(spark, points)).toPandas()
    assert (graph.groupby("u").size() == 15).all() and (graph.u != graph.v).all()
    found = graph.sort_values(["u", "d"]).groupby("u").v.apply(list)
    assert shared(nearest(points, 15), found) >= 0.9


def test_repeats_and_few_rows(spark):
    points = np.repeat([[0.0, 0.0], [5.0, 5.0]], 700, 0)
    graph = layout.neighbour_graph(rows_of(spark, points), 5, block=64)
    assert graph.groupBy("u").count().filter("count = 5").count() == 1400
    few = layout.neighbour_graph(rows_of(spark, points[:4]), 15)
    assert few.count() == 12 and layout.neighbour_graph(rows_of(spark, points[:1])).count() == 0


def test_distances_are_exact_and_descent_follows_few_trees(spark):
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.normal(0, 1, (600, 12))] * 2) + 1000.0
    frame = rows_of(spark, points)
    lists = layout.neighbour_lists(frame, 5, trees=1, block=64, goal=1.0).toPandas()
    assert len(lists) == 1200 and all(len(set(v)) == len(v) == 5 and u not in v for u, v in zip(lists.u, lists.v))
    found = lists.explode(["v", "d"]).astype({"v": int, "d": float})
    true = np.sqrt(((points[found.u] - points[found.v]) ** 2).sum(1))
    # Copies are at no distance at all: a rounding error would look like a better neighbour in every round.
    assert np.allclose(found.d, true, rtol=1e-12, atol=0) and (found.groupby("u").d.min() == 0).mean() > 0.9


def test_layout_keeps_neighbours_better_than_a_projection(spark):
    rng = np.random.default_rng(5)
    turn = rng.uniform(1.5 * np.pi, 4.5 * np.pi, 1200)
    sheet = np.column_stack([turn * np.cos(turn), rng.uniform(0, 8, 1200), turn * np.sin(turn)])
    frame = spark.createDataFrame([(n, *map(float, p)) for n, p in enumerate(sheet)], "id long, a double, b double, c double")
    frame = features.standardize(frame, ["a", "b", "c"])
    truth = nearest(frame.orderBy("id").select("a", "b", "c").toPandas().to_numpy(), 15)
    kept = {}
    for name, placed in (("flat", features.project(frame, ["a", "b", "c"])), ("laid", layout.neighbour_layout(frame, "id", ["a", "b", "c"]))):
        assert placed.columns == ["id", "a", "b", "c", "umap_x", "umap_y"]
        spots = placed.orderBy("id").select("umap_x", "umap_y").toPandas().to_numpy()
        assert len(spots) == 1200 and np.isfinite(spots).all()
        kept[name] = shared(truth, nearest(spots, 15))
    assert kept["laid"] > kept["flat"] + 0.1 and kept["laid"] > 0.4
    assert layout.neighbour_layout(frame.limit(1), "id", ["a", "b", "c"]).filter(F.col("umap_x") == 0).count() == 1
