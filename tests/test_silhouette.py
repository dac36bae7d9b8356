import numpy as np
import pytest

from munimetrics.operators import silhouette


def brute_force(points, labels):
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    out = []
    for n, own in enumerate(labels):
        mates = (labels == own).sum() - 1
        if not mates:
            out.append(0.0)
            continue
        a = gaps[n, labels == own].sum() / mates
        b = min(gaps[n, labels == other].mean() for other in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


def rows_of(spark, points, labels):
    return spark.createDataFrame([(int(c), [float(v) for v in p]) for p, c in zip(points, labels)], "label int, row array<double>")


def test_exact_with_a_box_per_row(spark):
    rng = np.random.default_rng(1)
    labels = np.array([*rng.integers(0, 4, 200), 9])
    points = np.concatenate([rng.normal(0, 1, (200, 5)) + labels[:200, None], np.zeros((1, 5))])
    points[:20] = points[0]
    got = silhouette.euclidean_silhouette(rows_of(spark, points, labels))
    assert got["low"] == pytest.approx(got["high"], abs=1e-9) and got["mean"] == pytest.approx(brute_force(points, labels), abs=1e-6)


@pytest.mark.parametrize("boxes", [8, 64, 256])
def test_bounds_hold_the_exact_value(spark, boxes):
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, 900)
    points = rng.normal(0, 1, (900, 3)) + 4 * np.eye(3)[labels]
    got = silhouette.euclidean_silhouette(rows_of(spark, points, labels), boxes)
    exact = brute_force(points, labels)
    assert got["low"] <= exact <= got["high"] and got["high"] - got["low"] < {8: 0.5, 64: 0.35, 256: 0.25}[boxes]
    assert abs(got["mean"] - exact) < 0.08


def test_too_few_labels(spark):
    rows = rows_of(spark, np.zeros((4, 2)), np.zeros(4))
    assert silhouette.euclidean_silhouette(rows) is None and silhouette.euclidean_silhouette(rows.limit(0)) is None
    same = silhouette.euclidean_silhouette(rows_of(spark, np.zeros((4, 2)), np.array([0, 0, 1, 1])))
    assert same == {"low": 0.0, "high": 0.0, "mean": 0.0}
    with pytest.raises(ValueError):
        silhouette.euclidean_silhouette(rows_of(spark, np.zeros((4, 2)), np.arange(4)), 3)
