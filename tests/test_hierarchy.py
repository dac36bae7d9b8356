import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from munimetrics.operators import clustering, hierarchy


def brute_force(points, min_samples, least):
    """From the top down on the whole matrix: cut the longest edges of a cluster's tree, look at what falls apart."""
    points = np.asarray(points, float)
    n = len(points)
    gaps = np.hypot(*(points[:, None, k] - points[None, :, k] for k in (0, 1)))
    core = np.sort(gaps, 1)[:, min(min_samples, n - 1)]
    reach = np.maximum(gaps, np.maximum(core[:, None], core[None]))
    inside, best, via = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    inside[0], best, edges = True, reach[0].copy(), []
    for _ in range(n - 1):
        nxt = np.where(inside, np.inf, best).argmin()
        edges.append((best[nxt], via[nxt], nxt))
        inside[nxt] = True
        closer = reach[nxt] < best
        via[closer], best = nxt, np.minimum(best, reach[nxt])
    floor = max(np.ptp(points[:, 0]), np.ptp(points[:, 1])) * 1e-12
    label = np.full(n, -1)

    def parts(members, own):
        up = {m: m for m in members}

        def find(m):
            while up[m] != m:
                up[m] = up[up[m]]
                m = up[m]
            return m

        for _, a, b in own:
            up[find(a)] = find(b)
        out = {}
        for m in members:
            out.setdefault(find(m), []).append(m)
        return list(out.values())

    def walk(members, own, born, root):
        """Stability of the best choice in a cluster that exists from distance ``born`` down, and the chosen clusters."""
        held, whole = 0.0, len(members)
        start = list(members)
        while True:
            longest = max((e[0] for e in own), default=0.0)
            near = 1 / max(longest, floor)
            own = [e for e in own if e[0] < longest]
            found = parts(members, own)
            big = [f for f in found if len(f) >= least]
            if not own and longest == 0.0 and len(found) == 1:
                big = []
            held += near * sum(len(f) for f in found if len(f) < least)
            if len(big) == 1 and (own or len(found) > 1):
                members = big[0]
                own = [e for e in own if e[1] in set(members)]
                continue
            inner, chosen = 0.0, []
            for f in big:
                held += near * len(f)
                s, c = walk(f, [e for e in own if e[1] in set(f)], longest, False)
                inner, chosen = inner + s, chosen + c
            stability = held - whole / max(born, floor)
            return (stability, [start]) if stability >= inner and not root else (inner, chosen)

    if n >= least:
        import sys

        sys.setrecursionlimit(10_000)
        for c in walk(list(range(n)), edges, np.inf, True)[1]:
            label[c] = min(c)
    return label


def blobs(seed, sizes, spreads, noise):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-100, 100, (len(sizes), 2))
    parts = [c + rng.normal(0, s, (n, 2)) for c, s, n in zip(centres, spreads, sizes)]
    return rng.permutation(np.concatenate([*parts, rng.uniform(-130, 130, (noise, 2))]))


def labelled(spark, points, **settings):
    frame = spark.createDataFrame([(n, float(a), float(b)) for n, (a, b) in enumerate(points)], "id long, x double, y double")
    got = hierarchy.hierarchy_clusters(frame, "id", "x", "y", **settings).orderBy("id").toPandas().cluster.to_numpy()
    first = pd.Series(np.arange(len(got))).groupby(got).transform("min").to_numpy()
    assert sorted(set(got[got >= 0])) == list(range(len(set(got[got >= 0]))))
    return np.where(got < 0, -1, first)


def test_unequal_densities_equal_brute_force(spark):
    points = blobs(3, [700, 500, 400, 200], [0.3, 2.0, 8.0, 12.0], 200)
    want = brute_force(points, 12, 40)
    got = labelled(spark, points, min_samples=12, min_cluster_size=40, tile=160)
    assert (got == want).all() and len(set(want[want >= 0])) >= 3


def test_one_radius_fails_where_the_hierarchy_does_not(spark):
    points = blobs(8, [150, 150, 150], [0.2, 0.2, 9.0], 30)
    points[:, 0] *= 1.0
    frame = spark.createDataFrame([(n, float(a), float(b)) for n, (a, b) in enumerate(points)], "id long, x double, y double")
    want = brute_force(points, 5, 25)
    assert (labelled(spark, points, min_samples=5, min_cluster_size=25, tile=128) == want).all()
    single = clustering.density_clusters(frame, "id", "x", "y", 6, 25).toPandas().cluster
    assert single.nunique() != len(set(want))


@pytest.mark.parametrize("edges", [hierarchy.EDGES, 40])
def test_ties_repeats_and_shares_of_edges(spark, edges):
    rng = np.random.default_rng(5)
    grid = np.array([(i, j) for i in range(12) for j in range(8)], float)
    far = np.array([(40 + i, j) for i in range(6) for j in range(6)], float) * 0.5 + 30
    points = np.concatenate([grid, far, far[:10], rng.uniform(0, 60, (30, 2)), np.repeat([[70.0, 70.0]], 12, 0)])
    want = brute_force(points, 4, 9)
    assert (labelled(spark, points, min_samples=4, min_cluster_size=9, tile=16, edges=edges) == want).all()


def test_edge_cases(spark):
    frame = spark.createDataFrame(
        [(str(n), None if n == 3 else float(n % 2), float("nan") if n == 4 else 0.0) for n in range(12)], "id string, x double, y double"
    )
    few = hierarchy.hierarchy_clusters(frame, "id", "x", "y", 2, 75)
    assert few.filter(F.col("cluster") == -1).count() == 12 and few.columns == ["id", "x", "y", "cluster"]
    two = hierarchy.hierarchy_clusters(frame, "id", "x", "y", 2, 4).toPandas().set_index("id").cluster
    assert two["3"] == two["4"] == -1 and two["0"] == two["2"] == 0 and two["1"] == two["11"] == 1
    assert hierarchy.hierarchy_clusters(frame.limit(0), "id", "x", "y").count() == 0
    same = frame.withColumns({"x": F.lit(1.0), "y": F.lit(2.0)})
    assert hierarchy.hierarchy_clusters(same, "id", "x", "y", 2, 4).filter("cluster = -1").count() == 12
