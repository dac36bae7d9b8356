import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from munimetrics.operators import aggregates as agg
from munimetrics.operators import clustering, dedup, features, joins, serving, stats
from munimetrics.operators.ordering import positions, quantiles, ranked, value_counts


def test_dedup_is_idempotent_and_deterministic(spark):
    rows = [("1", "a", "2022-01-01"), ("1", "a", "2022-03-01"), ("1", None, "2022-02-01"), ("1", None, "2022-01-01")]
    df = spark.createDataFrame(rows, "k string, v string, data_competencia string")
    once = dedup.dedup_ignoring_snapshot(df)
    wanted = {("1", "a", "2022-03-01"), ("1", None, "2022-02-01")}
    assert set(map(tuple, once.collect())) == wanted
    assert set(map(tuple, dedup.dedup_ignoring_snapshot(once).collect())) == wanted


def test_latest_per_key_breaks_ties_by_smallest_unit(spark):
    rows = [("9", "u2", "2022-12-01"), ("9", "u1", "2022-12-01"), ("9", "u0", "2022-01-01"), (None, "u7", "2022-05-01")]
    df = spark.createDataFrame(rows, "CO_CNES string, CO_UNIDADE string, data_competencia string")
    out = {r["CO_CNES"]: r for r in dedup.latest_per_key(df, "CO_CNES").collect()}
    assert out["9"]["CO_UNIDADE"] == "u1"
    assert (out["9"]["data_primeiro_registro"], out["9"]["data_ultimo_registro"]) == ("2022-01-01", "2022-12-01")
    assert set(out) == {"9"}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group share one value."""
    rng = random.Random(1)
    rows = [(i, "hot", 5.0) for i in range(300)]
    rows += [(300 + i, rng.choice(["hot", "b", None]), rng.choice([None, -0.0, 0.0, rng.gauss(0, 9), float(rng.randrange(9))])) for i in range(600)]
    return spark.createDataFrame(rows, "id int, g string, v double"), pd.DataFrame(rows, columns=["id", "g", "v"])


def test_quantiles_match_pandas(skewed):
    df, local = skewed
    placed = positions(value_counts(df, ["g"], "v"), ["g"], "v", buckets=5)
    got = {r["g"]: r for r in quantiles(placed, ["g"], "v", {"a": 0.1, "m": 0.5, "z": 1.0}).collect()}
    for group, part in local.groupby("g", dropna=False):
        name = None if pd.isna(group) else group
        for column, prob in (("a", 0.1), ("m", 0.5), ("z", 1.0)):
            assert math.isclose(got[name][column], part["v"].quantile(prob), abs_tol=1e-9)


def test_ranks_match_pandas(skewed):
    df, local = skewed
    want = local.groupby("g", dropna=False)["v"].rank(method="min", ascending=False, na_option="bottom")
    got = ranked(df, ["g"], "v").toPandas().sort_values("id")
    assert got["rank"].tolist() == want.astype(int).tolist()


def test_kruskal_undefined_and_invariant(spark):
    rng = random.Random(2)
    rows = [(c, rng.gauss(c, 2), float(rng.randrange(4)), 1.0, None if c == 2 else rng.random()) for c in (-1, 0, 1, 2) for _ in range(30)]
    df = spark.createDataFrame(rows, "cluster int, a double, b double, flat double, holes double")
    df = df.withColumn("a_cubed", F.pow("a", F.lit(3)))
    got = {r["feature"]: r for r in stats.kruskal_wallis(df, ["a", "a_cubed", "b", "flat", "holes"]).collect()}
    assert got["flat"]["H"] is None and got["holes"]["p_value"] is None
    assert math.isclose(got["a"]["H"], got["a_cubed"]["H"])
    local = pd.DataFrame(rows, columns=["c", "a", "b", "f", "h"])
    for name in ("a", "b"):
        ranks, n = local[name].rank(), len(local)
        between = sum(r.sum() ** 2 / len(r) for _, r in ranks.groupby(local["c"]))
        ties = local[name].value_counts()
        h = (12 / (n * (n + 1)) * between - 3 * (n + 1)) / (1 - (ties**3 - ties).sum() / (n**3 - n))
        assert math.isclose(got[name]["H"], h, rel_tol=1e-9)
        assert math.isclose(got[name]["eta2_approx"], h / (n - 1), rel_tol=1e-9)
        x = h / 2  # three degrees of freedom
        assert math.isclose(got[name]["p_value"], math.erfc(x**0.5) + 2 * (x / math.pi) ** 0.5 * math.exp(-x), rel_tol=1e-9)


def test_standardize_and_filters(spark):
    df = spark.range(50).select("id", F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + 1).alias("b"),
                                (F.col("id") % 7).cast("double").alias("c"), F.lit(4.0).alias("k"))
    names = ["a", "b", "c", "k"]
    scaled = features.standardize(df, names)
    spread = features.moments(scaled, names)
    assert all(abs(m) < 1e-12 for m, _ in spread.values())
    assert [round(v, 9) for _, v in spread.values()] == [1.0, 1.0, 1.0, 0.0]
    assert features.variance_filter(scaled, names) == ["a", "b", "c"]
    assert features.correlation_filter(scaled, ["a", "b", "c"]) == (["a", "c"], ["b"])


def _brute(points, keys, eps, min_samples, min_size):
    near = [[j for j, q in enumerate(points) if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for p in points]
    core = [len(n) >= min_samples for n in near]
    part = [None] * len(points)
    for start in range(len(points)):
        if core[start] and part[start] is None:
            part[start], queue = start, [start]
            while queue:
                for j in near[queue.pop()]:
                    if core[j] and part[j] is None:
                        part[j] = start
                        queue.append(j)
    groups = {}
    for i, p in enumerate(part):
        if p is not None:
            groups.setdefault(p, []).append(i)
    kept = sorted((g for g in groups.values() if len(g) >= min_size), key=lambda g: min(keys[i] for i in g))
    labels = [-1] * len(points)
    for number, group in enumerate(kept):
        for i in group:
            labels[i] = number
    return labels


def test_density_clusters_match_brute_force(spark):
    rng = random.Random(3)
    points = [(rng.gauss(cx, s), rng.gauss(cy, s)) for cx, cy, s in ((0, 0, 0.3), (3, 1, 0.8), (-3, 2, 0.05)) for _ in range(120)]
    points += [(1.5, -2.0)] * 180 + [(rng.uniform(-6, 6), rng.uniform(-6, 6)) for _ in range(100)]
    keys = rng.sample(range(10_000), len(points))
    df = spark.createDataFrame([(k, *p) for k, p in zip(keys, points)], "key long, x double, y double")
    eps = 0.35
    first = clustering.density_clusters(df, "key", "x", "y", 8, 30, eps)
    got = {r["key"]: r["cluster"] for r in first.collect()}
    want = _brute(points, keys, eps, 8, 30)
    assert [got[k] for k in keys] == want and len(set(want)) > 3

    again = clustering.recluster_noise(first, "key", ["x", "y"], 4, 8, 0.9, reproject=False)
    second = {r["key"]: r["cluster"] for r in again.collect()}
    assert all(second[k] == got[k] for k in keys if got[k] != -1)
    noise = [i for i, label in enumerate(want) if label == -1]
    inner = _brute([points[i] for i in noise], [keys[i] for i in noise], 0.9, 4, 8)
    assert [second[keys[i]] for i in noise] == [label + max(want) + 1 if label != -1 else -1 for label in inner]


def test_density_radius_keeps_its_promise(spark):
    rng = random.Random(4)
    points = [(rng.gauss(0, 1), rng.gauss(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(points, "x double, y double")
    eps = clustering.density_radius(df, "x", "y", 10, 0.5)
    core = sum(sum((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps for q in points) >= 10 for p in points)
    assert core >= 200


def test_alignment_is_one_to_one(spark):
    rows = [(0, 1)] * 5 + [(1, 1)] * 4 + [(1, 0)] * 2 + [(-1, 2)] * 3 + [(0, 3)]
    df = spark.createDataFrame(rows, "cluster int, label int")
    pairs = clustering.label_pairs(df, "cluster", "label")
    assert {r["label"]: r["cluster"] for r in pairs.collect()} == {1: 0, 2: -1, 0: 1}
    aligned = {(r["label"], r["aligned"]) for r in clustering.align_labels(df, "cluster", "label").collect()}
    assert aligned == {(1, 0), (2, -1), (0, 1), (3, 3)}
    many = spark.range(12000).select(F.col("id").cast("int").alias("label"), (-F.col("id") - 5).cast("int").alias("cluster"))
    assert clustering.align_labels(many, "cluster", "label").where("aligned = cluster").count() == 12000
    assert clustering.align_labels(df.limit(0), "cluster", "label").count() == 0
    assert clustering.silhouette(df.withColumn("one", F.lit(0)), ["label"], "one") is None


def test_joins_check_their_keys(spark):
    with pytest.raises(ValueError):
        joins.join_admissions(spark.range(1), spark.range(1))
    with pytest.raises(ValueError):
        joins.check_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_pivot_totals_and_unknown(spark):
    rows = [("m1", "A"), ("m1", "A"), ("m1", None), ("m2", "B"), (None, "A")]
    df = spark.createDataFrame(rows, "m string, t string")
    dynamic = {r["m"]: r.asDict() for r in agg.pivot_dynamic(df, ["m"], "t").collect()}
    assert dynamic["m1"] == {"m": "m1", "A": 2, "B": None, "DESCONHECIDO": 1}
    fixed = {r["m"]: r.asDict() for r in agg.pivot_fixed(df, ["m"], "t", values=["A", 'B"x', "B"]).collect()}
    assert fixed["m2"] == {"m": "m2", "A": None, 'B"x': None, "B": 1} and fixed[None]["A"] == 1


def test_state_tables(spark):
    rows = [(f"{i}", uf, 10.0, 0.5) for i, uf in enumerate("AABCDEFFF")]
    df = spark.createDataFrame(rows, "codigo_municipio string, uf string, populacao double, idh double")
    assert [r["uf"] for r in serving.state_table(df).collect()] == ["F", "A", "B", "C", "D"]
    assert [r["uf"] for r in serving.state_table(df, alphabetical=True).collect()] == ["A", "B", "C", "D", "E"]
    assert tuple(serving.key_figures(df).first()) == (9, 6, 90.0, 0.5)
