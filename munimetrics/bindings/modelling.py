"""Feature preparation, statistics and clustering over features of parts, customers and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.bindings import standins as roles
from munimetrics.bindings.registry import bound, table
from munimetrics.bindings.standins import FEATURES, FEATURES_SQL
from munimetrics.operators import assignment, clustering, features, hierarchy, layout, sketches, stats
from munimetrics.operators import silhouette as silhouettes
from munimetrics.operators.ordering import positions
from munimetrics.session import cut_lineage


def _long(columns: list[str], label: str, source: str = "features") -> str:
    parts = [f"SELECT {label} AS label, '{c}' AS feature, {c} AS value FROM {source}" for c in columns]
    return "long AS (" + " UNION ALL ".join(parts) + ")"


def _z(column: str) -> str:
    return f"coalesce(({column} - avg({column}) OVER ()) / nullif(stddev_pop({column}) OVER (), 0), 0)"


@bound(
    "standardize",
    f"""WITH {FEATURES_SQL} SELECT p_partkey, {', '.join(f'round({_z(c)}, 6) AS {c}' for c in FEATURES)},
  CAST(0 AS DOUBLE) AS constant FROM features""",
)
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    source = roles.part_features(spark, folder).drop("p_type").withColumn("constant", F.lit(7.0))
    scaled = features.standardize(source, [*FEATURES, "constant"])
    return scaled.select("p_partkey", "constant", *[F.round(c, 6).alias(c) for c in FEATURES])


@bound(
    "variance_filter",
    f"""WITH {FEATURES_SQL}, {_long(FEATURES, 'p_partkey')}
SELECT feature FROM long GROUP BY feature HAVING var_pop(value) > 0.05""",
)
def variance_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept = features.variance_filter(roles.part_features(spark, folder), FEATURES)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {i} AS i, {j} AS j, corr({a}, {b}) AS r FROM features"
    for i, a in enumerate(FEATURES)
    for j, b in enumerate(FEATURES)
)


@bound(
    "correlation_matrix",
    f"WITH {FEATURES_SQL}, pairs AS ({_PAIRS}) SELECT feature_a, feature_b, round(r, 6) AS correlation FROM pairs",
)
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    matrix = features.correlation_matrix(roles.part_features(spark, folder), FEATURES)
    return matrix.withColumn("correlation", F.round("correlation", 6))


@bound(
    "correlation_filter",
    f"""WITH {FEATURES_SQL}, pairs AS ({_PAIRS})
SELECT feature_b AS feature, coalesce(max(abs(r)) FILTER (WHERE i < j) > 0.9, FALSE) AS dropped FROM pairs GROUP BY feature_b""",
)
def correlation_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept, dropped = features.correlation_filter(roles.part_features(spark, folder), FEATURES, 0.9)
    rows = [(c, False) for c in kept] + [(c, True) for c in dropped]
    return spark.createDataFrame(rows, "feature string, dropped boolean")


_EMBEDDED = ["lines", "quantity", "price", "discount"]


def _power_iteration() -> str:
    """Leading two eigenvectors of the correlation matrix by repeated multiplication, then the scores."""
    n = range(len(_EMBEDDED))
    scores = ", ".join(f"{_z(c)} AS z{i}" for i, c in enumerate(_EMBEDDED))
    entries = ", ".join(f"avg(z{i} * z{j}) AS m{i}{j}" for i in n for j in n)

    def step(name: str, matrix: str) -> str:
        product = [" + ".join(f"m{i}{j} * v{j}" for j in n) for i in n]
        named = ", ".join(f"{p} AS w{i}" for i, p in enumerate(product))
        norm = "sqrt(" + " + ".join("w{0} * w{0}".format(i) for i in n) + ")"
        start = ", ".join(f"CAST({1.0 / (i + 2)} AS DOUBLE) AS v{i}" for i in n)
        unit = ", ".join(f"w{i} / {norm} AS v{i}" for i in n)
        return f"""{name}_steps AS (SELECT 0 AS step, {start} UNION ALL
  SELECT step + 1, {unit} FROM (SELECT step, {named} FROM {name}_steps, {matrix} WHERE step < 400)),
{name} AS (SELECT * FROM {name}_steps WHERE step = 400)"""

    value = " + ".join(f"v{i} * v{j} * m{i}{j}" for i in n for j in n)
    deflated = ", ".join(f"m{i}{j} - ({value}) * v{i} * v{j} AS m{i}{j}" for i in n for j in n)
    largest = "greatest(" + ", ".join(f"abs(v{i})" for i in n) + ")"
    sign = "CASE " + " ".join(f"WHEN abs(v{i}) = {largest} THEN sign(v{i})" for i in n) + " END"
    score = " + ".join(f"z{i} * v{i}" for i in n)
    return f"""WITH RECURSIVE {FEATURES_SQL}, scaled AS (SELECT p_partkey, {scores} FROM features),
moments AS (SELECT {entries} FROM scaled), {step('first', 'moments')},
rest AS (SELECT {deflated} FROM moments, first), {step('second', 'rest')}
SELECT p_partkey, round((SELECT {sign} FROM first) * ({score.replace('v', 'a.v')}), 4) AS umap_x,
  round((SELECT {sign} FROM second) * ({score.replace('v', 'b.v')}), 4) AS umap_y
FROM scaled, first a, second b"""


@bound("embed_2d", _power_iteration())
def embed_2d(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.standardize(roles.part_features(spark, folder), _EMBEDDED)
    placed = features.project(scaled, _EMBEDDED)
    return placed.select("p_partkey", F.round("umap_x", 4).alias("umap_x"), F.round("umap_y", 4).alias("umap_y"))


# Whole-number coordinates: the distances in both engines are exact.
def _plane(spark: SparkSession, folder: str) -> DataFrame:
    return roles.part_features(spark, folder).select("p_partkey", F.col("quantity").alias("x"), (F.col("size") * 10).alias("y"))


_PLANE_SQL = f"{FEATURES_SQL}, plane AS MATERIALIZED (SELECT p_partkey AS id, quantity AS x, size * 10 AS y FROM features)"


def _density_sql(name: str, source: str, eps: float, min_samples: int, min_size: int) -> str:
    near = f"(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {eps * eps}"
    return f"""{name}_core AS MATERIALIZED (SELECT a.id, a.x, a.y FROM {source} a JOIN {source} b ON {near}
  GROUP BY a.id, a.x, a.y HAVING count(*) >= {min_samples}),
{name}_edge AS MATERIALIZED (SELECT a.id AS s, b.id AS t FROM {name}_core a JOIN {name}_core b ON {near}),
{name}_reach AS (SELECT id, id AS low FROM {name}_core UNION
  SELECT t, min(low) FROM {name}_reach JOIN {name}_edge ON s = id GROUP BY t),
{name}_part AS MATERIALIZED (SELECT id, min(low) AS low FROM {name}_reach GROUP BY id),
{name}_number AS (SELECT low, row_number() OVER (ORDER BY low) - 1 AS number
  FROM (SELECT low FROM {name}_part GROUP BY low HAVING count(*) >= {min_size})),
{name} AS MATERIALIZED (SELECT p.id, p.x, p.y, CAST(coalesce(number, -1) AS INTEGER) AS cluster
  FROM {source} p LEFT JOIN {name}_part USING (id) LEFT JOIN {name}_number USING (low))"""


_FIRST = dict(eps=26.0, min_samples=20, min_size=15)
_SECOND = dict(eps=32.0, min_samples=16, min_size=12)


@bound(
    "density_cluster",
    f"WITH RECURSIVE {_PLANE_SQL}, {_density_sql('first', 'plane', **_FIRST)} SELECT id AS p_partkey, cluster FROM first",
)
def density_cluster(spark: SparkSession, folder: str) -> DataFrame:
    plane = _plane(spark, folder)
    found = clustering.density_clusters(
        plane, "p_partkey", "x", "y", _FIRST["min_samples"], _FIRST["min_size"], _FIRST["eps"]
    )
    return found.select("p_partkey", "cluster")


@bound(
    "recluster_noise",
    f"""WITH RECURSIVE {_PLANE_SQL}, {_density_sql('first', 'plane', **_FIRST)},
noise AS MATERIALIZED (SELECT id, x, y FROM first WHERE cluster = -1), {_density_sql('second', 'noise', **_SECOND)}
SELECT f.id AS p_partkey, CAST(CASE WHEN f.cluster = -1 AND s.cluster <> -1
  THEN s.cluster + (SELECT max(cluster) + 1 FROM first) ELSE f.cluster END AS INTEGER) AS cluster
FROM first f LEFT JOIN second s ON s.id = f.id""",
)
def recluster_noise(spark: SparkSession, folder: str) -> DataFrame:
    first = cut_lineage(
        clustering.density_clusters(
            _plane(spark, folder), "p_partkey", "x", "y", _FIRST["min_samples"], _FIRST["min_size"], _FIRST["eps"]
        )
    )
    again = clustering.recluster_noise(
        first, "p_partkey", ["x", "y"], _SECOND["min_samples"], _SECOND["min_size"], _SECOND["eps"], reproject=False
    )
    return again.select("p_partkey", "cluster")


@bound("density_hierarchy")
def density_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    found = hierarchy.hierarchy_clusters(_plane(spark, folder), "p_partkey", "x", "y", 20, 30)
    return found.select("p_partkey", "cluster")


@bound("two_stage_clusters")
def two_stage_clusters(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.standardize(roles.part_features(spark, folder).drop("p_type"), FEATURES)
    found = clustering.two_stage_clusters(scaled, "p_partkey", FEATURES)
    return found.select("p_partkey", "umap_x", "umap_y", "cluster")


@bound("kmeans_best_of")
def kmeans_best_of(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.standardize(roles.part_features(spark, folder), FEATURES)
    return clustering.kmeans_best_of(scaled, "p_partkey", FEATURES)


@bound("hierarchical_cluster")
def hierarchical_cluster(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.standardize(roles.part_features(spark, folder), FEATURES)
    return clustering.hierarchical_clusters(scaled, "p_partkey", FEATURES)


# Segments so far apart that one partition into five is best; numbered by smallest key, it can be told in SQL.
_SEPARATED_SQL = """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY lowest) - 1 AS INTEGER) AS label
FROM (SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_mktsegment) AS lowest FROM customer)"""


def _separated(spark: SparkSession, folder: str, spread: int) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(s) for s in roles.SEGMENTS]), F.col("c_mktsegment"))
    rows = table(spark, folder, "customer").select(
        "c_custkey", (place * 1000.0 + F.col("c_custkey") % 10 * spread).alias("x"),
        (place * place * 500.0 + F.col("c_nationkey") * spread).alias("y"),
    )
    return features.standardize(rows, ["x", "y"])


def _numbered(labels: DataFrame, key: str) -> DataFrame:
    """Labels from 0 by their smallest key."""
    lowest = labels.groupBy("label").agg(F.min(key).alias("lowest"), F.lit(1).alias("n"))
    numbers = positions(lowest, [], "lowest").select("label", F.col("before").cast("int").alias("number"))
    return labels.join(numbers, "label").select(key, F.col("number").alias("label"))


@bound("kmeans_separated", _SEPARATED_SQL)
def kmeans_separated(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(clustering.kmeans_best_of(_separated(spark, folder, 1), "c_custkey", ["x", "y"]), "c_custkey")


@bound("hierarchical_separated", _SEPARATED_SQL)
def hierarchical_separated(spark: SparkSession, folder: str) -> DataFrame:
    found = clustering.hierarchical_clusters(_separated(spark, folder, 0), "c_custkey", ["x", "y"])
    return _numbered(found, "c_custkey")


@bound(
    "silhouette",
    """WITH e AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
norm AS (SELECT vec_id, label, sum(v * v) AS q FROM e GROUP BY ALL),
total AS (SELECT label, count(*) AS n, sum(q) AS q FROM norm GROUP BY label),
centre AS (SELECT label, d, sum(v) AS s FROM e GROUP BY label, d),
dot AS (SELECT e.vec_id, c.label, sum(e.v * c.s) AS p FROM e JOIN centre c ON c.d = e.d GROUP BY ALL),
far AS (SELECT norm.vec_id, norm.label AS own, t.label, t.n, norm.q + t.q / t.n - 2 * dot.p / t.n AS away
  FROM norm JOIN dot ON dot.vec_id = norm.vec_id JOIN total t ON t.label = dot.label),
sides AS (SELECT vec_id, max(n) FILTER (WHERE label = own) AS n, max(away * n / nullif(n - 1, 0)) FILTER (WHERE label = own) AS a,
  min(away) FILTER (WHERE label <> own) AS b FROM far GROUP BY vec_id)
SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides""",
)
def silhouette(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    names = [f"e{i}" for i in range(64)]
    wide = vectors.select("label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)])
    return spark.createDataFrame([(clustering.silhouette(wide, names, "label"),)], "silhouette double").select(
        F.round("silhouette", 6).alias("silhouette")
    )


@bound(
    "silhouette_euclidean",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
mean AS (SELECT a.vec_id, a.label AS own, b.label, sum(list_distance(a.v, b.v)) AS s, count(*) AS n FROM e a, e b GROUP BY ALL),
sides AS (SELECT vec_id, max(n) FILTER (WHERE label = own) AS n, max(s / nullif(n - 1, 0)) FILTER (WHERE label = own) AS a,
  min(s / n) FILTER (WHERE label <> own) AS b FROM mean GROUP BY vec_id)
SELECT round(avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides""",
)
def silhouette_euclidean(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("row"))
    found = silhouettes.euclidean_silhouette(rows)
    return spark.range(1).select(F.round(F.lit(found["mean"]), 6).alias("silhouette"))


@bound(
    "quartiles_by_month",
    """SELECT event_type, round(quantile_cont(value, 0.25), 9) AS q1, round(quantile_cont(value, 0.5), 9) AS median,
  round(quantile_cont(value, 0.75), 9) AS q3 FROM events WHERE value IS NOT NULL GROUP BY event_type""",
)
def quartiles_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles over all months, cut out by sketches that were kept per month."""
    events = table(spark, folder, "events").withColumn("month", F.date_format("ts", "yyyy-MM"))
    monthly = cut_lineage(sketches.value_sketches(events, ["event_type", "month"], "value"))
    merged = sketches.merge_sketches(monthly, ["event_type"])
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = sketches.sketched_quantiles(events, ["event_type"], "value", probs, merged)
    return found.select("event_type", *[F.round(c, 9).alias(c) for c in probs])


@bound("neighbour_layout")
def neighbour_layout(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.standardize(roles.part_features(spark, folder).drop("p_type"), FEATURES)
    return layout.neighbour_layout(scaled, "p_partkey", FEATURES).select("p_partkey", "umap_x", "umap_y")


@bound(
    "align_labels",
    """WITH RECURSIVE labelled AS (SELECT c_custkey, c_nationkey % 5 AS cluster, ascii(c_mktsegment) % 7 AS label FROM customer),
pairs AS (SELECT cluster, label, row_number() OVER (ORDER BY n DESC, cluster, label) AS rk
  FROM (SELECT cluster, label, count(*) AS n FROM labelled GROUP BY ALL)),
picked AS (SELECT rk, cluster, label, [cluster] AS clusters, [label] AS labels FROM pairs WHERE rk = 1
  UNION ALL SELECT p.rk, p.cluster, p.label, list_append(k.clusters, p.cluster), list_append(k.labels, p.label)
  FROM picked k JOIN pairs p ON p.rk > k.rk AND NOT list_contains(k.clusters, p.cluster) AND NOT list_contains(k.labels, p.label)
    AND NOT EXISTS (SELECT 1 FROM pairs o WHERE o.rk > k.rk AND o.rk < p.rk
      AND NOT list_contains(k.clusters, o.cluster) AND NOT list_contains(k.labels, o.label)))
SELECT c_custkey, CAST(labelled.label AS INTEGER) AS label, CAST(coalesce(picked.cluster, labelled.label) AS INTEGER) AS aligned
FROM labelled LEFT JOIN picked ON picked.label = labelled.label""",
)
def align_labels(spark: SparkSession, folder: str) -> DataFrame:
    labelled = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_nationkey") % 5).alias("cluster"), (F.ascii("c_mktsegment") % 7).alias("label")
    )
    return clustering.align_labels(labelled, "cluster", "label").select("c_custkey", "label", "aligned")


@bound(
    "label_assignment",
    """WITH RECURSIVE pairs AS (SELECT c_nationkey % 5 AS cluster, ascii(c_mktsegment) % 7 AS label, count(*) AS n FROM customer GROUP BY ALL),
tried AS (SELECT -1 AS cluster, CAST(0 AS BIGINT) AS used, CAST(0 AS BIGINT) AS total
  UNION ALL SELECT t.cluster + 1, t.used | coalesce(1 << p.label, 0), CAST(t.total + coalesce(p.n, 0) AS BIGINT)
  FROM tried t JOIN (SELECT * FROM pairs UNION ALL SELECT c, NULL, 0 FROM range(5) AS r(c)) p
    ON p.cluster = t.cluster + 1 AND (p.label IS NULL OR t.used & (1 << p.label) = 0))
SELECT max(total) AS total FROM tried WHERE cluster = 4""",
)
def label_assignment(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that the best one-to-one assignment of two labellings puts under equal names."""
    labelled = table(spark, folder, "customer").select(
        (F.col("c_nationkey") % 5).alias("cluster"), (F.ascii("c_mktsegment") % 7).alias("label")
    )
    pairs = assignment.best_label_pairs(labelled, "cluster", "label")
    return labelled.join(pairs, ["cluster", "label"], "left_semi").agg(F.count(F.lit(1)).alias("total"))


@bound(
    "cluster_profile",
    f"""WITH {FEATURES_SQL}, {_long(FEATURES, 'p_type')}
SELECT label AS p_type, feature, round_even(avg(value), 3) AS mean, round_even(quantile_cont(value, 0.5), 3) AS median,
  round_even(stddev_pop(value), 3) AS std FROM long GROUP BY ALL""",
)
def cluster_profile(spark: SparkSession, folder: str) -> DataFrame:
    return stats.cluster_profile(roles.part_features(spark, folder), FEATURES, "p_type")


@bound(
    "box_stats",
    f"""WITH {FEATURES_SQL}, {_long(FEATURES, 'p_type')},
box AS (SELECT label, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL)
SELECT label AS p_type, feature, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  CAST(count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
FROM long JOIN box USING (label, feature) GROUP BY label, feature""",
)
def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    boxes = stats.box_stats(roles.part_features(spark, folder), FEATURES, "p_type")
    return boxes.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")})


@bound(
    "median_vs_national",
    f"""WITH {FEATURES_SQL}, {_long(FEATURES, 'p_type')},
per AS (SELECT label, feature, quantile_cont(value, 0.5) AS median FROM long GROUP BY ALL),
overall AS (SELECT feature, quantile_cont(value, 0.5) AS median_all FROM long GROUP BY feature)
SELECT label AS p_type, feature, round(median, 6) AS median, round(median_all, 6) AS median_all,
  round(median / nullif(median_all, 0), 6) AS ratio FROM per JOIN overall USING (feature)""",
)
def median_vs_national(spark: SparkSession, folder: str) -> DataFrame:
    medians = stats.median_against_all(roles.part_features(spark, folder), FEATURES, "p_type")
    return medians.withColumns({c: F.round(c, 6) for c in ("median", "median_all", "ratio")})


@bound(
    "descriptive_statistics",
    f"""WITH {FEATURES_SQL}, {_long(FEATURES, 'p_type')}
SELECT feature, CAST(count(value) AS BIGINT) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 6) AS q1,
  round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3 FROM long GROUP BY feature""",
)
def descriptive_statistics(spark: SparkSession, folder: str) -> DataFrame:
    summary = stats.describe(roles.part_features(spark, folder), FEATURES)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "std", "min", "max", "q1", "median", "q3")})


_TESTED = ["o_totalprice", "thousands", "constant"]


@bound(
    "kruskal_wallis",
    f"""WITH source AS (SELECT o_orderpriority, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS o_totalprice,
  CAST(floor(o_totalprice / 1000) AS DOUBLE) AS thousands, CAST(3 AS DOUBLE) AS constant FROM orders),
{_long(_TESTED, 'o_orderpriority', 'source')},
ranked AS (SELECT label, feature, value, rank() OVER (PARTITION BY feature ORDER BY value)
    + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS r,
    count(*) OVER (PARTITION BY feature, value) AS ties FROM long WHERE value IS NOT NULL),
sums AS (SELECT feature, label, sum(r) AS rs, count(*) AS n, sum(ties * ties - 1) AS tied, min(value) < max(value) AS spread
  FROM ranked GROUP BY ALL),
test AS (SELECT feature, sum(n) AS n, sum(rs * rs / n) AS s, sum(tied) AS tied, bool_and(n >= 2 AND spread) AS ok FROM sums GROUP BY feature),
h AS (SELECT feature, n, CASE WHEN ok THEN (12.0 / (n * (n + 1.0)) * s - 3 * (n + 1)) / (1 - tied / (n * 1.0 * n * n - n)) END AS h FROM test)
SELECT feature, round(h, 6) AS H, round(exp(-h / 2) * (1 + h / 2), 6) AS p_value, round(h / (n - 1), 6) AS eta2_approx FROM h""",
)
def kruskal_wallis(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    source = table(spark, folder, "orders").select(
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 10 != 0, price).alias("o_totalprice"),
        F.floor(price / 1000).cast("double").alias("thousands"),
        F.lit(3.0).alias("constant"),
    )
    tested = stats.kruskal_wallis(source, _TESTED, "o_orderpriority")
    return tested.select("feature", *[F.round(c, 6).alias(c) for c in ("H", "p_value", "eta2_approx")])
