"""Clustering: density clusters with noise, k-means, Ward's tree, silhouette, label alignment."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics.operators.features import _VECTOR, assembled, project
from munimetrics.operators.ordering import positions
from munimetrics.operators.partitional import fit_kmeans, hashed_rows, kmeans_labels, ward_clusters
from munimetrics.session import cut_lineage

NOISE = -1
# Distinct coordinates of one grid cell that one task should meet at most.
SHARE_ROWS = 50_000
# Halvings of a span that the digits of a double tell apart.
FINEST_LEVEL = 48
# A cell is split into this many parts per axis when its box is too coarse to decide a distance.
SPLIT = 4


def density_radius(
    df: DataFrame, x: str, y: str, min_samples: int, dense_share: float = 0.5, levels: int = 16
) -> float:
    """Neighbourhood radius at which at least ``dense_share`` of the rows have ``min_samples`` rows around.

    Rows are counted on a grid that is halved ``levels`` times, and again as long as the finest grid still has
    enough rows that share a cell with ``min_samples`` rows: a far outlier does not coarsen it. The finest such
    grid decides, and its cell diagonal is the radius. All rows are counted.
    """
    known = _located(df, x, y)
    low_x, high_x, low_y, high_y = known.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    if low_x is None or max(high_x - low_x, high_y - low_y) == 0:
        return 1.0
    span, level = max(high_x - low_x, high_y - low_y), 0
    for finest in range(levels, FINEST_LEVEL + 1, levels):
        found = _densest_level(known, (x, y), (low_x, low_y), span, finest - levels, finest, min_samples, dense_share)
        level = max(level, found)
        if found < finest:
            break
    return span / 2**level * math.sqrt(2)


def _densest_level(
    known: DataFrame, axes: Sequence[str], lows: Sequence[float], span: float, first: int, finest: int, min_samples: int,
    dense_share: float,
) -> int:
    """The last level from ``first`` to ``finest`` on which enough rows share a cell with ``min_samples`` rows."""
    index = [
        F.floor((F.col(c) - F.lit(low)) / F.lit(span) * float(2**finest)).alias(i) for c, low, i in zip(axes, lows, "ij")
    ]
    counts = known.groupBy(*index).agg(F.count(F.lit(1)).alias("n"))
    pyramid = counts.withColumn("level", F.explode(F.sequence(F.lit(first), F.lit(finest))))
    step = F.pow(F.lit(2), F.lit(finest) - F.col("level"))
    cells = pyramid.groupBy("level", F.floor(F.col("i") / step), F.floor(F.col("j") / step)).agg(F.sum("n").alias("n"))
    shares = cells.groupBy("level").agg(
        (F.coalesce(F.sum(F.when(F.col("n") >= min_samples, F.col("n"))), F.lit(0)) / F.sum("n")).alias("dense")
    )
    return max((row["level"] for row in shares.collect() if row["dense"] >= dense_share), default=0)


def _located(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(
        F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))
    )


def _grid(x: str, y: str, side: float, level: int = 0) -> Column:
    """Grid cell of a coordinate; cells of level ``n + 1`` lie exactly inside cells of level ``n``."""
    scale = F.lit(float(SPLIT**level))
    return F.struct(
        F.floor(F.col(x) / F.lit(side) * scale).alias("i"), F.floor(F.col(y) / F.lit(side) * scale).alias("j")
    )


def _around(cell: Column, offsets: Sequence[tuple[int, int]]) -> Column:
    """The cells at the given offsets, one row each."""
    return F.explode(
        F.array(*[F.struct((cell["i"] + i).alias("i"), (cell["j"] + j).alias("j")) for i, j in offsets])
    )


def _boxes(points: DataFrame, *by: str) -> DataFrame:
    return points.groupBy(*by).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )


def _core_points(points: DataFrame, cells: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """Coordinates with at least ``min_samples`` rows within ``eps``.

    All rows of a cell are within ``eps`` of each other, so a cell with enough rows is core as it stands.
    Only the few coordinates of other cells are compared with their surroundings: fewer than
    ``min_samples`` of them per cell, however full the cells next to them are. Full cells are split into
    shares so that no task meets all of one.
    """
    sized = points.join(cells, "cell")
    dense = sized.where(F.col("n") >= min_samples)
    sparse = sized.where(F.col("n") < min_samples)
    reach = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
    probes = (
        sparse.select(F.col("x").alias("px"), F.col("y").alias("py"), _around(F.col("cell"), reach).alias("cell"))
        .join(cells.select("cell", "shares"), "cell")
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        .drop("shares")
    )
    targets = sized.withColumn("share", F.pmod(F.xxhash64("x", "y"), F.col("shares")).cast("int"))
    dx, dy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
    neighbours = (
        probes.join(targets.select("cell", "share", "x", "y", "w"), ["cell", "share"])
        .where(dx * dx + dy * dy <= F.lit(eps * eps))
        .groupBy("px", "py")
        .agg(F.sum("w").alias("near"))
        .where(F.col("near") >= min_samples)
        .select(F.col("px").alias("x"), F.col("py").alias("y"))
    )
    columns = points.columns
    return dense.select(*columns).unionByName(sparse.join(neighbours, ["x", "y"], "left_semi").select(*columns))


def _linked_cells(core: DataFrame, side: float, eps: float) -> DataFrame:
    """Pairs of cells that hold core points within ``eps`` of each other.

    Two full cells would make all pairs of their points. Instead the tight boxes around the points are
    compared: boxes wholly within ``eps`` link their cells, boxes wholly beyond it do not, and only
    undecided boxes are split into smaller ones. A box around one coordinate is always decided, so the
    loop ends with the exact answer.
    """
    ahead = [(i, j) for i in range(0, 3) for j in range(-2, 3) if (i, j) > (0, 0)]
    limit = F.lit(eps * eps)

    def gaps(near: bool) -> Column:
        total = F.lit(0.0)
        for low, high in (("x0", "x1"), ("y0", "y1")):
            a0, a1, b0, b1 = F.col(f"a.{low}"), F.col(f"a.{high}"), F.col(f"b.{low}"), F.col(f"b.{high}")
            gap = F.greatest(F.lit(0.0), b0 - a1, a0 - b1) if near else F.greatest(b1 - a0, a1 - b0)
            total = total + gap * gap
        return total

    def judged(pairs: DataFrame) -> DataFrame:
        close = pairs.where(gaps(near=True) <= limit)
        return cut_lineage(
            close.select("cell_a", "cell_b", "node_a", "node_b", (gaps(near=False) <= limit).alias("inside"))
        )

    boxes = _boxes(core, "cell")
    starts = boxes.select("cell", _around(F.col("cell"), ahead).alias("other"), "x0", "x1", "y0", "y1").alias("a")
    pairs = starts.join(boxes.alias("b"), F.col("a.other") == F.col("b.cell")).select(
        F.col("a.cell").alias("cell_a"),
        F.col("b.cell").alias("cell_b"),
        F.col("a.cell").alias("node_a"),
        F.col("b.cell").alias("node_b"),
        *[F.struct(*[F.col(f"{side_}.{c}") for c in ("x0", "x1", "y0", "y1")]).alias(side_) for side_ in ("a", "b")],
    )
    verdict, level, linked = judged(pairs), 0, None
    ends = ["cell_a", "cell_b"]
    while True:
        found = verdict.where("inside").select(*ends).distinct()
        linked = found if linked is None else linked.unionByName(found)
        undecided = verdict.where(~F.col("inside")).drop("inside").join(found, ends, "left_anti")
        if undecided.isEmpty():
            return linked
        level += 1
        involved = undecided.select(F.explode(F.array(*ends)).alias("cell")).distinct()
        inner = core.join(involved, "cell", "left_semi").select(
            "x", "y", _grid("x", "y", side, level - 1).alias("parent"), _grid("x", "y", side, level).alias("node")
        )
        children = _boxes(inner, "parent", "node")
        box = F.struct("x0", "x1", "y0", "y1")
        left = children.select(F.col("parent").alias("node_a"), F.col("node").alias("child_a"), box.alias("a"))
        right = children.select(F.col("parent").alias("node_b"), F.col("node").alias("child_b"), box.alias("b"))
        finer = undecided.join(left, "node_a").join(right, "node_b").drop("node_a", "node_b")
        verdict = judged(finer.withColumnsRenamed({"child_a": "node_a", "child_b": "node_b"}))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node of the component of each node: columns ``node`` and ``root``.

    Each round hooks every root to the smallest root next to its tree and then shortens the chains of
    roots to a quarter, so the number of rounds grows with the logarithm of the longest path.
    """
    both = edges.toDF("a", "b")
    both = cut_lineage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(nodes.toDF("node").withColumn("root", F.col("node")))
    while True:
        ends = both.join(labels, F.col("a") == F.col("node")).select("b", F.col("root").alias("reached"))
        best = ends.groupBy("b").agg(F.min("reached").alias("reached"))
        hooks = (
            labels.join(best, F.col("node") == F.col("b"))
            .where(F.col("reached") < F.col("root"))
            .groupBy("root")
            .agg(F.min("reached").alias("parent"))
        )
        hooks = cut_lineage(hooks)
        if hooks.isEmpty():
            return labels
        for _ in range(2):  # the hooks read once are joined three times; more steps double that each
            onward = hooks.select(F.col("root").alias("parent"), F.col("parent").alias("above"))
            hooks = hooks.join(onward, "parent", "left").select(
                "root", F.coalesce("above", "parent").alias("parent")
            )
        labels = cut_lineage(
            labels.join(hooks, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
        )


def density_clusters(
    df: DataFrame,
    key: str,
    x: str,
    y: str,
    min_samples: int = 29,
    min_cluster_size: int = 75,
    eps: float | None = None,
    name: str = "cluster",
) -> DataFrame:
    """Density clusters of 2-D points, noise ``-1``.

    A row is core if at least ``min_samples`` rows, itself counted, lie within ``eps``. Core rows within
    ``eps`` of each other share a cluster; clusters below ``min_cluster_size`` rows, and all other rows,
    are noise. Clusters are numbered from 0 by their smallest key (text keys that are no numbers: by
    hash). This is one density level of a density hierarchy, so labels are not those of a stability
    selection over all levels; ``eps`` defaults to ``density_radius``.
    """
    if eps is None:
        eps = density_radius(df, x, y, min_samples)
    # Slightly less than eps / sqrt(2): rounding cannot put two rows of a cell further apart than eps.
    side = eps / math.sqrt(2) * (1 - 1e-9)
    order = F.col(key)
    if dict(df.dtypes)[key] == "string":
        order = F.coalesce(order.try_cast("bigint"), F.xxhash64(order))
    located = _located(df, x, y).select(
        (F.col(x).cast("double") + F.lit(0.0)).alias("x"), (F.col(y).cast("double") + F.lit(0.0)).alias("y"), order.alias("first")
    )
    points = cut_lineage(
        located.groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("w"), F.min("first").alias("first"))
        .withColumn("cell", _grid("x", "y", side))
    )
    cells = points.groupBy("cell").agg(
        F.sum("w").alias("n"), F.ceil(F.count(F.lit(1)) / F.lit(SHARE_ROWS)).cast("int").alias("shares")
    )
    core = cut_lineage(_core_points(points, cells, eps, min_samples))
    labels = connected_components(core.select("cell").distinct(), _linked_cells(core, side, eps))
    labels = labels.withColumnRenamed("node", "cell")

    sizes = (
        core.groupBy("cell")
        .agg(F.sum("w").alias("rows"), F.min("first").alias("first"))
        .join(labels, "cell")
        .groupBy("root")
        .agg(F.sum("rows").alias("rows"), F.min("first").alias("first"))
        .where(F.col("rows") >= min_cluster_size)
        .withColumn("n", F.lit(1))
    )
    numbered = positions(sizes, [], "first").select("root", F.col("before").cast("int").alias(name))
    clusters = core.join(labels.join(numbered, "root"), "cell").select("x", "y", name)
    located_rows = df.withColumn("_x", F.col(x).cast("double") + F.lit(0.0)).withColumn(
        "_y", F.col(y).cast("double") + F.lit(0.0)
    )
    joined = located_rows.join(clusters.toDF("_x", "_y", name), ["_x", "_y"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(name, F.lit(NOISE)).alias(name))


def recluster_noise(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    min_samples: int = 20,
    min_cluster_size: int = 21,
    eps: float | None = None,
    name: str = "cluster",
    reproject: bool = True,
    cluster: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """Cluster the noise rows again, number the new clusters after the old ones, keep the rest as it is.

    ``features`` are projected to two dimensions over the noise rows alone; with ``reproject=False`` they
    are the two coordinates themselves. ``cluster`` is ``hierarchy.hierarchy_clusters`` or one of its kind, else one
    density level is used.
    """
    largest = df.agg(F.max(name)).first()[0]
    offset = (NOISE if largest is None else largest) + 1
    noise = df.where(F.col(name) == NOISE).select(key, *[F.col(f"`{c}`") for c in features])
    if noise.isEmpty():
        return df
    x, y = features[:2]
    if reproject:
        x, y = "_first", "_second"
        noise = cut_lineage(project(noise, features, (x, y)).select(key, x, y))
    if cluster is None:
        second = density_clusters(noise, key, x, y, min_samples, min_cluster_size, eps, "_again")
    else:
        second = cluster(noise, key, x, y, min_samples, min_cluster_size, "_again")
    found = second.where(F.col("_again") != NOISE).select(key, (F.col("_again") + offset).alias("_again"))
    merged = df.join(found, key, "left")
    return merged.withColumn(name, F.coalesce("_again", name)).select(*[F.col(f"`{c}`") for c in df.columns])


def two_stage_clusters(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    min_samples: int = 29,
    min_cluster_size: int = 75,
    names: Sequence[str] = ("umap_x", "umap_y"),
) -> DataFrame:
    """Project standardised features, cluster by density, then cluster the noise again on its own."""
    projected = cut_lineage(project(df, features, names))
    first = cut_lineage(density_clusters(projected, key, *names, min_samples, min_cluster_size))
    return recluster_noise(first, key, features)


def kmeans_best_of(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    k: int = 5,
    restarts: int = 20,
    seed: int = 42,
    name: str = "label",
    iterations: int = 300,
) -> DataFrame:
    """K-means with the lowest cost of several starts. Returns the key and the label.

    All starts share every pass over the rows; see ``partitional.fit_kmeans`` for the fit and what it reports.
    """
    rows = hashed_rows(df, key, features)
    fit = fit_kmeans(rows, k, restarts, seed, iterations)
    return rows.select(key, F.lit(0).alias(name)) if fit is None else kmeans_labels(rows, key, fit.centres, name)


def hierarchical_clusters(df: DataFrame, key: str, features: Sequence[str], k: int = 5, name: str = "label") -> DataFrame:
    """Ward's tree cut at ``k`` clusters; see ``partitional.ward_clusters``. Returns the key and the label."""
    return ward_clusters(df, key, features, k, name)


def silhouette(df: DataFrame, features: Sequence[str], label: str) -> float | None:
    """Mean silhouette with squared Euclidean distance; None where it is undefined (fewer than two labels)."""
    vectors = assembled(df, features, [label]).withColumn(label, F.col(label).cast("int"))
    if df.select(label).distinct().limit(2).count() < 2:
        return None
    evaluator = ClusteringEvaluator(featuresCol=_VECTOR, predictionCol=label, distanceMeasure="squaredEuclidean")
    return float(evaluator.evaluate(vectors))


def label_pairs(df: DataFrame, target: str, label: str) -> DataFrame:
    """One-to-one pairs ``(target, label)`` by overlap: the largest overlap is settled first.

    Overlaps are ordered by size, then by target and label. Each round settles every pair that comes first for
    its target and for its label alike, which are the pairs that settling one by one would choose, and takes
    both out. Null labels are not paired.
    """
    counted = df.where(F.col(target).isNotNull() & F.col(label).isNotNull()).groupBy(target, label)
    rank = F.struct((-F.col("_n")).alias("_n"), F.col(target), F.col(label)).alias("_rank")
    rest = cut_lineage(counted.agg(F.count(F.lit(1)).alias("_n")).select(target, label, rank))
    settled = None
    while not rest.isEmpty():
        first = [rest.groupBy(c).agg(F.min("_rank").alias(f"_first_{i}")) for i, c in enumerate((target, label))]
        both = (F.col("_rank") == F.col("_first_0")) & (F.col("_rank") == F.col("_first_1"))
        found = cut_lineage(rest.join(first[0], target).join(first[1], label).where(both).select(target, label))
        settled = found if settled is None else settled.unionByName(found)
        rest = rest.join(found.select(target), target, "left_anti").join(found.select(label), label, "left_anti")
        rest = cut_lineage(rest)
    return rest.select(target, label) if settled is None else settled


def align_labels(
    df: DataFrame, target: str, label: str, name: str = "aligned", pairs: DataFrame | None = None
) -> DataFrame:
    """Rename the labels after the target labels they overlap most; a label left over keeps its own name."""
    if pairs is None:
        pairs = label_pairs(df, target, label)
    renamed = pairs.select(F.col(label), F.col(target).cast("int").alias("_renamed"))
    joined = df.join(renamed, label, "left")
    aligned = F.coalesce("_renamed", F.col(label).cast("int")).alias(name)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], aligned)
