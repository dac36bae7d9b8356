"""Density hierarchy of 2-D points: spanning tree of mutual reachability, condensed tree, clusters chosen by stability.

No radius is given: two rows are as far apart as their distance and the distances to their ``min_samples``-th other
rows say, whichever is largest. The tree of least such distances comes from Boruvka rounds. In each, boxes of points are
compared from coarse to fine and only pairs of boxes that may hold a component's shortest way out are split further;
points are compared within pairs of the finest boxes alone. Edges are then joined from short to long, a bounded number
at a time, which gives the condensed tree and the stability of its clusters; the driver sees neither.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from munimetrics.operators.clustering import NOISE, _located
from munimetrics.operators.ordering import positions
from munimetrics.session import cut_lineage, share_package

#: Quarterings of both axes; the finest boxes have side 2^-24 of the span.
LEVELS = 12
#: Coordinates of a tile that is not the finest box.
TILE = 512
#: Edges that one task joins at a time.
EDGES = 1 << 21
#: Distances below this share of the span count as this share, so that stabilities stay finite.
_LEAST = 1e-12
_BLOCK = 1024

_BOX = ("x0", "x1", "y0", "y1")


def _node(level: Column, i: Column, j: Column) -> Column:
    """Number of a box from its level and its place on the finest grid."""
    shift = (F.lit(2 * LEVELS) - level * 2).cast("int")
    part = [F.call_function("shiftright", c.cast("bigint"), shift) for c in (i, j)]
    return F.shiftleft(level.cast("bigint"), 48).bitwiseOR(F.shiftleft(part[0], 24)).bitwiseOR(part[1])


def _tiled(points: DataFrame, low: tuple[float, float], span: float, tile: int) -> DataFrame:
    """Points with their tile: the largest box around them that has at most ``tile`` coordinates."""
    finest = 1 << (2 * LEVELS)
    place = [
        F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(span) * float(finest)), F.lit(finest - 1)).alias(n) for c, lo, n in zip("xy", low, "ij")
    ]
    placed = cut_lineage(points.select("*", *place))
    cells = placed.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level")
    pyramid = cells.select("i", "j", "n", level).withColumn("node", _node(F.col("level"), F.col("i"), F.col("j")))
    fitting = pyramid.groupBy("node", "level").agg(F.sum("n").alias("size")).where((F.col("size") <= tile) | (F.col("level") == LEVELS))
    leaf = pyramid.join(fitting.select("node"), "node").groupBy("i", "j").agg(F.min(F.struct("level", "node")).alias("leaf"))
    return placed.join(leaf, ["i", "j"]).select(*points.columns, F.col("leaf.node").alias("tile"))


def _steps(leaves: DataFrame, totals: dict[str, Column]) -> tuple[DataFrame, int]:
    """Boxes by the box ``up`` that they are a part of, tiles also by themselves, and the number of levels."""
    level = F.shiftright("tile", 48)
    spread = leaves.withColumn("level", level).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("level").cast("int"))))
    mask = F.lit((1 << 24) - 1)
    shift = ((F.col("level") - F.col("at")) * 2).cast("int")

    def above(extra: int) -> Column:
        i, j = F.shiftright("tile", 24).bitwiseAND(mask), F.col("tile").bitwiseAND(mask)
        i, j = (F.call_function("shiftright", c, shift + extra) for c in (i, j))
        return F.shiftleft((F.col("at") - extra // 2).cast("bigint"), 48).bitwiseOR(F.shiftleft(i, 24)).bitwiseOR(j)

    boxes = spread.select("*", above(0).alias("node"), F.when(F.col("at") > 0, above(2)).alias("up"), (F.col("at") == F.col("level")).alias("leaf"))
    boxes = cut_lineage(boxes.groupBy("node", "up", "leaf").agg(*(c.alias(n) for n, c in totals.items())))
    columns = [*totals]
    steps = boxes.where("up is not null").select("up", "node", *columns).unionByName(
        boxes.where("leaf").select(F.col("node").alias("up"), "node", *columns)
    )
    return steps, int(leaves.agg(F.max(level)).first()[0] or 0)


_EXTENT = {"x0": F.min, "x1": F.max, "y0": F.min, "y1": F.max}


def _extent(own: bool) -> dict[str, Column]:
    """The box around points, or around boxes."""
    return {n: f(n if own else n[0]) for n, f in _EXTENT.items()}


def _paired(pairs: DataFrame, steps: DataFrame) -> DataFrame:
    """All pairs of the parts of both boxes, as structs ``a`` and ``b``, with the columns of ``pairs``."""
    inner = [c for c in steps.columns if c != "up"]
    for side in "ab":
        parts = steps.select(F.col("up").alias(side), F.struct(*inner).alias(f"to_{side}"))
        pairs = pairs.join(parts, side).drop(side).withColumnRenamed(f"to_{side}", side)
    return pairs


def _distance(near: bool) -> Column:
    """Least, or greatest, distance between the points of two boxes."""
    total = F.lit(0.0)
    for low, high in (("x0", "x1"), ("y0", "y1")):
        a0, a1, b0, b1 = F.col(f"a.{low}"), F.col(f"a.{high}"), F.col(f"b.{low}"), F.col(f"b.{high}")
        gap = F.greatest(F.lit(0.0), b0 - a1, a0 - b1) if near else F.greatest(b1 - a0, a1 - b0)
        total = total + gap * gap
    # Rounding must not hide a pair: bounds are a hair wide.
    return F.sqrt(total) * F.lit(1 - 1e-12 if near else 1 + 1e-12)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield {name: batch.column(k)[n] for k, name in enumerate(batch.schema.names)}


def _arrays(row: dict, names: Iterable[str]) -> list[np.ndarray]:
    return [row[n].values.to_numpy(zero_copy_only=False) for n in names]


def _tile_rows(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per tile with its points' columns as arrays, in order of the points' numbers."""
    packed = points.groupBy("tile").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("all"))
    return packed.select("tile", *(F.col(f"all.{c}").alias(c) for c in columns))


def core_distances(points: DataFrame, samples: int) -> DataFrame:
    """``points`` (``p, x, y, w, tile``) with ``core``, the distance within which ``samples`` other rows lie.

    Where there are fewer rows than that, the farthest one counts.
    """
    spark = points.sparkSession
    total = int(points.agg(F.sum("w")).first()[0])
    wanted = min(samples + 1, total)  # a row is among its own neighbours
    steps, depth = _steps(points.groupBy("tile").agg(*(c.alias(n) for n, c in _extent(False).items()), F.sum("w").alias("n")), _extent(True) | {"n": F.sum("n")})
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for _ in range(max(1, depth)):
        far = _paired(pairs, steps).select("a", "b", _distance(True).alias("gap"), _distance(False).alias("far"))
        # The nearest boxes that hold enough rows bound the distance to the wanted one for all points of a box.
        nearest = Window.partitionBy("a.node").orderBy("far", "b.node").rowsBetween(Window.unboundedPreceding, 0)
        reached = far.withColumn("held", F.sum("b.n").over(nearest))
        bound = F.min(F.when(F.col("held") >= wanted, F.col("far"))).over(Window.partitionBy("a.node"))
        kept = reached.withColumn("bound", bound).where(F.col("gap") <= F.col("bound"))
        pairs = cut_lineage(kept.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), "gap"))
    names = ["p", "x", "y", "w"]
    tiles = _tile_rows(points, names)
    near = pairs.join(tiles.withColumnRenamed("tile", "b"), "b")
    near = near.repartition("a").sortWithinPartitions("a", F.col("a") != F.col("b"), "gap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(_rows(batches), key=lambda r: r["a"].as_py()):
            rest = iter(group)
            own = _arrays(next(rest), names)  # the tile's pair with itself comes first
            found = _nearest(own, own, np.full((len(own[0]), wanted), np.inf))
            for row in rest:
                if row["gap"].as_py() <= found[:, -1].max():
                    found = _nearest(own, _arrays(row, names), found)
            yield pa.RecordBatch.from_arrays([pa.array(own[0]), pa.array(found[:, -1])], ["p", "core"])

    return points.join(near.mapInArrow(run, "p long, core double"), "p")


def _nearest(own: list[np.ndarray], other: list[np.ndarray], found: np.ndarray) -> np.ndarray:
    """The least distances ``found`` from each point so far, in order, with those to the rows of another tile."""
    wanted, (_, x, y, w) = found.shape[1], other
    out = found.copy()
    for start in range(0, len(own[0]), _BLOCK):
        part = slice(start, start + _BLOCK)
        gaps = np.hypot(own[1][part, None] - x[None], own[2][part, None] - y[None])
        merged = np.concatenate([out[part], np.repeat(gaps, np.minimum(w, wanted), 1)], 1)
        out[part] = np.sort(np.partition(merged, wanted - 1, 1)[:, :wanted], 1)
    return out


def _least_edges(a: list[np.ndarray], b: list[np.ndarray]) -> list[tuple[np.ndarray, ...]]:
    """Per component in tile ``a`` its shortest edge to another component in tile ``b``, ties to the smaller numbers.

    Points are ``p, x, y, core, comp`` in order of ``p``.
    """
    out = []
    for start in range(0, len(a[0]), _BLOCK):
        p, x, y, core, comp = (v[start : start + _BLOCK] for v in a)
        gaps = np.hypot(x[:, None] - b[1][None], y[:, None] - b[2][None])
        np.maximum(gaps, core[:, None], out=gaps)
        np.maximum(gaps, b[3][None], out=gaps)
        gaps[comp[:, None] == b[4][None]] = np.inf
        place = gaps.argmin(1)
        weight = gaps[np.arange(len(p)), place]
        low, high = np.minimum(p, b[0][place]), np.maximum(p, b[0][place])
        order = np.lexsort((high, low, weight, comp))
        first = order[np.flatnonzero(np.diff(comp[order], prepend=comp[order[0]] - 1))]
        first = first[np.isfinite(weight[first])]
        out.append((comp[first], weight[first], low[first], high[first], b[4][place[first]]))
    return out


def _roots(least: DataFrame) -> DataFrame:
    """``(comp, root)`` where every component points to one other along its shortest edge.

    Such pointers end in two components that point to each other, of which the smaller number is the root; chains are
    halved until all point to roots.
    """
    out = least.select("comp", F.col("other").alias("root"))
    back = out.select(F.col("comp").alias("root"), F.col("root").alias("back"))
    mutual = (F.col("back") == F.col("comp")) & (F.col("comp") < F.col("root"))
    out = cut_lineage(out.join(back, "root").select("comp", F.when(mutual, F.col("comp")).otherwise(F.col("root")).alias("root")))
    while True:
        for _ in range(2):
            above = out.select(F.col("comp").alias("root"), F.col("root").alias("above"))
            out = out.join(above, "root").select("comp", F.col("above").alias("root"))
        out = cut_lineage(out)
        above = out.select(F.col("comp").alias("root"), F.col("root").alias("above"))
        if out.join(above, "root").where("above <> root").isEmpty():
            return out


def spanning_tree(points: DataFrame) -> DataFrame:
    """Edges ``(weight, low, high)`` of the least spanning tree of ``points`` (``p, x, y, core, tile``) by mutual reachability.

    Every round takes each component's shortest edge to another one, equal lengths by the points' numbers, so that
    no two rounds of choices close a ring.
    """
    spark = points.sparkSession
    columns = ["p", "x", "y", "core", "comp"]
    state = cut_lineage(points.select("tile", "p", "x", "y", "core", F.col("p").alias("comp")))
    tree: DataFrame | None = None
    extra = {"c0": F.min("core"), "c1": F.max("core"), "k0": F.min("comp"), "k1": F.max("comp")}
    inner = {"c0": F.min("c0"), "c1": F.max("c1"), "k0": F.min("k0"), "k1": F.max("k1")}
    while True:
        leaves = state.groupBy("tile").agg(*(c.alias(n) for n, c in (_extent(False) | extra).items()))
        steps, depth = _steps(leaves, _extent(True) | inner)
        pairs = spark.createDataFrame([(0, 0, float("inf"))], "a long, b long, bound double")
        mixed_a, mixed_b = F.col("a.k0") != F.col("a.k1"), F.col("b.k0") != F.col("b.k1")
        for _ in range(max(1, depth)):
            both = _paired(pairs, steps).where(mixed_a | mixed_b | (F.col("a.k0") != F.col("b.k0")))
            low = F.greatest(_distance(True), F.col("a.c0"), F.col("b.c0"))
            high = F.greatest(_distance(False), F.col("a.c1"), F.col("b.c1"))
            # A box of one component shares the bound of that component, another one has its own.
            owner = F.struct(mixed_a.alias("mixed"), F.when(mixed_a, F.col("a.node")).otherwise(F.col("a.k0")).alias("of"))
            sure = F.when(mixed_b | ~mixed_a, high)
            judged = cut_lineage(
                both.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), "bound", low.alias("low"), sure.alias("high"), owner.alias("owner"))
            )
            bounds = judged.groupBy("owner").agg(F.min(F.least("bound", "high")).alias("most"))
            kept = judged.join(bounds, "owner").where(F.col("low") <= F.col("most"))
            pairs = cut_lineage(kept.select("a", "b", F.col("most").alias("bound")))
        tiles = _tile_rows(state, columns)
        left = tiles.select(F.col("tile").alias("a"), *(F.col(c).alias(f"a_{c}") for c in columns))
        right = tiles.select(F.col("tile").alias("b"), *(F.col(c).alias(f"b_{c}") for c in columns))
        met = pairs.select("a", "b").join(left, "a").join(right, "b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                for found in _least_edges(_arrays(row, [f"a_{c}" for c in columns]), _arrays(row, [f"b_{c}" for c in columns])):
                    yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["comp", "weight", "low", "high", "other"])

        least = met.mapInArrow(run, "comp long, weight double, low long, high long, other long")
        least = cut_lineage(least.groupBy("comp").agg(F.min(F.struct("weight", "low", "high", "other")).alias("e")).select("comp", "e.*"))
        if least.isEmpty():
            empty = spark.createDataFrame([], "weight double, low long, high long")
            return cut_lineage(tree) if tree is not None else empty
        edges = least.select("weight", "low", "high").distinct()
        tree = edges if tree is None else tree.unionByName(edges)
        state = cut_lineage(state.join(_roots(least), "comp").select("tile", "p", "x", "y", "core", F.col("root").alias("comp")))


class Condenser:
    """Joins components from short to long edges; edges of one length join at once, so their order is of no account.

    A component of at least ``least`` rows is a cluster. Where clusters meet they end and a new one begins; a smaller
    component that meets one falls to it. Stability adds up, over the rows of a cluster, by how much closer together they
    still held than where the cluster ends (``1 / distance``).
    """

    def __init__(self, least: int, floor: float, first: int):
        self.least, self.floor, self.next = least, floor, first
        self.up: dict[int, int] = {}
        self.state: dict[int, tuple[int, int | None, float, float]] = {}  # rows, cluster, sum of 1 / distance, best of parts
        self.loose: dict[int, list[int]] = {}  # components that are part of no cluster yet, by root
        self.given: dict[int, int] = {}  # the cluster that such a component fell to
        self.ended: list[tuple[int, int, bool]] = []

    def add(self, root: int, rows: int, cluster: int | None, held: float, best: float) -> None:
        self.up[root] = root
        self.state[root] = rows, cluster, held, best
        if cluster is None:
            self.loose[root] = [root]

    def find(self, root: int) -> int:
        while self.up[root] != root:
            self.up[root] = self.up[self.up[root]]
            root = self.up[root]
        return root

    def join(self, weight: float, edges: Iterable[tuple[int, int]]) -> None:
        parts: dict[int, list[int]] = {}
        for a, b in edges:
            a, b = self.find(a), self.find(b)
            if a == b:
                continue
            own, other = parts.pop(a, [a]), parts.pop(b, [b])
            if len(own) < len(other):
                a, b = b, a
            self.up[b] = a
            parts[a] = own + other
        for root, olds in parts.items():
            self._merge(root, olds, 1 / max(weight, self.floor))

    def _merge(self, root: int, olds: list[int], near: float) -> None:
        states = {r: self.state.pop(r) for r in olds}
        rows = sum(s[0] for s in states.values())
        small = [r for r, s in states.items() if s[1] is None]
        big = [s for s in states.values() if s[1] is not None]
        loose = [p for r in small for p in self.loose.pop(r)]
        if not big and rows < self.least:
            self.state[root] = rows, None, 0.0, 0.0
            self.loose[root] = loose
            return
        if len(big) == 1:
            _, cluster, held, best = big[0]
            held += near * sum(states[r][0] for r in small)
        else:
            cluster, held, best = self.next, rows * near, 0.0
            self.next += 1
            for size, old, sum_, inner in big:
                stability = sum_ - size * near
                self.ended.append((old, cluster, stability >= inner))
                best += max(stability, inner)
        self.given.update(dict.fromkeys(loose, cluster))
        self.state[root] = rows, cluster, held, best


def _condensed(tree: DataFrame, points: DataFrame, least: int, floor: float, limit: int) -> tuple[DataFrame, DataFrame]:
    """``(p, cluster)``, null for rows of no cluster, and the clusters ``(cluster, parent, chosen)``."""
    held = F.when(F.col("w") >= least, F.col("w") / F.greatest("core", F.lit(floor)))
    own = F.when(F.col("w") >= least, F.col("p"))
    labels = cut_lineage(points.select("p", F.col("p").alias("root"), own.alias("cluster")))
    states = cut_lineage(
        points.select(F.col("p").alias("root"), F.col("w").alias("rows"), own.alias("cluster"), F.coalesce(held, F.lit(0.0)).alias("held"), F.lit(0.0).alias("best"))
    )
    count = tree.count()
    shares = [k / -(-count // limit) for k in range(1, -(-count // limit))] if count > limit else []
    cuts = sorted(set(tree.approxQuantile("weight", shares, 1e-4))) if shares else []
    ended: DataFrame | None = None
    shape = "kind string, root long, onto long, cluster long, parent long, chosen boolean, rows long, held double, best double"
    for number, (low, high) in enumerate(zip([-1.0, *cuts], [*cuts, float("inf")])):
        edges = tree.where((F.col("weight") > low) & (F.col("weight") <= high))
        ends = edges.join(labels.select(F.col("p").alias("low"), F.col("root").alias("a")), "low")
        ends = ends.join(labels.select(F.col("p").alias("high"), F.col("root").alias("b")), "high").select("weight", "a", "b")
        touched = ends.select(F.explode(F.array("a", "b")).alias("root")).distinct().join(states, "root")
        flow = touched.select(F.lit(-1.0).alias("weight"), "root", F.lit(None).cast("long").alias("onto"), "rows", "cluster", "held", "best").unionByName(
            ends.select("weight", F.col("a").alias("root"), F.col("b").alias("onto"), *(F.lit(None).cast(k).alias(c) for c, k in (("rows", "long"), ("cluster", "long"), ("held", "double"), ("best", "double"))))
        )
        first = -((number + 1) << 42)

        def run(batches: Iterator[pa.RecordBatch], first: int = first) -> Iterator[pa.RecordBatch]:
            work = Condenser(least, floor, first)
            rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
            for weight, group in groupby(rows, key=lambda r: r[0]):
                if weight < 0:
                    for _, root, _, size, cluster, sum_, best in group:
                        work.add(root, size, cluster, sum_, best)
                else:
                    work.join(weight, ((r[1], r[2]) for r in group))
            out = [("moved", r, work.find(r), work.given.get(r), None, None, None, None, None) for r in list(work.up)]
            out += [("ended", None, None, c, parent, chosen, None, None, None) for c, parent, chosen in work.ended]
            out += [("state", r, None, s[1], None, None, s[0], s[2], s[3]) for r, s in work.state.items()]
            kinds = [pa.string(), *[pa.int64()] * 4, pa.bool_(), pa.int64(), pa.float64(), pa.float64()]
            names = [f.split()[0] for f in shape.split(", ")]
            for start in range(0, len(out), 100_000):
                columns = zip(*out[start : start + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        # One task joins this share of the edges, at most ``limit`` of different lengths.
        found = cut_lineage(flow.repartition(1).sortWithinPartitions("weight").mapInArrow(run, shape))
        moved = found.where("kind = 'moved'").select("root", "onto", F.col("cluster").alias("fell"))
        labels = cut_lineage(
            labels.join(moved, "root", "left").select("p", F.coalesce("onto", "root").alias("root"), F.coalesce("cluster", "fell").alias("cluster"))
        )
        fresh = found.where("kind = 'state'").select("root", "rows", "cluster", "held", "best")
        states = cut_lineage(states.join(moved.select("root"), "root", "left_anti").unionByName(fresh))
        new = found.where("kind = 'ended'").select("cluster", "parent", "chosen")
        ended = new if ended is None else cut_lineage(ended.unionByName(new))
    last = states.where("cluster is not null").select("cluster", F.lit(None).cast("long").alias("parent"), F.lit(False).alias("chosen"))
    return labels.select("p", "cluster"), ended.unionByName(last)


def _highest_chosen(clusters: DataFrame) -> DataFrame:
    """``(cluster, top)``: the highest chosen cluster above or at each one, null if there is none."""
    paths = cut_lineage(clusters.select("cluster", F.col("parent").alias("up"), F.when(F.col("chosen"), F.col("cluster")).alias("top")))
    while not paths.where("up is not null").isEmpty():
        above = paths.select(F.col("cluster").alias("up"), F.col("up").alias("further"), F.col("top").alias("higher"))
        paths = cut_lineage(paths.join(above, "up", "left").select("cluster", F.col("further").alias("up"), F.coalesce("higher", "top").alias("top")))
    return paths.select("cluster", "top")


def hierarchy_clusters(
    df: DataFrame, key: str, x: str, y: str, min_samples: int = 29, min_cluster_size: int = 75, name: str = "cluster",
    tile: int = TILE, edges: int = EDGES,
) -> DataFrame:
    """Clusters of 2-D points of any density, noise ``-1``.

    The rows' hierarchy by mutual reachability is condensed to clusters of at least ``min_cluster_size`` rows; of a
    cluster and the clusters inside it the more stable side is chosen, all rows together never. Rows without both
    coordinates are noise, equal coordinates count as often as they occur. Clusters are numbered from 0 by their smallest
    key (text keys that are no numbers: by hash). Edges of one length are joined at once, so that equal rows and equal
    distances have one result in any order.
    """
    if min_cluster_size < 2:
        raise ValueError("a cluster has two rows at least")
    share_package(df.sparkSession)
    order = F.col(key)
    if dict(df.dtypes)[key] == "string":
        order = F.coalesce(order.try_cast("bigint"), F.xxhash64(order))
    located = _located(df, x, y).select(
        (F.col(x).cast("double") + F.lit(0.0)).alias("x"), (F.col(y).cast("double") + F.lit(0.0)).alias("y"), order.alias("first")
    )
    points = located.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"), F.min("first").alias("first"))
    points = cut_lineage(points.withColumn("p", F.monotonically_increasing_id()))
    low_x, high_x, low_y, high_y, rows = points.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.sum("w")).first()
    columns = [F.col(f"`{c}`") for c in df.columns]
    if not rows or rows < min_cluster_size:
        return df.select(*columns, F.lit(NOISE).alias(name))
    span = max(high_x - low_x, high_y - low_y) or 1.0
    tiled = cut_lineage(_tiled(points, (low_x, low_y), span, tile))
    cored = cut_lineage(core_distances(tiled, min_samples))
    tree = spanning_tree(cored)
    members, clusters = _condensed(tree, cored, min_cluster_size, span * _LEAST, edges)
    chosen = _highest_chosen(clusters).where("top is not null")
    found = members.join(chosen, "cluster").select("p", "top").join(points, "p")
    found = cut_lineage(found.select("x", "y", "top", "first"))
    numbered = positions(found.groupBy("top").agg(F.min("first").alias("first")).withColumn("n", F.lit(1)), [], "first")
    labels = found.join(numbered.select("top", F.col("before").cast("int").alias(name)), "top").select("x", "y", name)
    keyed = df.withColumn("_x", F.col(x).cast("double") + F.lit(0.0)).withColumn("_y", F.col(y).cast("double") + F.lit(0.0))
    joined = keyed.join(labels.toDF("_x", "_y", name), ["_x", "_y"], "left")
    return joined.select(*columns, F.coalesce(name, F.lit(NOISE)).alias(name))
