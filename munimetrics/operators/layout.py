"""Two-dimensional layout that keeps neighbours together, from a neighbour graph found by trees and descent.

Each tree cuts the rows by random planes into groups, in which blocks of a bounded number of rows are compared; a row keeps
its nearest so far and carries them on to the next tree. A few rows compared with all others tell when that is enough; if
it is not, rounds follow that compare the neighbours of a row with each other. Positions start from principal components.
In each exchange every task takes a group of near rows, draws them towards their neighbours and away from a bounded sample
of all rows for some epochs, and hands the new positions on to the groups that hold neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from munimetrics.operators.features import _VECTOR, assembled, project
from munimetrics.session import cut_lineage, share_package

NEIGHBOURS = 15
#: Trees at most, and how often the rows of a group are cut into blocks anew in each.
TREES, CUTS = 12, 2
#: Rows that are compared with each other at most, and blocks of a group on average.
BLOCK, BLOCKS = 1024, 16
#: Rows from which the planes are chosen, for each group.
PLANE_ROWS = 128
#: Share of the neighbours to be found, as measured on some rows compared with all others.
GOAL, PROBES = 0.98, 200
ROUNDS = 8
#: Descent ends when a round finds fewer better neighbours than this share of the graph.
STILL = 0.002
EXCHANGES, EPOCHS = 8, 25
#: Rows that stand for all others when rows are pushed apart, and how many of them push at a time.
SAMPLE, PUSHES = 2000, 5
#: Rows that move together in one task, at most and at least on average, and groups that are enough below the most.
STRIP, LEAST_STRIP, STRIPS = 50_000, 4_000, 64
#: Shape of the curve ``1 / (1 + a d^2b)`` that equals 1 up to a distance of 0.1 and falls off behind it.
_A, _B = 1.577, 0.895

_GRAPH = "u long, v long, d double"
_STATE = "id long, row array<double>, v array<bigint>, d array<double>, part long"


def _found(u: list, v: list, d: list) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(c) if c else []) for c in (u, v, d)]
    return pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["u", "v", "d"])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Ids, rows and further columns of each group, from arrays of equal length."""
    for batch in batches:
        for n in range(batch.num_rows):
            own = [batch.column(k)[n].values for k in range(batch.num_columns)]
            ids = own[0].to_numpy()
            yield ids, own[1].flatten().to_numpy().reshape(len(ids), -1), *(c.to_numpy() for c in own[2:])


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().reshape(len(column), -1)


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Distances along the last axis; added up column by column, so that a pair has the same one wherever it is met."""
    square = (one[..., 0] - other[..., 0]) ** 2
    for n in range(1, one.shape[-1]):
        square = square + (one[..., n] - other[..., n]) ** 2
    return np.sqrt(square)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each row, ties to the smaller number."""
    order = Window.partitionBy("u").orderBy("d", "v")
    return cut_lineage(found.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n"))


def _plane(rows: np.ndarray, least: int, rng: np.random.Generator) -> tuple[np.ndarray, float] | None:
    """A plane between two of the rows that leaves at least ``least`` on both sides, in the middle if rows differ there."""
    for _ in range(8):
        one, other = rng.integers(0, len(rows), 2)
        normal = rows[one] - rows[other]
        side = rows @ normal
        cut = np.median(side)
        if (side > cut).sum() < least and (side < cut).any():
            cut = side[side < cut].max()
        if min((side > cut).sum(), (side <= cut).sum()) >= least:
            return normal, float(cut)
    return None


def _tree(sample: np.ndarray, count: int, size: int, least: int, rng: np.random.Generator) -> tuple[tuple, int]:
    """Planes that cut ``count`` rows like the sample into groups of about ``size``, and the number of groups.

    A leaf is its first group and how many it has: rows that no plane tells apart are dealt over several.
    """
    groups, least = 0, max(8, int(np.ceil(least * len(sample) / count)))

    def grow(at: np.ndarray) -> tuple:
        nonlocal groups
        here = len(at) * count / len(sample)
        plane = _plane(sample[at], least, rng) if here > size and len(at) >= 2 * least else None
        if plane is None:
            shares = max(1, int(here / size + 0.5))
            groups += shares
            return groups - shares, shares
        above = sample[at] @ plane[0] > plane[1]
        return *plane, grow(at[~above]), grow(at[above])

    return grow(np.arange(len(sample))), groups


def _routed(tree: tuple, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The group of each row."""
    out, rest = np.zeros(len(ids), np.int64), [(tree, np.arange(len(ids)))]
    dealt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    while rest:
        node, at = rest.pop()
        if len(node) == 2:
            out[at] = node[0] + (dealt[at] % np.uint64(node[1])).astype(np.int64)
        else:
            above = rows[at] @ node[0] > node[1]
            rest += [(node[2], at[~above]), (node[3], at[above])]
    return out


def _pieces(rows: np.ndarray, size: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Blocks of at most ``size`` rows, halved by planes."""
    rest = [np.arange(len(rows))]
    while rest:
        at = rest.pop()
        if len(at) <= size:
            yield at
            continue
        for _ in range(4):
            one, other = rng.integers(0, len(at), 2)
            normal = rows[at[one]] - rows[at[other]]
            if normal.any():
                break
        order, half = np.argpartition(rows[at] @ normal, len(at) // 2), len(at) // 2
        rest += [at[order[:half]], at[order[half:]]]


def _nearest(ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of about the ``k`` nearest others of each row of a block."""
    centred = rows - rows.mean(0)
    squares, most = (centred**2).sum(1), min(k, len(ids) - 1)
    near = np.zeros((len(ids), most), np.int64)
    for start in range(0, len(ids), 256):
        part = np.arange(start, min(start + 256, len(ids)))
        gaps = squares - 2 * centred[part] @ centred.T
        gaps[np.arange(len(part)), part] = np.inf
        near[part] = np.argpartition(gaps, most - 1, 1)[:, :most]
    return ids[near], _apart(rows[:, None], rows[near])


def _kept(v: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest of each line, each once, ties to the smaller number."""
    order = np.lexsort((v, d), axis=-1)
    v, d = np.take_along_axis(v, order, 1), np.take_along_axis(d, order, 1)
    again = np.zeros(v.shape, bool)
    again[:, 1:] = (v[:, 1:] == v[:, :-1]) & (v[:, 1:] >= 0)
    first = np.argsort(again, 1, kind="stable")[:, :k]
    return np.take_along_axis(v, first, 1), np.take_along_axis(d, first, 1)


def _grouped(tree: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds a row's group to ``(id, row)`` and further columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = _routed(tree, batch.column(0).to_numpy(), _matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], [*batch.schema.names, "part"])

    return run


def _farthest_true(rows: DataFrame, probes: dict[int, np.ndarray], k: int) -> dict[int, float]:
    """Distance of the ``k``-th nearest other of each probe, over all rows."""
    ids, spots = np.array(list(probes), np.int64), np.array(list(probes.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.full((len(ids), k), np.inf)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                gaps = _apart(spots[:, None], _matrix(part.column(1))[None])
                gaps[ids[:, None] == part.column(0).to_numpy()[None]] = np.inf
                held = np.partition(np.concatenate([held, gaps], 1), k - 1, 1)[:, :k]
        known = np.isfinite(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, k)[known.ravel()]), pa.array(held[known])], ["u", "d"])

    found = rows.select("id", "row").mapInArrow(run, "u long, d double").groupBy("u")
    return {r["u"]: r["d"] for r in found.agg(F.sort_array(F.collect_list("d"))[k - 1].alias("d")).collect()}


def neighbour_lists(
    rows: DataFrame, k: int = NEIGHBOURS, trees: int = TREES, block: int = BLOCK, rounds: int = ROUNDS, seed: int = 42, goal: float = GOAL
) -> DataFrame:
    """``(u, v, d)`` with arrays ``v`` and ``d``: about the ``k`` nearest others of each row of ``(id, row)`` by distance.

    Trees end when ``goal`` of the neighbours of the probes are found. Where ``trees`` are not enough for that, descent
    follows. Every row has ``k`` others, or as many as there are.
    """
    spark = rows.sparkSession
    share_package(spark)
    count = rows.count()
    if count < 2:
        return spark.createDataFrame([], "u long, v array<bigint>, d array<double>")
    most, block = min(k, count - 1), max(block, 2 * (k + 2))
    size, rng = block * BLOCKS, np.random.default_rng(seed)
    sampled = rows.orderBy(F.xxhash64("id", F.lit(seed))).limit(max(PROBES, PLANE_ROWS * -(-count // size))).toPandas()
    sample = np.array(sampled["row"].tolist(), float)
    probes = dict(zip(sampled["id"].tolist()[:PROBES], sample))
    truth = _farthest_true(rows, probes, most)

    def recall(lists: DataFrame, name: str) -> float:
        own = lists.where(F.col(name).isin(list(probes))).select(name, "d").collect()
        return sum(min(most, sum(d <= truth[u] for d in ds)) for u, ds in own) / (most * len(probes))

    planes = [_tree(sample, count, size, 2 * (k + 1), rng)[0] for _ in range(trees)]
    empty = [F.array_repeat(F.lit(-1).cast("long"), most).alias("v"), F.array_repeat(F.lit(float("inf")), most).alias("d")]
    state = rows.select("id", "row", *empty).mapInArrow(_grouped(planes[0]), _STATE)

    def compared(number: int) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            table = table.combine_chunks().sort_by("id")
            ids, own, v, d = table["id"].to_numpy(), _matrix(table["row"]), _matrix(table["v"]), _matrix(table["d"])
            v, d = v.copy(), d.copy()
            deal = np.random.default_rng([seed, number, table["part"][0].as_py()])
            for _ in range(CUTS if len(ids) > block else 1):
                for at in _pieces(own, block, deal):
                    if len(at) > 1:
                        near, gaps = _nearest(ids[at], own[at], most)
                        v[at], d[at] = _kept(np.concatenate([v[at], near], 1), np.concatenate([d[at], gaps], 1), most)
            following = _routed(planes[min(number + 1, trees - 1)], ids, own)
            columns = [table["id"], table["row"], _lists(v), _lists(d), pa.array(following)]
            return pa.table(columns, ["id", "row", "v", "d", "part"])

        return run

    for number in range(trees):
        state = cut_lineage(state.groupBy("part").applyInArrow(compared(number), _STATE))
        if count <= block or recall(state, "id") >= goal:
            break
    lists = state.select(F.col("id").alias("u"), F.filter("v", lambda v: v >= 0).alias("v"), F.filter("d", lambda d: d < float("inf")).alias("d"))
    if count <= block or recall(lists, "u") >= goal:
        return lists
    graph = lists.select("u", F.explode(F.arrays_zip("v", "d")).alias("e")).select("u", "e.v", "e.d")
    return _descended(rows, cut_lineage(graph), k, count, rounds, lambda lists: recall(lists, "u") >= goal)


def _descended(rows: DataFrame, graph: DataFrame, k: int, count: int, rounds: int, enough: Callable[[DataFrame], bool]) -> DataFrame:
    """The lists of the graph after rounds that compare the neighbours of each row, and at most ``k`` that name it."""

    def improved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own, far in _members(batches):
            gaps = _apart(own[:, None], own[None])
            np.fill_diagonal(gaps, np.inf)
            nearer = np.argsort(gaps, 1, kind="stable")[:, :k]
            gaps = np.take_along_axis(gaps, nearer, 1)
            a, n = np.nonzero(gaps < far[:, None])
            if len(a):
                yield _found([ids[a]], [ids[nearer[a, n]]], [gaps[a, n]])

    def lists() -> DataFrame:
        return graph.groupBy("u").agg(F.collect_list("v").alias("v"), F.collect_list("d").alias("d"))

    for number in range(rounds):
        # The farthest neighbour so far: only nearer ones are of use.
        far = graph.groupBy("u").agg(F.when(F.count(F.lit(1)) >= min(k, count - 1), F.max("d")).otherwise(float("inf")).alias("far"))
        known = rows.join(far, F.col("id") == F.col("u"), "left").select("id", "row", F.coalesce("far", F.lit(float("inf"))).alias("far"))
        back = graph.select(F.col("v").alias("centre"), F.col("u").alias("id"))
        dealt = Window.partitionBy("centre").orderBy(F.xxhash64("id", F.lit(number)))
        back = back.withColumn("n", F.row_number().over(dealt)).where(F.col("n") <= k).drop("n")
        around = graph.select(F.col("u").alias("centre"), F.col("v").alias("id")).unionByName(back)
        around = around.unionByName(rows.select(F.col("id").alias("centre"), "id")).distinct()
        met = around.join(known, "id").groupBy("centre").agg(F.collect_list(F.struct("id", "row", "far")).alias("all"))
        better = met.select("all.id", "all.row", "all.far").mapInArrow(improved, _GRAPH).distinct()
        better = cut_lineage(better.join(graph.select("u", "v"), ["u", "v"], "left_anti").select("u", "v", "d"))
        gained = better.count()
        if gained:
            graph = _best(graph.unionByName(better), k)
        if gained < STILL * k * count or enough(lists()):
            break
    return cut_lineage(lists())


def neighbour_graph(
    rows: DataFrame, k: int = NEIGHBOURS, trees: int = TREES, block: int = BLOCK, rounds: int = ROUNDS, seed: int = 42
) -> DataFrame:
    """``(u, v, d)``: about the ``k`` nearest others of each row of ``(id, row)`` by Euclidean distance; see ``neighbour_lists``."""
    lists = neighbour_lists(rows, k, trees, block, rounds, seed)
    return lists.select("u", F.explode(F.arrays_zip("v", "d")).alias("e")).select("u", "e.v", "e.d")


def _strengths(k: int):
    """Strength of each row's links: 1 for the nearest, all of a row adding up to ``log2 k`` where they can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                lengths = pc.list_value_length(batch.column(1)).to_numpy()
                line = np.repeat(np.arange(len(lengths)), lengths)
                slot = np.arange(len(line)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                near, gap = (pc.list_flatten(batch.column(c)).to_numpy() for c in (1, 2))
                gaps = np.full((len(lengths), lengths.max()), np.inf)
                gaps[line, slot] = gap
                beyond = np.maximum(gaps - gaps.min(1)[:, None], 0)
                low, high = np.zeros(len(gaps)), np.maximum(np.where(np.isfinite(gaps), gaps, 0).max(1), 1e-12) * 1e3
                for _ in range(64):
                    middle = (low + high) / 2
                    over = np.exp(-beyond / np.maximum(middle, 1e-300)[:, None]).sum(1) > np.log2(k)
                    low, high = np.where(over, low, middle), np.where(over, middle, high)
                own = np.repeat(batch.column(0).to_numpy(), lengths)
                yield _found([own], [near], [np.exp(-beyond / np.maximum(high, 1e-300)[:, None])[line, slot]])

    return run


def _list_links(lists: DataFrame, k: int) -> DataFrame:
    """``(u, v, d)`` in both directions, from lists; see ``link_strengths``."""
    one = lists.select("u", "v", "d").mapInArrow(_strengths(k), _GRAPH)
    ends = one.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "d").groupBy("a", "b")
    both = F.when(F.count(F.lit(1)) > 1, F.sum("d") - F.min("d") * F.max("d")).otherwise(F.sum("d"))
    merged = cut_lineage(ends.agg(both.alias("d")))
    return merged.select(F.col("a").alias("u"), F.col("b").alias("v"), "d").unionByName(merged.select(F.col("b").alias("u"), F.col("a").alias("v"), "d"))


def link_strengths(graph: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``(u, v, d)`` in both directions with ``d`` the strength: that at least one of the two rows is linked to the other."""
    return _list_links(graph.groupBy("u").agg(F.collect_list("v").alias("v"), F.collect_list("d").alias("d")), k)


def _moved(place: np.ndarray, own: np.ndarray, other: np.ndarray, fixed: np.ndarray, strength: np.ndarray, sample: np.ndarray,
           epochs: int, rate: float, fall: float, rng: np.random.Generator) -> np.ndarray:
    """Positions after ``epochs`` of pulls along links and pushes from the sample.

    A link goes from local row ``own`` to local row ``other``, or where that is negative to a row that rests at ``fixed``.
    Positions have a column for each axis.
    """
    # Gaps and forces in single precision: what they lose is far below a step. Positions stay in double.
    place, rest, others = place.T.copy(), fixed.T.astype(np.float32), sample.T.astype(np.float32)
    local = other >= 0
    for epoch in range(epochs):
        step = rate - fall * epoch / epochs
        drawn = np.flatnonzero(rng.random(len(own), np.float32) < strength)
        if not len(drawn):
            continue
        a, b, inner = own[drawn], other[drawn], local[drawn]
        now = place.astype(np.float32)
        spot = [np.take(p, a) for p in now]
        with np.errstate(divide="ignore", invalid="ignore"):
            gap = [x - np.where(inner, np.take(p, np.maximum(b, 0)), np.take(r, drawn)) for x, p, r in zip(spot, now, rest)]
            square = gap[0] ** 2 + gap[1] ** 2
            power = np.exp(_B * np.log(square))
            pull = np.where(square > 0, -2 * _A * _B * (power / square) / (1 + _A * power), 0)
            drawn_pull = [np.clip(pull * g, -4, 4) * step for g in gap]
            pushers = rng.integers(0, others.shape[1], (PUSHES, len(a)), np.int32)
            gap = [x - np.take(p, pushers) for x, p in zip(spot, others)]
            square = gap[0] ** 2 + gap[1] ** 2
            # A pusher at the same spot has no gap, so no push.
            push = 2 * _B / ((0.001 + square) * (1 + _A * np.exp(_B * np.log(square))))
        for axis in range(2):
            moves = drawn_pull[axis] + step * np.clip(push * gap[axis], -4, 4).sum(0)
            move = np.bincount(a, moves, place.shape[1]) - np.bincount(b[inner], drawn_pull[axis][inner], place.shape[1])
            # Many links move a row in one epoch: together they move it as far as a few would.
            place[axis] += np.clip(move, -4, 4)
    return place.T


def neighbour_layout(
    df: DataFrame, key: str, features: Sequence[str], names: Sequence[str] = ("umap_x", "umap_y"), k: int = NEIGHBOURS, seed: int = 42,
    exchanges: int = EXCHANGES, epochs: int = EPOCHS,
) -> DataFrame:
    """``df`` with two more columns: positions at which near rows by ``features`` are near each other.

    Like any such layout it is one of many; coordinates mean nothing alone. Nulls and NaN in features are errors. Rows are
    told apart by their place in the table, so a key may repeat. Two rows or fewer keep their principal components.
    """
    spark = df.sparkSession
    share_package(spark)
    numbered = cut_lineage(df.withColumn("_id", F.monotonically_increasing_id()))
    rows = assembled(numbered, features, ["_id"]).select(F.col("_id").alias("id"), vector_to_array(_VECTOR).alias("row"))
    rows = cut_lineage(rows)
    count = rows.count()
    if count < 3:
        return df.withColumns({n: F.lit(0.0) for n in names}) if count < 2 else project(df, features, names)
    links = _list_links(neighbour_lists(rows, k, seed=seed), k)

    # Two ways to group near rows, taken in turn: links across the groups of one are mostly within those of the other.
    size, rng = min(STRIP, max(LEAST_STRIP, count // STRIPS)), np.random.default_rng([seed, count])
    sampled = rows.orderBy(F.xxhash64("id", F.lit(seed))).limit(PLANE_ROWS * (-(-count // size) + 1)).toPandas()
    sample = np.array(sampled["row"].tolist(), float)
    planes = [_tree(sample, count, size, size // 4, rng)[0] for _ in range(2)]

    def housed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.column(0).to_numpy(), _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(_routed(p, ids, own)) for p in planes)], ["u", "home0", "home1"])

    homes = cut_lineage(rows.mapInArrow(housed, "u long, home0 long, home1 long"))
    ends = links.join(homes.select(F.col("u").alias("v"), F.col("home0").alias("to0"), F.col("home1").alias("to1")), "v").groupBy("u")
    lists = ends.agg(*(F.collect_list(c).alias(c) for c in ("v", "d")), *(F.collect_set(c).alias(c) for c in ("to0", "to1")))

    def received(side: int) -> Column:
        return F.array_union(F.coalesce(f"to{side}", F.array().cast("array<bigint>")), F.array(f"home{side}")).alias(f"to{side}")

    linked = [F.coalesce(c, F.array().cast(t)).alias(c) for c, t in (("v", "array<bigint>"), ("d", "array<double>"))]
    lists = cut_lineage(homes.join(lists, "u", "left").select("u", "home0", "home1", *linked, received(0), received(1)))
    start = project(numbered, features, ("_x", "_y")).select(F.col("_id").alias("u"), "_x", "_y")
    largest = start.agg(F.greatest(F.max(F.abs("_x")), F.max(F.abs("_y")))).first()[0] or 1.0
    # Equal rows start a hair apart, or nothing would push them.
    hair = [F.pmod(F.xxhash64("u", F.lit(n)), F.lit(1000)) / 1e6 for n in range(2)]
    start = start.select("u", (F.col("_x") * 10 / largest + hair[0]).alias("x"), (F.col("_y") * 10 / largest + hair[1]).alias("y"))
    place = cut_lineage(start.join(lists.select("u", "to0", "to1"), "u"))
    shape = "u long, x double, y double, to0 array<bigint>, to1 array<bigint>"

    def exchanged(sample: np.ndarray, number: int) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            part = table["part"][0].as_py()
            table = table.combine_chunks().sort_by("u")
            own, sent = (table.filter(f(table["v"])) for f in (pc.is_valid, pc.is_null))
            u, far = own["u"].to_numpy(), sent["u"].to_numpy()
            spots = np.column_stack([sent["x"].to_numpy(), sent["y"].to_numpy()])
            lengths = pc.list_value_length(own["v"]).to_numpy()
            line = np.repeat(np.arange(len(u)), lengths)
            v, strength = (pc.list_flatten(own[c]).to_numpy() for c in ("v", "d"))
            order = np.lexsort((v, line))
            line, v, strength = line[order], v[order], strength[order].astype(np.float32)
            at = np.minimum(np.searchsorted(u, v), len(u) - 1)
            other = np.where(u[at] == v, at, -1) if len(v) else np.zeros(0, int)
            rng, rate, fall = np.random.default_rng([seed, number, part]), 1 - number / exchanges, 1 / exchanges
            spot = _moved(spots[np.searchsorted(far, u)], line, other, spots[np.searchsorted(far, v)], strength, sample, epochs, rate, fall, rng)
            return pa.table([own["u"], pa.array(spot[:, 0].copy()), pa.array(spot[:, 1].copy()), own["to0"], own["to1"]], ["u", "x", "y", "to0", "to1"])

        return run

    for number in range(exchanges):
        sample = place.orderBy(F.xxhash64("u", F.lit(number))).limit(SAMPLE).select("x", "y").toPandas().to_numpy(float)
        side = number % 2
        nothing = {"x": "double", "y": "double", "v": "array<bigint>", "d": "array<double>", "to0": "array<bigint>", "to1": "array<bigint>"}
        own = lists.select(F.col(f"home{side}").alias("part"), "u", "v", "d", "to0", "to1")
        sent = place.select(F.explode(f"to{side}").alias("part"), "u", "x", "y")
        own, sent = (f.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items() if c not in f.columns}) for f in (own, sent))
        place = cut_lineage(own.unionByName(sent).groupBy("part").applyInArrow(exchanged(sample, number), shape))
    renamed = place.select(F.col("u").alias("_id"), F.col("x").alias(names[0]), F.col("y").alias(names[1]))
    return numbered.drop(*names).join(renamed, "_id").select(*[F.col(f"`{c}`") for c in df.columns if c not in names], *names)
