"""K-means with many starts in shared passes, and Ward's tree over cluster features.

K-means: every pass over the rows serves all starts at once. Seeds come from weighted draws (each pass draws rows of every
start in proportion to their squared distance from the start's centres so far), which counted rows and a weighted
choice reduce to ``k``. A task adds up its rows for all centres in arrays; the driver sees sums per centre.

Ward's tree: rows are added up to a bounded number of cluster features (count, sum, squares), which a
nearest-neighbour chain joins.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from munimetrics.operators.features import _VECTOR, assembled
from munimetrics.session import cut_lineage, share_package

#: Passes that draw seeds, and rows that each draws per start, as a multiple of ``k``.
SEED_PASSES = 3
OVERSAMPLING = 2
#: Cluster features that the chain joins at most.
FEATURES = 2000
#: Rows that a pass reads as one packed block, and those of it that are worked on at a time.
PACKED = 1 << 16
#: Finest grid on which rows are added up: 2^-30 of a feature's span.
_GRIDS = 30
_BLOCK = 4096


@dataclass
class KMeansFit:
    """Centres of the best start, and per start its cost, passes and whether its centres came to rest."""

    centres: np.ndarray
    costs: list[float]
    passes: list[int]
    rested: list[bool]
    best: int
    scans: int


def _draws(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from row hashes, another one for each salt."""
    z = hashes.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54


def _gaps(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return np.maximum((rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1)[None], 0.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(rows: DataFrame) -> DataFrame:
    """``(hashes, rows)``: blocks of at most ``PACKED`` rows as bytes, written once and dealt evenly over the tasks.

    The passes read them many times; as arrays of doubles they would be turned over value by value in each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            hashes, own = (np.concatenate(c) for c in zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in (hashes, own)], ["hashes", "rows"])

        for batch in batches:
            for start in range(0, batch.num_rows, PACKED):
                part = batch.slice(start, PACKED)
                if sum(len(h) for h, _ in held) + part.num_rows > PACKED:
                    yield block()
                held.append((part.column(0).to_numpy(), _matrix(part.column(1))))
        if held:
            yield block()

    dealt = rows.select("_hash", "_row").repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)
    return cut_lineage(dealt.mapInArrow(run, "hashes binary, rows binary"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for packed_hashes, packed_rows in zip(batch.column(0), batch.column(1)):
            hashes = np.frombuffer(packed_hashes.as_buffer(), np.int64)
            rows = np.frombuffer(packed_rows.as_buffer(), np.float64).reshape(len(hashes), -1)
            for start in range(0, len(hashes), _BLOCK):
                yield hashes[start : start + _BLOCK], rows[start : start + _BLOCK]


class _Passes:
    """Passes over ``(_hash, _row)``; all counts and sums of a pass travel as one array a task."""

    def __init__(self, rows: DataFrame):
        self.rows, self.scans = _packed(rows), 0

    def added(self, size: int, work: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> np.ndarray:
        """The sum over all blocks of what ``work`` adds into an array of ``size``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros(size), False
            for hashes, block in _blocks(batches):
                work(total, hashes, block)
                seen = True
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

        self.scans += 1
        out = np.zeros(size)
        # One array from each of the tasks that the blocks are dealt over.
        for found in self.rows.mapInArrow(run, "total binary").collect():
            out += np.frombuffer(found["total"])
        return out

    def drawn(self, starts: int, count: int, clock: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> list[list[np.ndarray]]:
        """Per start the ``count`` rows whose clocks ring first; rows whose clock is infinite are not drawn."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros((0, 0)))] * starts
            for hashes, block in _blocks(batches):
                for start in range(starts):
                    rings, rows = held[start]
                    own = clock(hashes, block, start)
                    merged = np.concatenate([rings, own])
                    all_ = np.concatenate([rows, block]) if len(rows) else block
                    first = np.argsort(merged, kind="stable")[:count]
                    first = first[np.isfinite(merged[first])]
                    held[start] = merged[first], all_[first]
            for start, (rings, rows) in enumerate(held):
                if len(rings):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([start] * len(rings), pa.int32()), pa.array(rings), pa.array(rows.tolist(), pa.list_(pa.float64()))],
                        ["start", "ring", "row"],
                    )

        self.scans += 1
        found = self.rows.mapInArrow(run, "start int, ring double, row array<double>")
        order = Window.partitionBy("start").orderBy("ring", "row")
        out: list[list[np.ndarray]] = [[] for _ in range(starts)]
        for row in found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= count).orderBy("start", "n").collect():
            out[row["start"]].append(np.array(row["row"]))
        return out


def _chosen(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of the weighted candidates, each in proportion to its weight and squared distance from those before."""
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    nearest = _gaps(candidates, candidates[chosen])[:, 0]
    while len(chosen) < k:
        share = weights * nearest
        if share.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(candidates), p=share / share.sum())))
        nearest = np.minimum(nearest, _gaps(candidates, candidates[chosen[-1:]])[:, 0])
    return candidates[chosen]


def fit_kmeans(
    rows: DataFrame, k: int = 5, restarts: int = 20, seed: int = 42, iterations: int = 300, tolerance: float = 1e-4
) -> KMeansFit | None:
    """Fit ``restarts`` starts over ``rows`` (``_hash long, _row array<double>``) in shared passes; None without rows.

    A start rests when no centre moves further than ``tolerance``; then it takes part in no further pass. Passes end when
    all rest or after ``iterations``; starts that do not rest by then are told in ``rested``, and in a warning if the
    best one is among them. A centre that loses all its rows stays where it is. With fewer than ``k`` different rows
    there are fewer centres.
    """
    passes = _Passes(rows)
    first = passes.drawn(restarts, 1, lambda h, x, s: _draws(h, seed * 1000 + s))
    if not first[0]:
        return None
    found = [np.array(f) for f in first]
    for number in range(1, SEED_PASSES + 1):
        held = list(found)

        def clock(hashes: np.ndarray, block: np.ndarray, start: int, held: list = held, number: int = number) -> np.ndarray:
            # The smallest of these clocks draw without replacement in proportion to the squared distance.
            gaps = _gaps(block, held[start]).min(1)
            gaps[gaps <= 1e-12 * (block**2).sum(1)] = 0
            with np.errstate(divide="ignore"):
                return -np.log(_draws(hashes, seed * 1000 + number * 100_003 + start)) / gaps

        drawn = passes.drawn(restarts, OVERSAMPLING * k, clock)
        found = [np.unique(np.concatenate([f, np.array(d)]), axis=0) if d else f for f, d in zip(found, drawn)]
    offsets = np.cumsum([0, *map(len, found)])

    def counted(total: np.ndarray, hashes: np.ndarray, block: np.ndarray) -> None:
        for start, own in enumerate(found):
            near = _gaps(block, own).argmin(1)
            total[offsets[start] : offsets[start + 1]] += np.bincount(near, minlength=len(own))

    weights = passes.added(int(offsets[-1]), counted)
    centres = [
        _chosen(own, weights[a:b], k, np.random.default_rng([seed, start]))
        for start, (own, a, b) in enumerate(zip(found, offsets, offsets[1:]))
    ]
    width = centres[0].shape[1]
    rested, used = [False] * restarts, [0] * restarts

    def sums(active: list[int]) -> dict[int, np.ndarray]:
        """Per start the rows' number, sum and cost by centre."""
        most = max(len(centres[s]) for s in active)
        # A start with fewer centres repeats its first one, which never is nearer than itself.
        own = np.array([[centres[s][n if n < len(centres[s]) else 0] for s in active] for n in range(most)])
        weight = (own**2).sum(2)
        size = most * len(active) * (width + 2)

        def add(total: np.ndarray, hashes: np.ndarray, block: np.ndarray) -> None:
            # All starts at once: one row of the arrays is a start, one column a row of the block.
            gaps = (-2 * own.reshape(-1, width) @ block.T).reshape(most, len(active), len(block)) + weight[:, :, None]
            least = gaps.min(0)
            cost = np.maximum(least + (block**2).sum(1), 0.0)
            known = np.column_stack([np.ones(len(block)), block])
            free = np.ones(least.shape, bool)
            view = total.reshape(most, len(active), width + 2)
            for n in range(most):
                member = free & (gaps[n] == least)
                free &= ~member
                member = member.astype(np.float64)
                view[n, :, :-1] += member @ known
                view[n, :, -1] += np.einsum("sb,sb->s", member, cost)

        total = passes.added(size, add).reshape(most, len(active), width + 2)
        return {s: total[: len(centres[s]), n] for n, s in enumerate(active)}

    for _ in range(iterations):
        active = [s for s in range(restarts) if not rested[s]]
        if not active:
            break
        for start, total in sums(active).items():
            old = centres[start]
            moved = np.where(total[:, :1] > 0, total[:, 1:-1] / np.maximum(total[:, :1], 1), old)
            rested[start] = bool(np.sqrt(((moved - old) ** 2).sum(1)).max() <= tolerance)
            centres[start] = moved
            used[start] += 1
    costs = {s: float(t[:, -1].sum()) for s, t in sums(list(range(restarts))).items()}
    # Sums in another order differ in their last digits: of equally good starts the first one, centres in their own order.
    best = next(s for s in range(restarts) if costs[s] <= min(costs.values()) * (1 + 1e-9))
    centres[best] = centres[best][np.lexsort(np.round(centres[best], 9).T[::-1])]
    if not rested[best]:
        warnings.warn(f"the best start did not come to rest in {iterations} passes", RuntimeWarning, stacklevel=2)
    return KMeansFit(centres[best], [costs[s] for s in range(restarts)], used, rested, best, passes.scans)


def hashed_rows(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """``(key, _hash, _row)`` written once; nulls and NaN are errors."""
    share_package(df.sparkSession)
    rows = assembled(df, features, [key]).select(key, F.xxhash64(key).alias("_hash"), vector_to_array(_VECTOR).alias("_row"))
    return cut_lineage(rows)


def kmeans_labels(rows: DataFrame, key: str, centres: np.ndarray, name: str) -> DataFrame:
    """``(key, name)``: the nearest centre of each row, the first of equally near ones."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _gaps(_matrix(batch.column(1)), centres).argmin(1) if batch.num_rows else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near, pa.int32())], ["key", "label"])

    return rows.select(F.col(key), "_row").mapInArrow(run, f"key {kind}, label int").toDF(key, name)


def ward_merges(counts: np.ndarray, centres: np.ndarray) -> list[tuple[float, int, int]]:
    """Ward's merges of weighted points by a nearest-neighbour chain, as ``(cost, point, point)``, cheapest first.

    The points stand for the clusters that hold them; ties go to the smaller point.
    """
    size, centre = counts.astype(float).copy(), centres.astype(float).copy()
    alive, chain, out = np.ones(len(size), bool), [], []
    for _ in range(len(size) - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            top = chain[-1]
            cost = size * size[top] / (size + size[top]) * ((centre - centre[top]) ** 2).sum(1)
            cost[~alive] = np.inf
            cost[top] = np.inf
            near = int(cost.argmin())
            # Of equally cheap ones the one before in the chain, so that chains end.
            if len(chain) > 1 and cost[chain[-2]] <= cost[near]:
                near = chain[-2]
                break
            chain.append(near)
        a, b = min(top, near), max(top, near)
        del chain[-2:]
        out.append((float(cost[near]), a, b))
        centre[a] = (size[a] * centre[a] + size[b] * centre[b]) / (size[a] + size[b])
        size[a] += size[b]
        alive[b] = False
    return sorted(out, key=lambda m: m[0])


def ward_clusters(df: DataFrame, key: str, features: Sequence[str], k: int = 5, name: str = "label", most: int = FEATURES) -> DataFrame:
    """Agglomerative clusters by Ward's criterion, cut at ``k``; numbered from 0 by size, largest first.

    Rows are added up to at most ``most`` cluster features: equal rows if there are no more different ones, which is
    Ward's tree of the rows itself, else the cells of the finest grid (halving every feature's span) that has no more, whose
    rows stay together. Their counts, sums and squares are summed by Spark; only the features reach the driver.
    """
    rows = assembled(df, features, [key]).select(key, vector_to_array(_VECTOR).alias("_row"))
    rows = cut_lineage(rows)
    width = len(features)
    spans = rows.agg(*[f(F.col("_row")[i]).alias(f"{n}{i}") for i in range(width) for n, f in (("l", F.min), ("h", F.max))]).first()
    if spans["l0"] is None:
        return rows.select(key, F.lit(0).alias(name))
    lows = [spans[f"l{i}"] for i in range(width)]
    sides = [(spans[f"h{i}"] - spans[f"l{i}"]) or 1.0 for i in range(width)]

    def cell(level: int | Column | None) -> Column:
        if level is None:
            return F.transform("_row", lambda x: x + F.lit(0.0))
        cells = F.pow(F.lit(2.0), level if isinstance(level, Column) else F.lit(level))
        low, side = F.array(*map(F.lit, lows)), F.array(*map(F.lit, sides))
        return F.transform("_row", lambda x, i: F.floor((x - low[i]) / side[i] * cells).cast("double"))

    whole = rows.select(cell(None).alias("c")).distinct().limit(most + 1).count()
    level: int | None = None
    if whole > most:
        graded = rows.select("_row", F.explode(F.sequence(F.lit(0), F.lit(_GRIDS))).alias("level"))
        counts = graded.groupBy("level").agg(F.approx_count_distinct(cell(F.col("level")), 0.02).alias("n")).collect()
        level = max((r["level"] for r in counts if r["n"] <= most), default=0)
        # The count is an estimate: a grid that has more is left for the next coarser one.
        while level > 0 and rows.select(cell(level).alias("c")).distinct().limit(most + 1).count() > most:
            level -= 1
    placed = rows.select(key, cell(level).alias("_cell"), "_row")
    added = [F.sum(F.col("_row")[i]).alias(f"s{i}") for i in range(width)]
    squares = F.sum(F.aggregate("_row", F.lit(0.0), lambda a, x: a + x * x)).alias("q")
    # At the coarsest level a span's upper end has a cell of its own: as many as corners of the box, if they occur.
    cells = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), *added, squares).orderBy("_cell").toPandas()
    counts_ = cells["n"].to_numpy(float)
    centres = cells[[f"s{i}" for i in range(width)]].to_numpy(float) / counts_[:, None]
    label = np.arange(len(cells))
    for _, a, b in ward_merges(counts_, centres)[: max(0, len(cells) - k)]:
        label[label == label[b]] = label[a]
    totals = {own: counts_[label == own].sum() for own in set(label.tolist())}
    number = {own: n for n, own in enumerate(sorted(totals, key=lambda own: (-totals[own], own)))}
    named = [(list(map(float, c)), number[own]) for c, own in zip(cells["_cell"], label.tolist())]
    labels = df.sparkSession.createDataFrame(named, f"_cell array<double>, `{name}` int")
    return placed.select(key, "_cell").join(labels, "_cell").select(key, name)
