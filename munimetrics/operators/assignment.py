"""Best one-to-one assignment of labels by overlap: an auction with falling bid steps.

Labels and partners are joined by the overlaps that occur, which fall into connected parts. A part of a bounded number of
overlaps is settled by one task; larger ones are settled together in rounds, in each of which all free bidders bid at once.
In both the step by which bids rise falls from the largest value to below one overlap shared by all bidders, which makes
the total the best one.

A label may stay without partner. So that bids can be compared as if all had one, every label has a stand-in on the other
side: a bidder may take its own stand-in for nothing, and a stand-in bids for its own object, or for the stand-in of any
bidder that overlaps it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from munimetrics.operators.clustering import connected_components
from munimetrics.session import cut_lineage, share_package

#: Overlaps of a connected part that one task settles.
PART = 1 << 18
#: A bid step is this part of the one before.
FALL = 5


def _steps(top: int, bidders: int) -> Iterator[int]:
    """Bid steps for values up to ``top`` that were multiplied by ``bidders + 1``; the last one is 1."""
    step = max(1, top * (bidders + 1) // 2)
    while step > 1:
        yield step
        step = max(1, step // FALL)
    yield 1


def settle(bidders: np.ndarray, objects: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the chosen edges ``(bidder, object, value)``: the best total, each bidder and object at most once.

    Values are whole numbers above zero. Bidders bid one after the other.
    """
    n, m = int(bidders.max()) + 1, int(objects.max()) + 1
    count = n + m
    # Bidder n + o stands in for object o, object m + p for bidder p.
    own = np.concatenate([bidders, np.arange(n), n + np.arange(m), n + objects])
    other = np.concatenate([objects, m + np.arange(n), np.arange(m), m + bidders])
    worth = np.concatenate([values * (count + 1), np.zeros(n + m + len(values), np.int64)]).astype(np.int64)
    order = np.argsort(own, kind="stable")
    own, other, worth = own[order], other[order], worth[order]
    bounds = np.searchsorted(own, np.arange(count + 1))
    price = np.zeros(count, np.int64)
    taken = np.full(count, -1)
    for step in _steps(int(values.max()), count):
        taken[:] = -1
        free = list(range(count - 1, -1, -1))
        while free:
            bidder = free.pop()
            part = slice(bounds[bidder], bounds[bidder + 1])
            gain = worth[part] - price[other[part]]
            best = int(gain.argmax())
            wanted = int(other[part][best])
            second = np.partition(gain, -2)[-2] if len(gain) > 1 else gain[best]
            price[wanted] += gain[best] - second + step
            if taken[wanted] >= 0:
                free.append(int(taken[wanted]))
            taken[wanted] = bidder
    return np.flatnonzero(taken[objects] == bidders)


def _settled(part: pd.DataFrame) -> pd.DataFrame:
    left, bidders = np.unique(part["left"].to_numpy(), return_inverse=True)
    right, objects = np.unique(part["right"].to_numpy(), return_inverse=True)
    order = np.lexsort((objects, bidders))
    chosen = settle(bidders[order], objects[order], part["n"].to_numpy()[order])
    return part.iloc[order[chosen]][["left", "right"]]


def _in_rounds(edges: DataFrame) -> DataFrame:
    """The same auction over ``(left, right, n)`` as rounds of joins, all free bidders at once."""
    edges = edges.withColumns({"left": F.col("left").cast("long"), "right": F.col("right").cast("long")})

    def name(kind: int, column: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(column).alias("of"))

    lefts, rights = edges.select("left").distinct(), edges.select("right").distinct()
    count = lefts.count() + rights.count()
    zero = F.lit(0).cast("long").alias("worth")
    scaled = (F.col("n") * (count + 1)).cast("long").alias("worth")
    graph = edges.select(name(0, "left").alias("bidder"), name(0, "right").alias("object"), scaled)
    graph = graph.unionByName(lefts.select(name(0, "left").alias("bidder"), name(1, "left").alias("object"), zero))
    graph = graph.unionByName(rights.select(name(1, "right").alias("bidder"), name(0, "right").alias("object"), zero))
    graph = cut_lineage(graph.unionByName(edges.select(name(1, "right").alias("bidder"), name(1, "left").alias("object"), zero)))
    # One row per object with its price and holder.
    state = cut_lineage(graph.select("object", F.lit(0).cast("long").alias("price"), F.lit(None).cast(graph.schema["bidder"].dataType).alias("holder")).distinct())
    for step in _steps(int(edges.agg(F.max("n")).first()[0]), count):
        state = state.withColumn("holder", F.lit(None).cast(graph.schema["bidder"].dataType))
        while True:
            held = state.where("holder is not null").select(F.col("holder").alias("bidder"))
            offers = graph.join(held, "bidder", "left_anti").join(state.select("object", "price"), "object")
            ranked = Window.partitionBy("bidder").orderBy(F.col("gain").desc(), "object")
            offers = offers.withColumn("gain", F.col("worth") - F.col("price")).withColumn("rank", F.row_number().over(ranked))
            bids = offers.where("rank <= 2").groupBy("bidder").agg(
                F.max(F.when(F.col("rank") == 1, F.struct("object", "price", "gain"))).alias("best"), F.min("gain").alias("second")
            )
            bids = bids.select("bidder", "best.object", (F.col("best.price") + F.col("best.gain") - F.col("second") + step).alias("bid"))
            won = bids.groupBy("object").agg(F.max(F.struct("bid", "bidder")).alias("won"))
            state = cut_lineage(
                state.join(won, "object", "left").select(
                    "object", F.coalesce("won.bid", "price").alias("price"), F.coalesce("won.bidder", "holder").alias("holder")
                )
            )
            # As many objects as bidders: once all objects are held, all bidders hold one.
            if state.where("holder is null").isEmpty():
                break
    real = state.where("object.kind = 0 and holder.kind = 0")
    return real.select(F.col("holder.of").alias("left"), F.col("object.of").alias("right"))


def best_label_pairs(df: DataFrame, target: str, label: str, part: int = PART) -> DataFrame:
    """One-to-one pairs ``(target, label)`` with the largest total overlap of rows; labels are whole numbers.

    Only labels that share a row are paired, null labels are not. Of several best totals one is given, the same in every
    run.
    """
    share_package(df.sparkSession)
    known = df.where(F.col(target).isNotNull() & F.col(label).isNotNull())
    counted = known.groupBy(F.col(target).alias("left"), F.col(label).alias("right")).agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(counted.select(F.col("left").cast("long"), F.col("right").cast("long"), "n"))
    ends = [F.struct(F.lit(k).alias("kind"), F.col(c).alias("of")).alias(c[0]) for k, c in enumerate(("left", "right"))]
    nodes = counted.select(F.explode(F.array(*ends))).distinct()
    roots = connected_components(nodes, counted.select(*ends))
    parts = counted.join(roots.where("node.kind = 0").select(F.col("node.of").alias("left"), F.col("root").alias("part")), "left")
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    sized = cut_lineage(parts.join(sizes, "part"))
    small = sized.where(F.col("size") <= part).groupBy("part").applyInPandas(_settled, "left long, right long")
    large = sized.where(F.col("size") > part).select("left", "right", "n")
    pairs = small if large.isEmpty() else small.unionByName(_in_rounds(large))
    kinds = dict(df.dtypes)
    return pairs.select(F.col("left").cast(kinds[target]).alias(target), F.col("right").cast(kinds[label]).alias(label))
