"""Connected components of links held in a DataFrame, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.common import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to one row ``(node, root)`` per linked node; the root is the least node of the component.

    Links may repeat, point either way or join a node to itself. Both stars keep components whole and only ever
    point a node to a smaller one; when a round changes nothing, every node points to its root. A round joins on
    the node with the least of its neighbours, never all neighbours with each other; rounds are cut by written
    tables. A node whose only link is to itself has no row.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut_lineage(links)
    before = _mark(links)
    while before[0]:
        links = cut_lineage(_small_star(_large_star(links)))
        after = _mark(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
