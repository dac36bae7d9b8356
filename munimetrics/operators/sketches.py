"""Exact quantiles with the help of sketches that add up over months.

A sketch per group and month is kept and merged. It tells, with a margin, between which two values a quantile lies; the exact
pass then counts the rows below and orders only those between them. A group whose quantile the sketch missed is
ordered whole, so results are exact in any case.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics.operators.ordering import _number, null_safe_join, positions, quantiles, value_counts
from munimetrics.session import cut_lineage

#: Size of a sketch; ranks are off by about 2.3 / SIZE^0.9 of the rows, and the margin is this many times as wide.
SIZE = 2000
MARGIN = 3


def value_sketches(df: DataFrame, by: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """``(by..., sketch)``: one sketch per group; name a month in ``by`` to add months up later. Nulls and NaN do not count."""
    number = df.withColumn("_value", _number(df, value).cast("double")).where("_value is not null")
    return number.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.kll_sketch_agg_double("_value", F.lit(size)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of a coarser grouping, without the rows."""
    return sketches.groupBy(*[F.col(f"`{c}`") for c in by]).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def _cuts(sketches: DataFrame, by: Sequence[str], probs: Mapping[str, float], size: int) -> DataFrame:
    """``(by..., name, prob, low, high)``: where each quantile lies if the sketch's error keeps its margin."""
    margin = MARGIN * 2.296 / size**0.9021

    def at(prob: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, prob))))

    each = [F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("prob"), at(p - margin).alias("low"), at(p + margin).alias("high")) for n, p in probs.items()]
    return sketches.select(*[F.col(f"`{c}`") for c in by], F.explode(F.array(*each)).alias("cut")).select(*by, "cut.*")


def sketched_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], sketches: DataFrame | None = None, size: int = SIZE
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group that has a value.

    ``sketches`` are those of the same rows by the same groups, as ``merge_sketches`` gives them out of kept ones; without
    them they are made here. Only rows between a quantile's cut points are ordered.
    """
    if sketches is None:
        sketches = value_sketches(df, by, value, size)
    groups = [F.col(f"`{c}`") for c in by]
    cuts = cut_lineage(_cuts(sketches, by, probs, size))
    numbers = df.select(*groups, _number(df, value).cast("double").alias("_value")).where("_value is not null")
    # Groups are few next to rows: Spark broadcasts the written cut points as long as they are small.
    # A group without a sketch has no cuts, and so no quantiles below.
    met = null_safe_join(numbers, cuts, by, "left")
    below = met.groupBy(*by, "name", "prob").agg(F.count_if(F.col("_value") < F.col("low")).alias("below"), F.count(F.lit(1)).alias("rows"))
    within = met.where(F.col("_value").between(F.col("low"), F.col("high"))).groupBy(*by, "name", "_value").agg(F.count(F.lit(1)).alias("n"))
    placed = positions(within, [*by, "name"], "_value").select(*by, "name", "_value", F.col("before").alias("first"), "ties")
    ranked = null_safe_join(below, placed, [*by, "name"], "left")
    first = F.col("below") + F.col("first")
    target = (F.col("rows") - 1) * F.col("prob")

    def value_at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < first + F.col("ties")), F.col("_value")))

    found = ranked.groupBy(*by, "name").agg(
        value_at(F.floor(target)).alias("lower"), value_at(F.ceil(target)).alias("upper"), F.max(target - F.floor(target)).alias("share")
    )
    between = F.col("lower") + (F.col("upper") - F.col("lower")) * F.col("share")
    wide = found.groupBy(*groups).agg(*[F.max(F.when(F.col("name") == n, between)).alias(n) for n in probs])
    wide = cut_lineage(wide)
    missed = wide.where(" or ".join(f"`{n}` is null" for n in probs)).select(*groups)
    if missed.isEmpty():
        return wide
    again = null_safe_join(df, missed.distinct(), by, "left_semi")
    whole = quantiles(positions(value_counts(again, by, value), by, value), by, value, dict(probs))
    return null_safe_join(wide, missed, by, "left_anti").unionByName(whole.select(*wide.columns))
