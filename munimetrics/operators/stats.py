"""Cluster profiles, distributions and the Kruskal-Wallis test, all over unpivoted features."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics.operators.ordering import null_safe_join, positions, quantiles, value_counts


def unpivoted(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Rows ``(label, feature, value)`` of every labelled row; NaN becomes null."""
    doubles = df.where(F.col(label).isNotNull()).select(
        label, *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in features]
    )
    return doubles.unpivot([label], [F.col(f"`{c}`") for c in features], "feature", "value")


def cluster_profile(
    df: DataFrame, features: Sequence[str], label: str = "cluster", digits: int = 3
) -> DataFrame:
    """Mean, exact median and population standard deviation per label and feature."""
    long = unpivoted(df, label, features)
    by = [label, "feature"]
    moments = long.groupBy(*by).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    medians = quantiles(positions(value_counts(long, by, "value"), by, "value"), by, "value", {"median": 0.5})
    joined = null_safe_join(moments, medians, by, "left")
    return joined.select(*by, *[F.bround(c, digits).alias(c) for c in ("mean", "median", "std")])


def profile_table(profile: DataFrame, statistic: str, features: Sequence[str], label: str = "cluster") -> DataFrame:
    """One statistic of the profile as a table with one column per feature."""
    return profile.groupBy(label).pivot("feature", list(features)).agg(F.first(statistic))


def box_stats(df: DataFrame, features: Sequence[str], label: str = "cluster") -> DataFrame:
    """What a box plot shows per label and feature: quartiles, whisker ends and number of outliers.

    Whiskers reach the furthest values within 1.5 interquartile ranges of the box.
    """
    by = [label, "feature"]
    placed = positions(value_counts(unpivoted(df, label, features), by, "value"), by, "value")
    boxes = quantiles(placed, by, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    boxes = boxes.withColumn("_low", F.col("q1") - reach).withColumn("_high", F.col("q3") + reach)
    inside = F.col("value").between(F.col("_low"), F.col("_high"))
    return (
        null_safe_join(placed, boxes, by)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )


def median_against_all(df: DataFrame, features: Sequence[str], label: str = "cluster") -> DataFrame:
    """Median of each label next to the median over all rows, and their ratio."""
    long = unpivoted(df, label, features)
    by = [label, "feature"]
    counts = value_counts(long, by, "value")
    per_label = quantiles(positions(counts, by, "value"), by, "value", {"median": 0.5})
    overall = quantiles(positions(counts, ["feature"], "value"), ["feature"], "value", {"median_all": 0.5})
    joined = per_label.join(overall, "feature")
    return joined.select(
        *by, "median", "median_all", F.try_divide("median", "median_all").alias("ratio")
    )


def describe(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Descriptive statistics, one row per feature."""
    everything = df.select(F.lit(0).alias("_all"), *[F.col(f"`{c}`") for c in features])
    long = unpivoted(everything, "_all", features)
    summary = long.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    placed = positions(value_counts(long, ["feature"], "value"), ["feature"], "value")
    quarters = quantiles(placed, ["feature"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return summary.join(quarters, "feature", "left")


def chi_square_tail(statistic: Column, freedom: Column) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom, as a finite sum.

    Spark has no complementary error function, so this is Python, for one row per feature. The functions
    are nested to travel by value: workers need not have this package.
    """

    def tail(value: float, degrees: float) -> float | None:
        if not value == value or not degrees >= 1:
            return None
        half, steps = max(value, 0.0) / 2.0, int(degrees) // 2
        if degrees % 2 == 0:
            total, term, shift = 0.0, math.exp(-half), 1.0
        else:
            total, shift = math.erfc(math.sqrt(half)), 1.5
            term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
        for i in range(steps):
            total += term
            term *= half / (i + shift)
        return total

    def tails(values: pd.Series, degrees: pd.Series) -> pd.Series:
        return pd.Series([tail(v, d) for v, d in zip(values, degrees)], dtype="float64")

    return F.pandas_udf(tails, "double")(statistic, freedom)


def kruskal_wallis(df: DataFrame, features: Sequence[str], label: str = "cluster") -> DataFrame:
    """Kruskal-Wallis test of each feature between labels: ``H``, ``p_value``, ``eta2_approx``.

    ``H`` is corrected for ties and ``eta2_approx`` is ``H / (N - 1)``. All three are null when some label
    has fewer than two values or no spread. Sorted by p, then H, undefined rows last.

    Ranks come from counted values placed in the order of their feature, so no feature is sorted by a
    single task and a value shared by many rows is one row.
    """
    long = unpivoted(df, label, features)
    placed = positions(value_counts(long, ["feature", label], "value"), ["feature"], "value")
    mean_rank = F.col("before") + (F.col("ties") + 1) / 2
    ranks = placed.groupBy("feature", label).agg(
        F.sum(F.col("n") * mean_rank).alias("rank_sum"),
        F.sum("n").alias("size"),
        F.coalesce(F.max("value") > F.min("value"), F.lit(False)).alias("spread"),
        F.sum(F.col("n") * (F.col("ties").cast("double") * F.col("ties") - 1)).alias("tied"),
    )
    tested = ranks.groupBy("feature").agg(
        F.sum(F.try_divide(F.col("rank_sum") * F.col("rank_sum"), F.col("size"))).alias("between"),
        F.sum("size").cast("double").alias("total"),
        F.sum("tied").alias("tied"),
        F.count(F.lit(1)).alias("labels"),
        F.min((F.col("size") >= 2) & F.col("spread")).alias("valid"),
    )
    total = F.col("total")
    raw = 12.0 / (total * (total + 1)) * F.col("between") - 3 * (total + 1)
    untied = 1 - F.col("tied") / (total * total * total - total)
    statistic = F.when(F.col("valid"), F.try_divide(raw, untied))
    freedom = (F.col("labels") - 1).cast("double")
    tested = tested.withColumn("H", statistic).withColumn("p_value", chi_square_tail(F.col("H"), freedom))
    return tested.select(
        "feature", "H", "p_value", F.try_divide(F.col("H"), total - 1).alias("eta2_approx")
    ).orderBy(F.asc_nulls_last("p_value"), F.asc_nulls_last("H"))
