"""Grouped sums, counts, pivots and whole-table figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.session import cut_lineage


def grouped_sum(df: DataFrame, by: str, sums: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(by).agg(*[F.sum(value).alias(name) for name, value in sums.items()])


def grouped_count(df: DataFrame, by: Sequence[str], name: str, condition: Column | None = None) -> DataFrame:
    """Rows per group; with a condition, groups without a matching row are absent."""
    kept = df if condition is None else df.where(condition)
    return kept.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def count_known(df: DataFrame, key: str, known: DataFrame, known_key: str, name: str) -> DataFrame:
    """Rows per key for keys present in ``known``: counted first, so the join sees one row per key."""
    counts = grouped_count(df.where(F.col(key).isNotNull()), [key], name)
    keys = known.select(F.col(known_key).cast("string").alias("_known")).distinct()
    return counts.join(keys, F.col(key).cast("string") == F.col("_known"), "left_semi")


def distinct_by_flags(df: DataFrame, by: str, entity: str, flags: Mapping[str, Column]) -> DataFrame:
    """Distinct entities per group for several conditions at once.

    One row per group and entity first, then plain sums: several ``count(distinct)`` would each copy
    the input. Groups without any entity for a flag show null for it.
    """
    known = df.where(F.col(entity).isNotNull())
    entities = known.groupBy(by, entity).agg(
        *[F.max(F.coalesce(condition, F.lit(False)).cast("int")).alias(name) for name, condition in flags.items()]
    )
    return entities.groupBy(by).agg(
        *[F.nullif(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in flags]
    )


def group_by_all(df: DataFrame, *select: str) -> DataFrame:
    """SQL select items over ``df``, grouped by every item that is no aggregate."""
    return df.sparkSession.sql(f"SELECT {', '.join(select)} FROM {{rows}} GROUP BY ALL", rows=df)


def pivot_columns(category: Column, amount: Column, values: Sequence[str]) -> list[Column]:
    """One sum per category value, null where the group has no such row."""
    return [F.sum(F.when(category == v, amount)).alias(v) for v in values]


def pivot_fixed(
    df: DataFrame,
    by: Sequence[str],
    category: str,
    amount: Column | None = None,
    values: Sequence[str] = tuple(config.FACILITY_TYPES),
) -> DataFrame:
    """Counts, or sums of ``amount``, with one column per listed category. Other categories are left out."""
    amount = F.lit(1) if amount is None else amount
    return df.groupBy(*by).agg(*pivot_columns(F.col(category), amount, values))


def pivot_dynamic(
    df: DataFrame, by: Sequence[str], category: str, unknown: str = config.UNKNOWN_FACILITY_TYPE
) -> DataFrame:
    """Counts with one column per category found in the data; a missing category counts as ``unknown``.

    Counting comes first, so that the job looking for the categories and the pivot read counts, not rows.
    Spark refuses more than ``spark.sql.pivotMaxValues`` categories.
    """
    counts = df.groupBy(*by, F.coalesce(F.col(category), F.lit(unknown)).alias(category)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return counts.groupBy(*by).pivot(category).agg(F.sum("_n"))


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Contingency table of two label columns, zero where a pair does not occur."""
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(row).pivot(column).agg(F.sum("_n")).na.fill(0)


def distinct_sorted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


def sort_nulls_last(df: DataFrame, columns: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Total order over the table with nulls at the end whichever the direction."""
    order = [F.desc_nulls_last(c) if c in descending else F.asc_nulls_last(c) for c in columns]
    return df.orderBy(*order)


def label_sizes(df: DataFrame, label: str = "cluster", name: str = "n") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias(name)).orderBy(label)


def distinct_bitmaps(df: DataFrame, by: Sequence[str], entity: str) -> DataFrame:
    """Exact sets of a whole-number ``entity`` per group as bitmaps: ``(by..., bucket, bits)``.

    A bitmap holds 32,768 numbers, so dense numbers make few of them; see ``numbered`` for text. Nulls are in no set.
    """
    groups = [F.col(f"`{c}`") for c in by]
    known = df.where(F.col(entity).isNotNull())
    places = known.select(*groups, F.bitmap_bucket_number(entity).alias("bucket"), F.bitmap_bit_position(entity).alias("_place"))
    return places.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_place").alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Union of the sets over all columns but ``by``, without the rows they were made of."""
    groups = [F.col(f"`{c}`") for c in by]
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_distinct(bitmaps: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct entities per group, from sets of any finer grouping."""
    groups = [F.col(f"`{c}`") for c in by]
    return merge_bitmaps(bitmaps, by).groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name))


def numbered(df: DataFrame, entity: str, known: DataFrame | None = None) -> DataFrame:
    """``(entity, number)``: a number from 1 on for every distinct value, those ``known`` keep theirs.

    Numbers run within the tasks that gave them, in blocks of equal width, so they are dense but for the blocks' ends.
    """
    fresh = df.select(entity).where(F.col(entity).isNotNull()).distinct()
    if known is not None:
        fresh = fresh.join(known, entity, "left_anti")
    fresh = cut_lineage(fresh)
    placed = fresh.select(entity, F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_at"))
    # The lower 33 bits count within a task.
    placed = cut_lineage(placed.withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    widest = placed.agg(F.max("_at")).first()[0]
    start = 0 if known is None else known.agg(F.max("number")).first()[0] or 0
    own = placed.select(entity, (F.lit(start + 1) + F.col("_task").cast("long") * F.lit((widest or 0) + 1) + F.col("_at")).alias("number"))
    return own if known is None else known.select(entity, "number").unionByName(own)
