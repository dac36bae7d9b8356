"""Joins. No side is forced to broadcast: Spark broadcasts what it has measured to be small."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_matching(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(on), on, "left_semi")


def lookup(
    df: DataFrame, dictionary: DataFrame, key: str, dictionary_key: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Add dictionary columns to the rows of ``df``; a number and a text are compared as numbers.

    The dictionary key is not kept; list it in ``columns`` under another name if it is needed.
    """
    left, right = F.col(f"`{key}`"), F.col(f"`{dictionary_key}`")
    kinds = dict(df.dtypes)[key], dict(dictionary.dtypes)[dictionary_key]
    if kinds[0] != kinds[1] and "string" in kinds:
        # ``05`` is 5; a text that is no number matches nothing.
        exact = all(k in ("string", "tinyint", "smallint", "int", "bigint") for k in kinds)
        left, right = (c.try_cast("bigint" if exact else "double") for c in (left, right))
    side = dictionary.select(right.alias("_lookup"), *columns)
    return df.join(side, left == F.col("_lookup"), how).drop("_lookup")


def star_join(df: DataFrame, lookups: Iterable[tuple[DataFrame, str, str, Sequence[str]]]) -> DataFrame:
    """Left joins of a fact to its dictionaries: ``(dictionary, fact key, dictionary key, columns)``."""
    for dictionary, key, dictionary_key, columns in lookups:
        df = lookup(df, dictionary, key, dictionary_key, columns)
    return df


def inner_chain(df: DataFrame, steps: Iterable[tuple[DataFrame, str, str, Sequence[str]]]) -> DataFrame:
    """Inner joins along a chain: ``(next table, key so far, its key, its columns)``."""
    for table, key, table_key, columns in steps:
        df = lookup(df, table, key, table_key, columns, "inner")
    return df


def prefix_key(code: Column, length: int = 6) -> Column:
    return F.substring(code.cast("string"), 1, length)


def wide_left_joins(
    df: DataFrame, key: str, tables: Mapping[str, tuple[DataFrame, str, Mapping[str, str]]], prefix: int = 6
) -> DataFrame:
    """Left-join many one-row-per-key tables: name -> ``(table, its key column, column -> new name)``.

    The key of each table is cut to ``prefix`` characters first, so every join is a plain equi-join.
    """
    for table, table_key, names in tables.values():
        side = table.select(
            prefix_key(F.col(f"`{table_key}`"), prefix).alias("_prefix"),
            *[F.col(f"`{old}`").alias(new) for old, new in names.items()],
        )
        df = df.join(side, F.col(f"`{key}`") == F.col("_prefix"), "left").drop("_prefix")
    return df


def join_on_parsed_key(
    df: DataFrame, key: str, other: DataFrame, text_key: str, columns: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join an integer key to a text key; text that is no integer matches nothing."""
    side = other.select(F.trim(f"`{text_key}`").try_cast("bigint").alias("_parsed"), *columns)
    side = side.where(F.col("_parsed").isNotNull())
    return df.join(side, F.col(f"`{key}`").try_cast("bigint") == F.col("_parsed"), how).drop("_parsed")


def join_admissions(df: DataFrame, admissions: DataFrame, key: str = "codigo_municipio") -> DataFrame:
    """Left join of admissions, whose nulls become zero, after checking that both sides have the key."""
    if key not in df.columns or key not in admissions.columns:
        raise ValueError(f"column {key!r} is needed on both sides of the join")
    return df.join(admissions.na.fill(0), key, "left")


def attach_geometry(
    geometries: DataFrame,
    df: DataFrame,
    geometry_key: str = "code_muni_abrev",
    key: str = "codigo_municipio",
) -> DataFrame:
    """Keep every geometry (a binary column, passed through) and add the data of its municipality."""
    return geometries.join(df, F.col(geometry_key).cast("string") == F.col(key).cast("string"), "left")


def join_pivot(wide: DataFrame, pivoted: DataFrame, key: str, pivot_key: str, how: str = "left") -> DataFrame:
    """Join the pivoted counts to the wide table; ``how`` is ``left`` or ``inner``."""
    side = pivoted.withColumnRenamed(pivot_key, "_pivot_key")
    return wide.join(side, F.col(key) == F.col("_pivot_key"), how).drop("_pivot_key")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once: such a dictionary would multiply rows in a left join."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(df: DataFrame, key: str, name: str = "table") -> DataFrame:
    if not repeated_keys(df, key).isEmpty():
        raise ValueError(f"{name}: {key} is not unique")
    return df
