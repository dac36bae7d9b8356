"""Removing repeats of monthly snapshots, with a fixed choice of the row that stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_ignoring_snapshot(df: DataFrame, snapshot: str = "data_competencia") -> DataFrame:
    """Rows that differ in the snapshot date only become one row with the latest date.

    An aggregate: repeats collapse before the shuffle, and null equals null. A snapshot kept as text makes
    Spark sort each task's rows for it.
    """
    others = [c for c in df.columns if c != snapshot]
    return df.groupBy(*[F.col(f"`{c}`") for c in others]).agg(F.max(snapshot).alias(snapshot)).select(*df.columns)


def snapshot_report(df: DataFrame, reference: str, snapshot: str = "data_competencia") -> DataFrame:
    """Row counts before and after removing repeats, next to those of one snapshot. One row, one shuffle."""
    others = [F.col(f"`{c}`") for c in df.columns if c != snapshot]
    per_row = df.groupBy(*others).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(snapshot) == reference).alias("n_reference")
    )
    total = per_row.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum("n_reference"), F.lit(0)).alias("rows_reference"),
    )
    return total.withColumn("unchanged", F.col("rows_after") == F.col("rows_reference"))


def _age(snapshot: Column, data_type: str) -> Column:
    """Smaller for later snapshots; null counts as the earliest."""
    if data_type == "string":
        number = F.unix_date(snapshot.try_cast("date")).cast("long")
    elif data_type == "date":
        number = F.unix_date(snapshot).cast("long")
    elif data_type.startswith("timestamp"):
        number = F.unix_micros(snapshot.cast("timestamp"))
    else:
        number = snapshot.cast("long")
    return F.coalesce(-number, F.lit(2**63 - 1))


def latest_per_key(
    df: DataFrame,
    key: str,
    snapshot: str = "data_competencia",
    tie_break: Sequence[str] = ("CO_UNIDADE",),
    first: str = "data_primeiro_registro",
    last: str = "data_ultimo_registro",
) -> DataFrame:
    """The latest row of each key, ties by the smallest ``tie_break``, with first and last snapshot dates.

    ``min_by`` keeps one candidate per key and map task, so no key is gathered in one place. Its buffer is
    a whole row, which Spark aggregates by sorting each task's rows. Rows with a null key are dropped, as by
    ``first_last_seen``.
    """
    order = F.struct(_age(F.col(snapshot), dict(df.dtypes)[snapshot]), *[F.col(c) for c in tie_break])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    chosen = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.min_by(row, order).alias("_row"), F.min(snapshot).alias(first), F.max(snapshot).alias(last)
    )
    return chosen.select("_row.*", first, last)


def first_last_seen(
    df: DataFrame,
    key: str,
    snapshot: str = "data_competencia",
    first: str = "data_primeiro_registro",
    last: str = "data_ultimo_registro",
) -> DataFrame:
    """Every row with the first and last snapshot date of its key.

    Aggregate and join back instead of a window: a large key is then an ordinary skewed join side, which
    adaptive execution splits. Rows with a null key have no dates to join and are dropped.
    """
    seen = df.groupBy(key).agg(F.min(snapshot).alias(first), F.max(snapshot).alias(last))
    return df.join(seen, key, "inner").select(*df.columns, first, last)
