"""Sinks and tables: Parquet, CSV, catalog tables and run metadata. All writes replace, so reruns are safe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from munimetrics import config
from munimetrics.session import cut_lineage
from munimetrics.sources.files import CSV_OPTIONS


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write and return the written table, so later steps start from files and not from the lineage.

    Rows are rebalanced on the partition columns: a large partition is split over several files and
    tasks, small ones do not leave a file per task.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    # Partition columns are kept in folder names: without the schema their types would be guessed.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_delimited(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Registry-style CSV: empty strings quoted, nulls marked."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out.write.mode("overwrite").partitionBy(*partition_by).options(**CSV_OPTIONS, emptyValue='""').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated UTF-8 with a header; a quote inside quotes is doubled."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(header=True, escape='"', enforceSchema=False).csv(path)


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table, in the warehouse or at ``path``."""
    df.write.mode("overwrite").options(**({"path": path} if path else {})).saveAsTable(name)
    return df.sparkSession.table(name)


def find_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name in any letter case; ``FileNotFoundError`` if there is none."""
    if not spark.catalog.tableExists(name):
        raise FileNotFoundError(f"no table or view named {name!r}")
    return spark.table(name)


def city_rows(sheets: DataFrame) -> DataFrame:
    """City table columns with the municipality code cut to its six-digit form."""
    return sheets.withColumn("codigo_municipio", F.substring("codigo_municipio", 1, 6)).select(
        *config.CITY_TABLE_COLUMNS
    )


def load_cities(sheets: DataFrame, path: str) -> DataFrame:
    """Replace the city table at ``path``; loading twice leaves one copy of each row."""
    return write_parquet(city_rows(sheets), path)


def run_metadata(spark: SparkSession, meta: dict) -> DataFrame:
    """One row, one column ``meta``: run parameters, selected features and scores as JSON.

    The dictionary may hold scalars, lists of strings, string-keyed dictionaries of such, and None.
    """
    return spark.range(1).select(F.to_json(_json_struct(meta), {"ignoreNullFields": "false"}).alias("meta"))


def _json_struct(value):
    if isinstance(value, dict):
        return F.struct(*[_json_struct(v).alias(str(k)) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value]).cast("array<string>")
    return F.lit(value)


def write_metadata(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def _manifest(path: str) -> str:
    return path.rstrip("/") + "_manifest"


def _told(df: DataFrame, month: str) -> DataFrame:
    """Rows and an order-free sum of row hashes per month."""
    others = [F.col(f"`{c}`") for c in sorted(df.columns) if c != month]
    hashed = F.xxhash64(*others).cast("decimal(20,0)")
    return df.groupBy(month).agg(F.count(F.lit(1)).alias("rows"), F.sum(hashed).cast("decimal(38,0)").alias("hashes"))


def load_months(df: DataFrame, path: str, month: str = "data_competencia", months: Sequence[str] = ()) -> DataFrame:
    """Replace the months that ``df`` holds, and those named in ``months``, in the table at ``path``; others stay.

    Only these months' folders are written, so a rerun of one month costs that month. A manifest beside the table tells the
    rows and hashes of each month as loaded; it is written after the rows. A named month without rows has none
    afterwards. Returns the table as ``read_months`` does. Months are text; ``df`` must not read from the table.
    """
    spark = df.sparkSession
    told = _told(df, month)
    if months:
        named = spark.createDataFrame([(m,) for m in months], f"`{month}` string")
        empty = named.join(told, month, "left_anti").select(month, F.lit(0).cast("long").alias("rows"), F.lit(None).cast("decimal(38,0)").alias("hashes"))
        told = told.unionByName(empty)
    told = cut_lineage(told)

    def replace(rows: DataFrame, place: str) -> None:
        writer = rows.hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(month).parquet(place)

    replace(df, path)
    replace(told, _manifest(path))
    return read_months(spark, path, df.schema, month)


def _loaded(spark: SparkSession, path: str, month: str) -> DataFrame:
    return spark.read.schema(f"rows long, hashes decimal(38,0), `{month}` string").parquet(_manifest(path))


def read_months(spark: SparkSession, path: str, schema: StructType, month: str = "data_competencia") -> DataFrame:
    """The table at ``path`` without months whose last load had no rows."""
    emptied = _loaded(spark, path, month).where("rows = 0").select(F.col(month).alias("_month"))
    table = spark.read.schema(schema).parquet(path)
    return table.join(emptied, F.col(month).eqNullSafe(F.col("_month")), "left_anti")


def months_out_of_step(spark: SparkSession, path: str, schema: StructType, month: str = "data_competencia") -> DataFrame:
    """Months whose rows are not those of the manifest, as after a load that broke off: load these again."""
    here = _told(read_months(spark, path, schema, month), month).select(F.col(month).alias("_month"), F.struct("rows", "hashes").alias("_here"))
    told = _loaded(spark, path, month).where("rows > 0").select(month, F.struct("rows", "hashes").alias("_told"))
    both = told.join(here, F.col(month).eqNullSafe(F.col("_month")), "full")
    return both.where(~F.col("_told").eqNullSafe(F.col("_here"))).select(F.coalesce(month, "_month").alias(month))
