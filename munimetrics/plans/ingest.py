"""Registry ingest: monthly files to one clean Parquet table each, never written over the files being read."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.functions.scalars import recode_columns, remap_codes
from munimetrics.functions.text import title_case_strings
from munimetrics.operators.dedup import dedup_ignoring_snapshot, latest_per_key
from munimetrics.operators.joins import lookup
from munimetrics.sources.files import (
    STEM_PATTERN, base_table_name, list_files, plan_headers, scan_city_sheets, scan_file, scan_planned, union_aligned, with_snapshot_date,
)
from munimetrics.sources.tables import load_cities, write_parquet


def snapshot_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> dict[str, list[str]]:
    """Files of each registry table below ``folder``, in order of their names."""
    files = list_files(spark, folder, suffix).select(base_table_name(F.col("path")).alias("base"), "path")
    tables: dict[str, list[str]] = {}
    for row in files.orderBy("path").collect():
        tables.setdefault(row["base"], []).append(row["path"])
    return tables


def fix_codes(df: DataFrame) -> DataFrame:
    """Codes of managing state and municipality as text; districts of the capital become the capital."""
    if "CO_ESTADO_GESTOR" not in df.columns:
        return df
    return df.withColumns(
        {
            "CO_ESTADO_GESTOR": F.col("CO_ESTADO_GESTOR").cast("string"),
            "CO_MUNICIPIO_GESTOR": remap_codes(
                F.col("CO_MUNICIPIO_GESTOR"), config.DISTRICT_CODES, config.CAPITAL_DISTRICT_CODE
            ),
        }
    )


def monthly_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All months of a table under one set of columns, each row with its month."""
    months = [fix_codes(with_snapshot_date(scan_file(spark, p))) for p in paths]
    return union_aligned(months)


def clean_facilities(df: DataFrame) -> DataFrame:
    """Latest row of each facility with first and last month seen; inactive facilities stay in."""
    kept = df.select(*config.FACILITY_COLUMNS)
    return latest_per_key(kept, "CO_CNES")


def clean_table(name: str, df: DataFrame) -> DataFrame:
    """Repeats removed as each table needs it; other tables pass through."""
    if name == "tbestabelecimento":
        return clean_facilities(df)
    return dedup_ignoring_snapshot(df) if name in config.DEDUPLICATED_TABLES else df


def ingest_registry(spark: SparkSession, raw_folder: str, out_folder: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    """Read, align, clean and write every monthly registry table; returns the written tables by name.

    Delimited files are read in one scan a table, whatever their number and headers; Parquet files one by one. Tables of
    one row per month are partitioned by it, so that a job on one month reads that month's files only.
    """
    written, read = {}, {}
    if suffix == ".csv":
        plan = plan_headers(spark, raw_folder, suffix)
        read = {name: fix_codes(scan_planned(spark, plan, name)) for name in plan.headers}
    else:
        read = {name: monthly_table(spark, paths) for name, paths in snapshot_files(spark, raw_folder, suffix).items()}
    for name, table in read.items():
        cleaned = clean_table(name, table)
        monthly = [] if name == "tbestabelecimento" else ["data_competencia"]
        written[name] = write_parquet(cleaned, os.path.join(out_folder, name), monthly)
    return written


def clean_deaths(deaths: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Decoded death records, every text title-cased after decoding, with the name of the municipality."""
    decoded = title_case_strings(recode_columns(deaths))
    return lookup(decoded, municipalities, "CODMUNOCOR", "CO_MUNICIPIO", ["NO_MUNICIPIO", "CO_SIGLA_ESTADO"])


def ingest_cities(spark: SparkSession, sheet_folder: str, out_path: str) -> DataFrame:
    return load_cities(scan_city_sheets(spark, sheet_folder), out_path)


def ingest_deaths(spark: SparkSession, path: str, municipalities: DataFrame, out_path: str) -> DataFrame:
    return write_parquet(clean_deaths(scan_file(spark, path), municipalities), out_path)


def ingest_census(spark: SparkSession, folder: str, out_folder: str, suffix: str = ".csv") -> dict[str, DataFrame]:
    """Census tables saved as CSV, one file each: ``codigo`` stays text, every other column is a number or blank.

    Any other text in a number's place is an error.
    """
    files = list_files(spark, folder, suffix).select(F.regexp_extract("path", STEM_PATTERN, 1).alias("name"), "path")
    written = {}
    for row in files.orderBy("path").collect():
        table = scan_file(spark, row["path"])
        numbers = {c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).cast("double") for c in table.columns if c != "codigo"}
        written[row["name"]] = write_parquet(table.withColumns(numbers), os.path.join(out_folder, row["name"]))
    return written


def register_tables(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Expose tables to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
