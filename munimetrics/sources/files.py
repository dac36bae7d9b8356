"""File scans: delimited and Parquet registries, state sheets, snapshot dates taken from file names."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics import config
from munimetrics.functions.text import dash_as_zero
from munimetrics.session import cut_lineage

# Written for a value that is absent, so that an empty string stays an empty string.
NULL_MARK = "\\N"
# Registries double a quote inside quotes; a backslash is a character like any other.
CSV_OPTIONS = {"sep": ";", "encoding": "ISO-8859-1", "header": True, "nullValue": NULL_MARK, "quote": '"', "escape": '"'}

# Last six digits of a file stem; the "file" may be a dataset folder with part files inside.
SNAPSHOT_PATTERN = r"(\d{4})(\d{2})\.[A-Za-z]+(?:\.(?:gz|bz2|zst|lz4|snappy|deflate|xz))?(?:/[^/]*)?$"
STEM_PATTERN = r"([^/]+)\.[^./]+$"


def scan_delimited(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Registry CSV: ``;``, Latin-1, header; every column stays a string so leading zeros survive.

    Quoted empty fields are read as ``''`` and unquoted ones as null. All files under ``path`` must
    share one header; read months with different columns one by one and use ``union_aligned``. Quotes
    inside a quoted field are doubled. For line breaks inside quotes pass ``multiLine=True``; such a file
    is read by one task.
    """
    return spark.read.options(**{**CSV_OPTIONS, **options}).csv(path)


def scan_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, condition: Column | None = None
) -> DataFrame:
    """Parquet scan with the filter and the columns handed to the reader."""
    df = spark.read.parquet(path)
    if condition is not None:
        df = df.where(condition)
    return df.select(*columns) if columns else df


def scan_file(spark: SparkSession, path: str) -> DataFrame:
    """Choose the scan by file extension; an unknown extension is an error."""
    extension = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    if extension == "parquet":
        return scan_parquet(spark, path)
    if extension == "csv":
        return scan_delimited(spark, path)
    raise ValueError(f"unsupported file extension: {extension!r}")


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """Paths below ``folder`` that end in ``suffix``; file contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select("path", "length")


def base_table_name(file_name: Column) -> Column:
    """Letters of the file stem in lower case: every month of a table gets the same name."""
    return F.lower(F.regexp_replace(F.regexp_extract(file_name, STEM_PATTERN, 1), r"[^\p{L}]", ""))


def snapshot_date(file_name: Column) -> Column:
    """``yyyy-MM-01`` from the last six digits of the file stem, null if it does not end in six digits."""
    year = F.regexp_extract(file_name, SNAPSHOT_PATTERN, 1)
    month = F.regexp_extract(file_name, SNAPSHOT_PATTERN, 2)
    return F.when(year != "", F.concat(year, F.lit("-"), month, F.lit("-01")))


def with_snapshot_date(df: DataFrame, file_name: str | None = None, name: str = "data_competencia") -> DataFrame:
    """Add the snapshot date of each row's own file, or of ``file_name`` for rows not read from files."""
    source = F.lit(file_name) if file_name else F.col("_metadata.file_path")
    return df.withColumn(name, snapshot_date(source))


@dataclass
class HeaderPlan:
    """The distinct headers of a folder's files, and which file has which.

    ``files`` holds ``(path, base, month, header)`` per file and stays a table; ``headers`` gives, for each base name, the
    columns of every distinct header line by its text: as many as there are kinds of files, however many files.
    """

    folder: str
    suffix: str
    files: DataFrame
    headers: dict[str, dict[str, list[str]]]


#: A character that no line holds: with it as separator and no quotes a line is one field.
_NO_SEPARATOR = "\x01"


def _line_order() -> Column:
    """Orders the lines of a file: by the split that read them, then by their place in it."""
    return F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))


def _raw_lines(spark: SparkSession, folder: str, suffix: str, encoding: str) -> DataFrame:
    options = {"sep": _NO_SEPARATOR, "quote": "", "header": False, "encoding": encoding, "pathGlobFilter": f"*{suffix}"}
    return spark.read.options(recursiveFileLookup=True, **options).schema("line string").csv(folder)


def plan_headers(
    spark: SparkSession, folder: str, suffix: str = ".csv", file_name: Callable[[Column], Column] = lambda path: path, **options
) -> HeaderPlan:
    """Read the first line of every file below ``folder`` in tasks and group the files by it.

    ``file_name`` gives the name that tells table and month from a path. Only distinct header lines reach the driver.
    """
    chosen = {**CSV_OPTIONS, **options}
    lines = _raw_lines(spark, folder, suffix, chosen["encoding"])
    starts = lines.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("path"), "line", _line_order().alias("place")
    )
    first = starts.groupBy("path").agg(F.min_by("line", "place").alias("header"))
    name = file_name(F.col("path"))
    files = cut_lineage(first.select("path", base_table_name(name).alias("base"), snapshot_date(name).alias("month"), "header"))
    headers: dict[str, dict[str, list[str]]] = {}
    for row in files.select("base", "header").distinct().orderBy("base", "header").collect():
        cells = next(csv.reader([row["header"]], delimiter=chosen["sep"], quotechar=chosen["quote"]))
        columns = [c if c else f"_c{n}" for n, c in enumerate(cells)]
        if len({c.lower() for c in columns}) < len(columns):
            raise ValueError(f"a header of {row['base']!r} names a column twice: {row['header']!r}")
        headers.setdefault(row["base"], {})[row["header"]] = columns
    return HeaderPlan(folder, suffix, files, headers)


def scan_planned(
    spark: SparkSession, plan: HeaderPlan, base: str, file_name: Callable[[Column], Column] = lambda path: path,
    name: str = "data_competencia", **options,
) -> DataFrame:
    """All files of a table in one scan, each row under the columns of its own file's header, with the file's month.

    Fields are read by position; a row finds its header through the table of files. Columns that a file lacks are null,
    columns come out sorted. The reader lists the folder and leaves out the files of other tables by their name, so that
    no list of paths is made here.
    """
    headers = plan.headers[base]
    widest = max(map(len, headers.values()))
    fields = ", ".join(f"`_p{n}` string" for n in range(widest))
    reader = spark.read.options(**{**CSV_OPTIONS, **options}, recursiveFileLookup=True, pathGlobFilter=f"*{plan.suffix}")
    path = F.col("_metadata.file_path")
    rows = reader.schema(fields).csv(plan.folder).where(base_table_name(file_name(path)) == base)
    own = plan.files.where(F.col("base") == base).select(F.col("path").alias("_path"), "month", "header")
    rows = rows.withColumn("_path", path).join(own, "_path")
    columns = sorted({c for names in headers.values() for c in names})

    def value(column: str) -> Column:
        out = F.lit(None).cast("string")
        for header, names in headers.items():
            if column in names:
                out = F.when(F.col("header") == header, F.col(f"_p{names.index(column)}")).otherwise(out)
        return out.alias(column)

    found = {c: value(c) for c in columns} | {name: F.col("month").alias(name)}
    return rows.select(*(found[c] for c in sorted(found)))


def _text_wins(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """Columns that are text in one frame become text in all: a number and a text have no other common type."""
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    texts = {name for name, found in kinds.items() if len(found) > 1 and "string" in found}
    return [f.withColumns({c: F.col(f"`{c}`").cast("string") for c in f.columns if c in texts}) for f in frames]


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name: missing columns become null, types widen, columns come out sorted."""
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), _text_wins(frames))
    return merged.select(*[F.col(f"`{c}`") for c in sorted(merged.columns)])


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with the same columns: numbers widen to a common type, with text they become text."""
    return reduce(lambda left, right: left.unionByName(right), _text_wins(frames))


def scan_city_sheets(
    spark: SparkSession, path: str, state_pattern: str = r"([^/]+)\.[^./]+$", sep: str = ","
) -> DataFrame:
    """Per-state city sheets, saved as delimited text, to clean typed rows.

    A sheet has title lines, a header, 13 positional columns and footer notes. The header is the first row of which a
    cell is one of ``config.CITY_SHEET_MARKS``, however many lines stand before it; rows are the lines behind it that have
    a code which does not hold the footer mark. Blanks around a code go, and the ``.0`` that sheet exports put behind
    whole numbers. The state comes from the file path by ``state_pattern``. A sheet without a header is an error.
    """
    fields = ", ".join(f"`{c}` string" for c in config.CITY_SHEET_COLUMNS)
    raw = spark.read.option("recursiveFileLookup", True).options(sep=sep).schema(fields).csv(path)
    cells = [F.trim(F.col(f"`{c}`")) for c in config.CITY_SHEET_COLUMNS]
    marked = F.exists(F.array(*cells), lambda cell: cell.isin(config.CITY_SHEET_MARKS))
    # Written once, so that a line has one place however often it is read.
    placed = cut_lineage(raw.select("*", F.col("_metadata.file_path").alias("_path"), _line_order().alias("_place"), marked.alias("_marked")))
    headers = placed.groupBy("_path").agg(F.min(F.when(F.col("_marked"), F.col("_place"))).alias("_header"))
    missing = F.raise_error(F.concat(F.lit("no header row in "), F.col("_path")))
    below = placed.join(headers, "_path").where(F.coalesce(F.col("_place") > F.col("_header"), missing.cast("boolean")))
    code = F.regexp_replace(F.trim("codigo_municipio"), r"^(\d+)\.0+$", "$1")
    rows = drop_footer(below.withColumn("codigo_municipio", F.nullif(code, F.lit(""))), "codigo_municipio")
    rows = rows.withColumn("uf", F.upper(F.regexp_extract("_path", state_pattern, 1)))
    numbers = {c: dash_as_zero(F.col(c)).cast("double") for c in config.CITY_NUMERIC_COLUMNS}
    return rows.drop(*config.CITY_SHEET_UNUSED, "_path", "_place", "_marked", "_header").withColumns(numbers)


def drop_footer(df: DataFrame, column: str, mark: str = "Notas") -> DataFrame:
    """Drop rows without a value in ``column`` and rows whose value contains the footer mark."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).contains(mark))
