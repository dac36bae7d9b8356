"""Helpers shared by the operators: rows of text in Arrow batches, written steps, sizes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.session import cut_lineage, scratch_path

#: The ASCII white space of the contracts, ``[\x20\x09-\x0D]``; ``bytes.split()`` and ``bytes.strip()`` use the same.
WHITE = b" \t\n\x0b\x0c\r"

__all__ = ["WHITE", "byte_texts", "crc_fold", "crc_of", "cut_lineage", "remove_step", "rows_of", "total_bytes", "write_step"]


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; a null counts as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def rows_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``size`` rows, so that what a slice grows into stays bounded."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def crc_of(identifier: int | None) -> int:
    return zlib.crc32(b"" if identifier is None else str(identifier).encode())


def crc_fold(identifier: Column, folds: int) -> Column:
    """crc32 of the identifier as text, modulo ``folds``; a null identifier counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(identifier.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def total_bytes(df: DataFrame, text: str) -> int:
    return int(df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def write_step(rows: DataFrame, name: str) -> str:
    """Write the rows below the shared folder; their path, to be removed when a later step stands."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return path


def remove_step(spark: SparkSession, path: str) -> None:
    """Remove a written step that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def packed(values: np.ndarray) -> bytes:
    """An array as bytes; sorted unsigned keys are stored as differences, which compress better."""
    return np.ascontiguousarray(values).tobytes()
