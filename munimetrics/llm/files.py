"""Files of raw bytes through Spark's own sinks and readers, so that any shared store will do.

Rows of bytes are written by the text sink, whose commit protocol makes a file appear once even if a task is tried
again; the line separator stands between the rows. Whole files are read back by the binary reader, in path order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.session import scratch_path

#: Zero bytes may follow a gzip member; readers skip them.
PADDING = "\0"


def write_bytes(rows: DataFrame, column: str, name: str, separator: str = PADDING) -> str:
    """Write the binary ``column``, one file per non-empty partition in row order; the folder is returned."""
    path = scratch_path(rows.sparkSession, name)
    rows.select(F.col(column).cast("string").alias("value")).write.option("lineSep", separator).text(path)
    return path


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` per file."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def members(content: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of a file, zero bytes between them skipped."""
    at, end = 0, len(content)
    while True:
        while at < end and content[at] == 0:
            at += 1
        if at >= end:
            return
        inflate, out = zlib.decompressobj(31), []
        while not inflate.eof:
            part = content[at : at + step]
            if not part:
                raise ValueError("a gzip member ends early")
            out.append(inflate.decompress(part))
            at += len(part)
        at -= len(inflate.unused_data)
        yield b"".join(out)
