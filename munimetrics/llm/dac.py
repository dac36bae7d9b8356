"""Token files in directly addressable codes: any token is read without decoding the ones around it.

An id is cut into chunks of eight bits, lowest first, and stored on as many levels as it needs. On each level a
bitmap tells which ids go on; how many of them come before a place, which is where an id continues on the next
level, is read from a rank directory. A file is a row of segments, each followed by ``SEPARATOR``:

    magic ``DACS``, u32 levels, u64 documents, u64 tokens
    i64 identifier per document, u8 1 if the identifier is null, u64 end of each document in tokens
    per level: u64 chunks, the chunks, and but for the last level the bitmap (little bit order, padded to 64 bytes)
    and a u32 count of set bits before each 512 of it

All numbers are little-endian. Identifiers are integers.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from munimetrics.llm.common import rows_of, total_bytes
from munimetrics.llm.files import read_files, write_bytes
from munimetrics.llm.tokens import TextEncoder, text_batches

SEPARATOR = "DACE"
_MAGIC = b"DACS"
_HEAD = struct.Struct("<4sIQQ")
_RUN = 512
SEGMENT_TOKENS = 1 << 20
FILE_BYTES = 32 << 20
#: Text bytes that are encoded at once, beside the sorted texts that the task holds.
BATCH_BYTES = 4 << 20


def encode_segment(identifiers: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment of documents whose token ids ``ids`` are joined; ``ends`` are the documents' ends in them."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        low, more = (rest & 255).astype(np.uint8), rest > 255
        last = not more.any()
        part = struct.pack("<Q", len(low)) + low.tobytes()
        if not last:
            bits = np.packbits(more, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % 64, np.uint8)])
            ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(bits).reshape(-1, 64).sum(1, dtype=np.int64))))
            part += bits.tobytes() + ranks.astype("<u4").tobytes()
        levels.append(part)
        if last:
            break
        rest = rest[more] >> 8
    head = _HEAD.pack(_MAGIC, len(levels), len(identifiers), len(ids))
    names = np.array([0 if i is None else i for i in identifiers], "<i8")
    nulls = np.array([i is None for i in identifiers], np.uint8)
    return b"".join([head, names.tobytes(), nulls.tobytes(), ends.astype("<u8").tobytes(), *levels])


class Segment:
    """A segment at ``at`` of a file's bytes; ``after`` is where the next one starts."""

    def __init__(self, content: bytes, at: int = 0):
        magic, levels, documents, self.tokens = _HEAD.unpack_from(content, at)
        if magic != _MAGIC:
            raise ValueError(f"no segment at byte {at}")
        at += _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, count, at)
            at += found.nbytes
            return found

        names, nulls = take("<i8", documents), take("u1", documents)
        self.identifiers = [None if n else int(i) for i, n in zip(names, nulls)]
        self.ends = take("<u8", documents).astype(np.int64)
        self.chunks, self.bitmaps, self.ranks = [], [], []
        for level in range(levels):
            count = int(take("<u8", 1)[0])
            self.chunks.append(take("u1", count))
            if level + 1 < levels:
                size = -(-count // 8)
                self.bitmaps.append(take("u1", size + -size % 64))
                self.ranks.append(take("<u4", len(self.bitmaps[-1]) // 64 + 1))
        self.after = at + len(SEPARATOR)

    def _rank(self, level: int, place: int) -> int:
        """How many ids before ``place`` of a level go on."""
        run, bitmap = place // _RUN, self.bitmaps[level]
        whole = int(np.bitwise_count(bitmap[run * 64 : place // 8]).sum(dtype=np.int64))
        part = int(bitmap[place // 8]) & ((1 << place % 8) - 1) if place % 8 else 0
        return int(self.ranks[level][run]) + whole + part.bit_count()

    def token(self, place: int) -> int:
        value = 0
        for level in range(len(self.chunks)):
            value |= int(self.chunks[level][place]) << (8 * level)
            if level == len(self.bitmaps) or not self.bitmaps[level][place // 8] >> (place % 8) & 1:
                return value
            place = self._rank(level, place)
        return value

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to ``end``; only their own chunks are touched."""
        out, where = np.zeros(end - start, np.uint32), np.arange(end - start)
        for level in range(len(self.chunks)):
            out[where] |= self.chunks[level][start:end].astype(np.uint32) << np.uint32(8 * level)
            if level == len(self.bitmaps) or start == end:
                break
            first = start // 8
            more = np.unpackbits(self.bitmaps[level][first : -(-end // 8)], bitorder="little")[start - 8 * first :]
            where = where[more[: end - start] > 0]
            start = self._rank(level, start)
            end = start + len(where)
        return out

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        start = 0
        for identifier, end in zip(self.identifiers, self.ends.tolist()):
            yield identifier, start, self.slice(start, end)
            start = end


def segments(content: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(content):
        segment = Segment(content, at)
        yield segment
        at = segment.after


def write_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
    segment_tokens: int = SEGMENT_TOKENS,
) -> str:
    """Write the token ids of every text, each followed by ``end_id``, in ascending identifier order; returns the folder.

    A null text counts as empty; a null identifier comes first; rows that repeat an identifier are all written,
    ordered by the hash of their text, and may lie in several files. Files follow each other by their number; an empty
    table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = TextEncoder(tokenizer), np.array([end_id], "<u4").tobytes()
        names, parts, held = [], [], 0

        def batch() -> pa.RecordBatch:
            ends = np.cumsum([len(p) // 4 for p in parts])
            body = encode_segment(names, ends, np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["segment"])

        for part in text_batches(batches, 1, BATCH_BYTES):
            ids, starts, ends = known.encode(part.column(1))
            for name, s, e in zip(part.column(0).to_pylist(), starts.tolist(), ends.tolist()):
                names.append(name)
                parts.append(ids[s:e].tobytes() + end)
                held += len(parts[-1]) // 4
                if held >= segment_tokens:
                    yield batch()
                    names, parts, held = [], [], 0
        if names:
            yield batch()

    count = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total_bytes(docs, text_col) // FILE_BYTES)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Rows of one identifier, or of none, are dealt out by their text, equal rows by where they were read.
    ordered = rows.select("*", F.xxhash64("text").alias("key0"), F.monotonically_increasing_id().alias("key1"))
    ordered = ordered.repartitionByRange(count, "id", "key0", "key1").sortWithinPartitions("id", "key0", "key1").select("id", "text")
    return write_bytes(ordered.mapInArrow(run, "segment binary"), "segment", "tokens", SEPARATOR)


def tokens_before(path: Column, tokens: Column) -> Column:
    """Sum of ``tokens`` over the files of lower number; numbers of more than five digits do not order by name."""
    number = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).cast("long")
    return F.coalesce(F.sum(tokens).over(Window.orderBy(number, path).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` per document of the files below ``path``; ``start`` counts all ids before."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            tokens = [sum(s.tokens for s in segments(c)) for c in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tokens, pa.int64())], ["path", "tokens"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, 1):
            before, out = 0, ([], [], [], [])
            for segment in segments(part.column(1)[0].as_py()):
                for name, start, ids in segment.documents():
                    for column, value in zip(out, (name, before + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        column.append(value)
                before += segment.tokens
            path = pa.array([part.column(0)[0].as_py()] * len(out[0]), pa.string())
            yield pa.RecordBatch.from_arrays(
                [path, *(pa.array(c, pa.int64()) for c in out)], ["path", "id", "inner", "n_tokens", "ids_crc32"]
            )

    files = read_files(spark, path)
    # One row per file: the only thing that passes through one task.
    before = files.mapInArrow(sizes, "path string, tokens long").select("path", tokens_before(F.col("path"), F.col("tokens")).alias("base"))
    found = files.mapInArrow(rows, "path string, id long, inner long, n_tokens long, ids_crc32 long")
    return found.join(before, "path").select("id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
