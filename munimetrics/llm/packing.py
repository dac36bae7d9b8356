"""Packing by the sum-of-squares rule: tokenised documents into fixed-length sequences with little padding.

Each task packs the rows it has read, with no shuffle. Full sequences are cut off a long document first; the
remainder goes to the fill level that keeps the sum of the squared numbers of partially filled sequences least, which
an array of counts per level decides. When a task ends, its open sequences are merged by cutting pieces, so that at
most one sequence per task is not full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.tokens import TextEncoder, text_batches

LENGTH = 2048
#: Open sequences that a task keeps before it merges them.
OPEN = 4096
_IDS_BYTES = 8 << 20

Piece = tuple[object, int, bytes, int]  # document, start in it, ids, ids of the document


class Packer:
    """Sum-of-squares packing of one task. ``put`` and ``close`` give finished pieces as ``(piece, sequence, offset)``."""

    def __init__(self, length: int = LENGTH, base: int = 0):
        self.length, self.next = length, base
        self.level = np.zeros(length + 1, np.int64)  # open sequences filled so far; none at 0 and at the full length
        self.open: dict[int, list[list[Piece]]] = {}
        self.count = 0

    def _finish(self, pieces: list[Piece]) -> Iterator[tuple[Piece, int, int]]:
        offset = 0
        for piece in pieces:
            yield piece, self.next, offset
            offset += len(piece[2]) // 4
        self.next += 1

    def put(self, document: object, ids: bytes) -> Iterator[tuple[Piece, int, int]]:
        total, start = len(ids) // 4, 0
        while total - start >= self.length:
            yield from self._finish([(document, start, ids[4 * start : 4 * (start + self.length)], total)])
            start += self.length
        if start < total:
            yield from self._place((document, start, ids[4 * start :], total))
            if self.count > OPEN:
                yield from self._merge(False)

    def _place(self, piece: Piece) -> Iterator[tuple[Piece, int, int]]:
        size, level = len(piece[2]) // 4, self.level
        # Moving a sequence from fill h to h + size changes the sum of squares by 2 (N[h + size] - N[h] + 1);
        # a new sequence leaves no level, a filled one enters none.
        enter = level[size:].copy()
        gain = 2 * enter[: self.length - size + 1] + 1
        gain[-1] = 0
        leave = 2 * level[: self.length - size + 1] - 1
        leave[0] = 0
        cost = np.where(level[: self.length - size + 1] > 0, gain - leave, np.iinfo(np.int64).max)
        cost[0] = gain[0]
        fill = len(cost) - 1 - int(cost[::-1].argmin())  # of equal costs the fullest
        pieces = self._take(fill) if fill else []
        pieces.append(piece)
        if fill + size == self.length:
            yield from self._finish(pieces)
        else:
            self._keep(fill + size, pieces)

    def _take(self, fill: int) -> list[Piece]:
        self.level[fill] -= 1
        self.count -= 1
        return self.open[fill].pop()

    def _keep(self, fill: int, pieces: list[Piece]) -> None:
        self.open.setdefault(fill, []).append(pieces)
        self.level[fill] += 1
        self.count += 1

    def _merge(self, last: bool) -> Iterator[tuple[Piece, int, int]]:
        """Fill up the fullest open sequences with pieces cut from the emptiest; with ``last`` give the rest too."""
        fills = np.flatnonzero(self.level)
        waiting = [pieces for f in fills[::-1] for pieces in self.open[int(f)]]
        self.level[:] = 0
        self.open, self.count = {}, 0
        flow = [p for pieces in waiting for p in pieces]
        own, room = [], self.length
        for document, start, ids, total in flow:
            while ids:
                cut = ids[: 4 * room]
                own.append((document, start, cut, total))
                start, ids, room = start + len(cut) // 4, ids[len(cut) :], room - len(cut) // 4
                if not room:
                    yield from self._finish(own)
                    own, room = [], self.length
        if own and last:
            yield from self._finish(own)
        elif own:
            self._keep(self.length - room, own)

    def close(self) -> Iterator[tuple[Piece, int, int]]:
        yield from self._merge(True)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = 1
) -> DataFrame:
    """One row per piece: ``(id, start, length, ids, doc_tokens, sequence_id, offset)``.

    ``ids`` are the piece's token ids, little-endian unsigned 32-bit; a document is its ids and then ``end_id``, so
    a null or empty text is one id. Each id lies in exactly one piece; the pieces of a sequence follow each other
    from offset 0 and leave room only in the last sequence of a task, which is padded up to ``length`` (or to the
    next power of two, see ``padded_length``). Rows that repeat a document are packed once each. An empty table
    gives no piece. The sequence number holds the task's number in its upper bits; the result is decided by the
    order of rows in a task, so write it down before reading it twice.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TextEncoder(tokenizer)
        packer = Packer(length, TaskContext.get().partitionId() << 32)
        done, held, of = [], 0, pa.int64()

        def batch() -> pa.RecordBatch:
            pieces, numbers, offsets = zip(*done)
            document, start, ids, total = zip(*pieces)
            return pa.RecordBatch.from_arrays(
                [pa.array(document, of), pa.array(start, pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array(numbers, pa.int64()),
                 pa.array(offsets, pa.int64())],
                names,
            )

        def flow() -> Iterator[tuple[Piece, int, int]]:
            nonlocal of
            for part in text_batches(batches, 1):
                of = part.column(0).type
                ids, starts, ends = known.encode(part.column(1))
                for document, s, e in zip(part.column(0).to_pylist(), starts.tolist(), ends.tolist()):
                    yield from packer.put(document, ids[s:e].tobytes() + end)
            yield from packer.close()

        for item in flow():
            done.append(item)
            held += len(item[0][2]) + 64
            if held > _IDS_BYTES:
                yield batch()
                done, held = [], 0
        if done:
            yield batch()

    shape = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, shape)


def padded_length(filled: int, length: int = LENGTH) -> int:
    """Length of a sequence after padding: the filled ids if that is a power of two, else the full length."""
    return filled if filled and filled & (filled - 1) == 0 else length
