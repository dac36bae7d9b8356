"""Vector compression: every part of a vector becomes the number of its nearest entry in a small codebook.

Codebooks are learnt in rounds of assignment and averaging over all rows, in integers. A part carries its entry, an
upper bound of the distance to it and a lower bound of the distance to all others, each with the round in which it
was exact. All earlier codebooks are kept, so a bound is carried on by the length of the sum of an entry's moves since
that round (its true net displacement), which is never more than the sum of their lengths. Only parts whose bounds
meet are measured again: first to their own entry, then, if need be, to all.

Rows travel in packed chunks that are rewritten each round with their bounds; the chunks of the round before are removed
once the new ones stand. The driver sees sums per codebook entry, as many numbers as the codebooks hold.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from munimetrics.llm.common import remove_step, rows_of, write_step
from munimetrics.session import cut_lineage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components of a chunk.
_CHUNK = 1 << 20
#: Sums are added up in limbs of 32 bits, each with the sum's sign, which Spark's 64-bit sums hold for 2^31 tasks; so
#: many limbs hold a sum of the largest floats.
_LIMBS = 36
_LIMB_BITS = 32

Codebook = list[list[list[int]]]  # by part, entry, position


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """``floor(4096 x)``: as floats where these are exact, else as Python integers."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if not len(scaled) or np.abs(scaled).max() < 2.0**31:
        return scaled
    whole = [int(v) * SCALE if abs(v) >= 2.0**52 else math.floor(v * SCALE) for v in values.astype(np.float64).ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(values.shape)


def _exact(vectors: np.ndarray, entries: list[list[int]]) -> bool:
    """Whether squared distances are whole floats below 2^53."""
    most = max((abs(v) for e in entries for v in e), default=0)
    if vectors.dtype != object and vectors.size:
        most = max(most, int(np.abs(vectors).max()))
    return vectors.dtype != object and 4 * most * most * max(1, vectors.shape[1]) < 1 << 53


def squared_distances(vectors: np.ndarray, entries: list[list[int]]) -> np.ndarray:
    """Squared Euclidean distances, rows by entries, exact."""
    if _exact(vectors, entries):
        own = np.array(entries, np.float64)
        return (vectors**2).sum(1)[:, None] - 2 * (vectors @ own.T) + (own**2).sum(1)[None]
    whole = vectors if vectors.dtype == object else vectors.astype(np.int64).astype(object)
    own = np.empty((len(entries), vectors.shape[1]), object)
    own[:] = entries
    return np.stack([((whole - e) ** 2).sum(1) for e in own], 1)


class Bounds:
    """Entry, bounds and their rounds of the parts of one chunk at one part position."""

    KINDS = (("entry", "u1"), ("upper", "<f4"), ("lower", "<f4"), ("upper_round", "u1"), ("lower_round", "u1"))

    def __init__(self, count: int):
        self.entry = np.zeros(count, "u1")
        self.upper, self.lower = np.full(count, np.inf, "<f4"), np.zeros(count, "<f4")
        self.upper_round, self.lower_round = np.zeros(count, "u1"), np.zeros(count, "u1")
        self.measured = self.rescanned = 0

    def advance(self, vectors: np.ndarray, history: list[list[list[int]]]) -> None:
        """Assign to the last codebook of ``history``; ties go to the lower number."""
        now, current = len(history) - 1, history[-1]
        if not _exact(vectors, current):
            self._rescan(np.arange(len(vectors)), vectors, current, now)
            return
        books = np.array(history, np.float64)
        # Net displacement of every entry since every round, and the largest among the others of an entry.
        moved = np.sqrt(((books[-1] - books) ** 2).sum(2)) * (1 + 1e-9)
        others = np.repeat(moved[:, None, :], moved.shape[1], 1)
        others[:, np.arange(moved.shape[1]), np.arange(moved.shape[1])] = 0
        others = others.max(2)
        lower = self.lower - others[self.lower_round, self.entry]
        open_ = np.flatnonzero(~(self.upper + moved[self.upper_round, self.entry] < lower))
        if len(open_):
            self.measured += len(open_)
            own = np.sqrt(((vectors[open_] - books[-1][self.entry[open_]]) ** 2).sum(1))
            self.upper[open_] = np.nextafter(own.astype("<f4"), np.float32(np.inf))
            self.upper_round[open_] = now
            open_ = open_[~(self.upper[open_] < lower[open_])]
            self._rescan(open_, vectors[open_], current, now)

    def _rescan(self, rows: np.ndarray, vectors: np.ndarray, current: list[list[int]], now: int) -> None:
        if not len(rows):
            return
        self.rescanned += len(rows)
        distances = squared_distances(vectors, current)
        nearest = distances.argmin(1)
        self.entry[rows] = nearest
        self.upper_round[rows] = self.lower_round[rows] = now
        if distances.dtype == object:  # too long for floats: always measured again
            self.upper[rows], self.lower[rows] = np.inf, 0
            return
        ordered = np.partition(distances, 1, 1) if distances.shape[1] > 1 else np.column_stack((distances[:, 0], np.full(len(rows), np.inf)))
        self.upper[rows] = np.nextafter(np.sqrt(ordered[:, 0]).astype("<f4"), np.float32(np.inf))
        self.lower[rows] = np.maximum(np.nextafter(np.sqrt(ordered[:, 1]).astype("<f4"), np.float32(-np.inf)), 0)

    def pack(self) -> bytes:
        return b"".join(getattr(self, name).tobytes() for name, _ in self.KINDS)

    @classmethod
    def unpack(cls, content: bytes, at: int, count: int) -> tuple[Bounds, int]:
        out = cls.__new__(cls)
        out.measured = out.rescanned = 0
        for name, kind in cls.KINDS:
            found = np.frombuffer(content, kind, count, at)
            setattr(out, name, found.copy())
            at += found.nbytes
        return out, at


def _form(vectors: np.ndarray) -> str:
    """How whole numbers are kept in a chunk."""
    if vectors.dtype == object:
        return "text"
    most = np.abs(vectors).max() if vectors.size else 0
    return "<i2" if most < 1 << 15 else "<i4"


def _freeze(vectors: np.ndarray) -> tuple[str, bytes]:
    form = _form(vectors)
    body = ",".join(map(str, vectors.ravel())).encode() if form == "text" else vectors.astype(form).tobytes()
    return form, body


def _thaw(form: str, body: bytes, width: int) -> np.ndarray:
    if form != "text":
        return np.frombuffer(body, form).astype(np.float64).reshape(-1, width)
    values = [int(v) for v in body.split(b",")]
    out = np.empty(len(values), object)
    out[:] = values
    return out.reshape(-1, width)


class _Sums:
    """Sums and counts of the rows of every entry in a task."""

    def __init__(self, parts: int, entries: int, width: int):
        self.shape, self.values = (parts, entries, width + 1), {}

    def add(self, part: int, entry: np.ndarray, vectors: np.ndarray) -> None:
        for k in np.unique(entry).tolist():
            rows = vectors[entry == k]
            old = self.values.setdefault((part, k), [0] * self.shape[2])
            new = [len(rows), *(int(v) for v in rows.sum(0))]
            self.values[part, k] = [a + b for a, b in zip(old, new)]

    def limbs(self) -> dict[int, int]:
        """Nonzero limbs by place."""
        out = {}
        for (part, k), values in self.values.items():
            base = (part * self.shape[1] + k) * self.shape[2]
            for position, value in enumerate(values):
                sign, rest, place = (-1 if value < 0 else 1), abs(value), (base + position) * _LIMBS
                while rest:
                    if low := rest & ((1 << _LIMB_BITS) - 1):
                        out[place] = sign * low
                    rest, place = rest >> _LIMB_BITS, place + 1
        return out


def _next_codebook(book: Codebook, totals: dict[int, int], width: int) -> Codebook:
    def total(part: int, k: int, position: int) -> int:
        base = ((part * len(book[0]) + k) * (width + 1) + position) * _LIMBS
        return sum(totals.get(base + limb, 0) << (_LIMB_BITS * limb) for limb in range(_LIMBS))

    out = []
    for part, entries in enumerate(book):
        out.append([])
        for k, entry in enumerate(entries):
            count = total(part, k, 0)
            out[-1].append([total(part, k, j + 1) // count for j in range(width)] if count else list(entry))
    return out


def digest(book: Codebook) -> str:
    return hashlib.sha256(",".join(str(v) for part in book for entry in part for v in entry).encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, list[Codebook]]:
    """``(id, label, code, error)`` per row, and the codebooks of all rounds, the last one being that of the codes.

    ``code`` holds one byte per part, ``error`` is the squared distance to the entries (null beyond a long). Rows whose
    vector is null, empty, or holds a null, NaN or infinite component are dropped, and so are rows of another length
    than the row with the smallest identifier. A length that ``parts`` does not divide is filled up with zeros. The
    first codebooks are the parts of the ``entries`` smallest identifiers (null last; rows that repeat one by vector),
    fewer where there are fewer rows. Rows that repeat an identifier or a vector are all kept. Other columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number must fit a byte")
    spark = vectors.sparkSession
    id_kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(sound)
    shape = f"id {id_kind}, label {label_kind}, code binary, error long"
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return spark.createDataFrame([], shape), []
    length = len(first[0]["vector"])
    first = [r["vector"] for r in first if len(r["vector"]) == length]
    if len(first) < entries:
        first = [r["vector"] for r in rows.filter(F.size("vector") == length).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()]
    width = -(-length // parts)
    rows = rows.filter(F.size("vector") == length)

    def padded(whole: np.ndarray) -> np.ndarray:
        filler = np.zeros((len(whole), parts * width - length), whole.dtype)
        return np.concatenate([whole, filler], 1)

    start = padded(whole_numbers(np.array(first, np.float64)))
    own = [[[int(v) for v in row[p * width : (p + 1) * width]] for row in start] for p in range(parts)]
    history: list[Codebook] = [own]
    chunk_shape = f"ids array<{id_kind}>, labels array<{label_kind}>, form string, vectors binary, bounds binary, sums map<int,bigint>"

    def assign(numbers: np.ndarray, bounds: list[Bounds], books: list[Codebook], sums: _Sums | None) -> None:
        for p, state in enumerate(bounds):
            own = numbers[:, p * width : (p + 1) * width]
            state.advance(own, [book[p] for book in books])
            if sums is not None:
                sums.add(p, state.entry, own)

    def chunk(ids: pa.Array, labels: pa.Array, form: str, body: bytes, bounds: list[Bounds]) -> pa.RecordBatch:
        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        state = b"".join(b.pack() for b in bounds)
        arrays = [one(ids), one(labels), pa.array([form]), pa.array([body], pa.binary()), pa.array([state], pa.binary()),
                  pa.array([None], pa.map_(pa.int32(), pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["ids", "labels", "form", "vectors", "bounds", "sums"])

    def totals(sums: _Sums, id_type: pa.DataType, label_type: pa.DataType) -> pa.RecordBatch:
        nothing = [pa.array([None], pa.list_(id_type)), pa.array([None], pa.list_(label_type)), pa.array([None], pa.string()),
                   pa.array([None], pa.binary()), pa.array([None], pa.binary())]
        return pa.RecordBatch.from_arrays(
            [*nothing, pa.array([list(sums.limbs().items())], pa.map_(pa.int32(), pa.int64()))],
            ["ids", "labels", "form", "vectors", "bounds", "sums"],
        )

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kinds = _Sums(parts, len(first), width), None
        for part in rows_of(batches, max(1, _CHUNK // (parts * width))):
            kinds = part.column(0).type, part.column(1).type
            flat = part.column(2).flatten().to_numpy(zero_copy_only=False)
            numbers = padded(whole_numbers(flat.reshape(-1, length)))
            bounds = [Bounds(len(numbers)) for _ in range(parts)]
            assign(numbers, bounds, history[:1], sums)
            yield chunk(part.column(0), part.column(1), *_freeze(numbers), bounds)
        if kinds:
            yield totals(sums, *kinds)

    def thawed(part: pa.RecordBatch, at: int) -> tuple[np.ndarray, list[Bounds]]:
        numbers = _thaw(part.column(2)[at].as_py(), part.column(3)[at].as_py(), parts * width)
        bounds, place, packed = [], 0, part.column(4)[at].as_py()
        for _ in range(parts):
            state, place = Bounds.unpack(packed, place, len(numbers))
            bounds.append(state)
        return numbers, bounds

    def rerun(books: list[Codebook]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, kinds = _Sums(parts, len(first), width), None
            for part in rows_of(batches, 1):
                kinds = part.column(0).type.value_type, part.column(1).type.value_type
                numbers, bounds = thawed(part, 0)
                assign(numbers, bounds, books, sums)
                yield chunk(part.column(0).flatten(), part.column(1).flatten(), part.column(2)[0].as_py(), part.column(3)[0].as_py(), bounds)
            if kinds:
                yield totals(sums, *kinds)

        return run

    def finish(books: list[Codebook]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in rows_of(batches, 1):
                numbers, bounds = thawed(part, 0)
                assign(numbers, bounds, books, None)
                error = np.zeros(len(numbers), object)
                for p, state in enumerate(bounds):
                    own, picked = numbers[:, p * width : (p + 1) * width], np.empty((len(numbers), width), object)
                    if _exact(own, books[-1][p]):
                        picked = np.array(books[-1][p], np.float64)[state.entry]
                        error += ((own - picked) ** 2).sum(1).astype(np.int64)
                    else:
                        picked[:] = [books[-1][p][k] for k in state.entry]
                        error += ((own if own.dtype == object else own.astype(np.int64)) - picked).__pow__(2).sum(1)
                codes = np.stack([b.entry for b in bounds], 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).flatten(), part.column(1).flatten(), pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64())],
                    ["id", "label", "code", "error"],
                )

        return run

    path = write_step(rows.mapInArrow(begin, chunk_shape), "codes")
    for number in range(rounds):
        steps = spark.read.schema(chunk_shape).parquet(path)
        added = steps.select(F.explode("sums").alias("place", "limb")).groupBy("place").agg(F.sum("limb")).collect()
        history.append(_next_codebook(history[-1], dict(map(tuple, added)), width))
        chunks = steps.filter(F.col("form").isNotNull())
        if number + 1 < rounds:
            after = write_step(chunks.mapInArrow(rerun(list(history)), chunk_shape), "codes")
            remove_step(spark, path)
            path = after
    done = cut_lineage(chunks.mapInArrow(finish(list(history)), shape)) if rounds else cut_lineage(
        spark.read.schema(chunk_shape).parquet(path).filter(F.col("form").isNotNull()).mapInArrow(finish(list(history)), shape)
    )
    remove_step(spark, path)
    return done, history


def label_errors(coded: DataFrame) -> DataFrame:
    """The rows of ``compress`` with ``label_error``, the error summed over equal labels; nulls are one label."""
    totals = cut_lineage(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    # The written totals have a known size: Spark broadcasts them below its threshold and splits hot labels beyond.
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def codebook_frame(spark: SparkSession, book: Codebook) -> DataFrame:
    """``(part, entry, position, value)`` of a codebook; values are decimal text, which has no limit."""
    rows = [(p, k, j, str(v)) for p, part in enumerate(book) for k, entry in enumerate(part) for j, v in enumerate(entry)]
    return spark.createDataFrame(rows, "part int, entry int, position int, value string")
