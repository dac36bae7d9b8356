"""Exact dedup: partitions by length and content hash hold their texts in Patricia tries that name the owners.

Each task first folds the copies among its own rows in a trie, so that a text held by a third of all rows crosses
the shuffle once per task. The distinct texts are then dealt out by length and hash, and each partition's trie
compares full byte strings. The owner of a text (most code points before normalisation, then smallest identifier)
finds its rows again by the SHA-256 of the normalised text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.common import WHITE, byte_texts, rows_of
from munimetrics.llm.radixtrie import RadixTrie

#: Bytes of text that a task folds before it passes them on, and that a partition's trie holds before it spills.
FOLD_BYTES = 16 << 20
TRIE_BYTES = 64 << 20
#: Rows whose texts are taken out of an Arrow batch at a time.
SLICE = 256


def normalise(text: bytes) -> bytes:
    return text.translate(None, WHITE)


def _owners(batch: pa.RecordBatch) -> Iterator[tuple[bytes, tuple]]:
    """Normalised text and owner of each row of ``(id, text)``."""
    for part in rows_of(iter([batch]), SLICE):
        points = pc.fill_null(pc.utf8_length(part.column(1)), 0).to_pylist()
        for text, size, identifier in zip(byte_texts(part.column(1)), points, part.column(0).to_pylist(), strict=True):
            yield normalise(text), (size, identifier, 1)


def _rows(trie: RadixTrie, kind: pa.DataType, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    keys, owners, held = [], [], 0

    def batch() -> pa.RecordBatch:
        lengths = np.fromiter(map(len, keys), np.int64, len(keys))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys)).view(np.int64)
        size, identifier, rows = zip(*owners)
        return pa.RecordBatch.from_arrays(
            [pa.array(lengths), pa.array(hashes), pa.array(keys, pa.binary()), pa.array(size, pa.int64()),
             pa.array(identifier, kind), pa.array(rows, pa.int64())],
            ["length", "hash", "key", "points", "owner", "rows"],
        )

    for key, owner in trie.items():
        keys.append(key)
        owners.append(owner)
        held += len(key)
        if held > most:
            yield batch()
            keys, owners, held = [], [], 0
    if keys:
        yield batch()


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(sha, owner, rows)`` per distinct normalised text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, of = RadixTrie(4 * FOLD_BYTES), 0, pa.int64()
        for part in batches:
            of = part.column(0).type
            for key, owner in _owners(part):
                if trie.insert(key, owner):
                    held += len(key)
                    if held > FOLD_BYTES:
                        yield from _rows(trie, of)
                        trie, held = RadixTrie(4 * FOLD_BYTES), 0
        yield from _rows(trie, of)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, of = RadixTrie(TRIE_BYTES), pa.int64()
        for part in batches:
            of = part.column("owner").type
            for rows in rows_of(iter([part]), SLICE):
                owners = zip(*(rows.column(c).to_pylist() for c in ("points", "owner", "rows")))
                for key, owner in zip(rows.column("key").to_pylist(), owners):
                    trie.insert(key, owner)
        for part in _rows(trie, of):
            digests = [hashlib.sha256(key).digest() for key in part.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), part.column("owner"), part.column("rows")], ["sha", "owner", "rows"]
            )

    folded = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        fold, f"length long, hash long, key binary, points long, owner {kind}, rows long"
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return folded.repartition(parts, "length", "hash").mapInArrow(own, f"sha binary, owner {kind}, rows long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, keep_id, group_size, kept, sha)`` per row of ``docs``.

    Texts are equal when the same bytes remain after deleting ASCII white space; a null text counts as empty, and
    all empty texts are one group. ``keep_id`` is the row with most code points, then the smallest identifier (a
    null identifier comes last); ``kept`` says whether this row has it, so rows that repeat an identifier are
    marked alike. Empty tables give empty results. Only ``id_col`` and ``text_col`` are read, so other columns may
    have any name.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, SLICE):
            shas = [hashlib.sha256(normalise(t)).digest() for t in byte_texts(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shas, pa.binary())], ["id", "sha"])

    members = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(digest, f"id {kind}, sha binary")
    joined = members.join(distinct_texts(docs, id_col, text_col), "sha", "left")
    return joined.select(
        "id",
        F.col("owner").alias("keep_id"),
        F.col("rows").alias("group_size"),
        F.col("id").eqNullSafe(F.col("owner")).alias("kept"),
        F.lower(F.hex("sha")).alias("sha"),
    )
