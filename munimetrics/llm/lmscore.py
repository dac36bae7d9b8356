"""LM scoring: context-tree weighting over bytes, trained and applied in chunks of documents.

Documents are dealt into chunks by a hash of their identifier. A chunk counts the words and byte grams it trains on
and asks for those it must score; both travel as packed arrays, by bucket. Grams go to a bucket by their two most
recent context bytes, so that a bucket holds whole subtrees of the context tree and weighs them on its own; the two
uppermost levels, of bounded size, are weighed from the buckets' sums. Each chunk then gets back the values of what
it asked for and scores its texts. No task holds the model, only a bucket or a chunk's share of it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm import contexttree as tree
from munimetrics.llm.common import byte_texts, crc_fold, cut_lineage, rows_of, total_bytes

DEPTH = 5
CHUNK_BYTES = 18 << 20
BUCKETS = 64
CHUNKS_PER_TASK = 64
_PART_BYTES = 1 << 20
_MERGE_KEYS = 2 << 20

_PACKED = "chunk long, bucket int, kind string, keys binary, values binary"
_NAMES = ["chunk", "bucket", "kind", "keys", "values"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _NAMES)


def _pack_keys(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").tobytes()


def _keys(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u8"), dtype=np.uint64)


def _add(*sets: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of counted sets of keys."""
    keys, back = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([s[1] for s in sets]), len(keys))


_EMPTY = (np.zeros(0, np.uint64), np.zeros(0))


def _gram_bucket(keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    recent = (keys >> np.uint64(8 * (depth - 1))) & np.uint64(0xFFFF)
    return ((recent * np.uint64(0x9E3779B1)) >> np.uint64(13)) % np.uint64(buckets)


def _text_parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) + 1
        if held >= _PART_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Runs of rows of equal chunk, of batches ordered by it."""
    held: list[pa.RecordBatch] = []

    def stream():
        for part in batches:
            chunk = part.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield int(chunk[a]), part.slice(a, b - a)

    flow = stream()
    following = next(flow, None)
    while following is not None:
        chunk = following[0]

        def own():
            nonlocal following
            while following is not None and following[0] == chunk:
                part, following = following[1], next(flow, None)
                yield part

        run = own()
        yield chunk, run
        held.extend(run)  # whatever the reader has left
        held.clear()


def _counted(depth: int, buckets: int):
    """Per chunk: training counts of its words and grams, with zero for those that are only asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, parts in _chunks(batches):
            words, asked, found, ends = Counter(), set(), [_EMPTY], 0
            for part in parts:
                texts = [t.lower() for t in byte_texts(part.column("text"))]
                train = part.column("train").to_pylist()
                for a, b in _text_parts(texts):
                    for flag in (True, False):
                        own = [t for t, f in zip(texts[a:b], train[a:b]) if f == flag]
                        if not own:
                            continue
                        keys, counts = np.unique(tree.gram_keys(own, depth)[0], return_counts=True)
                        found.append((keys, counts * float(flag)))
                        if sum(len(k) for k, _ in found[1:]) > _MERGE_KEYS:
                            found = [_add(*found)]
                        for text in own:
                            words.update(text.split()) if flag else asked.update(text.split())
                        ends += flag * len(own)
            for word in asked:
                words.setdefault(word, 0)
            grams = _add(*found)
            place = _gram_bucket(grams[0], depth, buckets)
            rows = [(chunk, -1, "end", b"", np.array([ends], "<u4").tobytes())]
            for bucket in range(buckets):
                mine = place == bucket
                if mine.any():
                    rows.append((chunk, bucket, "gram", _pack_keys(grams[0][mine]), grams[1][mine].astype("<u4").tobytes()))
            by: dict[int, list[bytes]] = {}
            for word in words:
                by.setdefault(_word_bucket(word, buckets), []).append(word)
            for bucket, own in by.items():
                counts = np.array([words[w] for w in own], "<u4").tobytes()
                rows.append((chunk, bucket, "word", b" ".join(own), counts))
            for at in range(0, len(rows), 16):
                yield _batch(rows[at : at + 16])

    return run


def _word_bucket(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


class Upper(NamedTuple):
    """What levels 1 and 0 make of a gram: per bit, ``a + b * deeper``, or ``alone`` where nothing deeper was seen."""

    grams: np.ndarray
    a: np.ndarray
    b: np.ndarray
    alone: np.ndarray


def _totals(depth: int):
    """Per bucket, counts summed over chunks: words with counts; grams with what levels ``depth`` to 2 mix for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, bucket), parts in _bucketed(batches):
            if kind == "end":
                total = sum(int(np.frombuffer(v, "<u4")[0]) for _, v in parts)
                yield _batch([(total, bucket, "end", b"", b"")])
            elif kind == "word":
                words: dict[bytes, int] = {}
                for keys, values in parts:
                    for word, n in zip(keys.split(b" "), np.frombuffer(values, "<u4").tolist()):
                        words[word] = words.get(word, 0) + n
                counts = np.fromiter(words.values(), np.int64, len(words))
                yield _batch([(int(counts.sum()), bucket, "tokens", b"", b""), (int((counts > 0).sum()), bucket, "distinct", b"", b"")])
                yield _batch([(-1, bucket, "word", b" ".join(words), counts.astype("<i8").tobytes())])
            else:
                grams = _EMPTY
                for keys, values in parts:
                    grams = _add(grams, (_keys(keys), np.frombuffer(values, "<u4").astype(float)))
                levels, places = tree.build(*grams, depth, 2)
                mixed = tree.mix(levels, places).astype("<f4")
                top = levels[-1]
                short, back = np.unique(tree.shorten(top.grams), return_inverse=True)
                counts = np.zeros(len(top.grams))
                np.add.at(counts, places[-1], grams[1])
                parents, at = np.unique(tree.shorten(top.nodes), return_inverse=True)
                yield _batch([(-2, bucket, "count", short.astype("<u8").tobytes(), np.bincount(back, counts, len(short)).tobytes())])
                yield _batch([(-2, bucket, "child", parents.astype("<u8").tobytes(), np.bincount(at, top.log_weighted, len(parents)).tobytes())])
                yield _batch([(-1, bucket, "gram", _pack_keys(grams[0]), mixed.tobytes())])

    return run


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[tuple[bytes, bytes]]]]:
    """Runs of rows of equal kind and bucket, of batches ordered by both."""
    def flow():
        for part in rows_of(batches, 16):
            yield from zip(*(part.column(n).to_pylist() for n in ("kind", "bucket", "keys", "values")))

    for key, rows in groupby(flow(), key=lambda r: (r[0], r[1])):
        yield key, ((r[2], r[3]) for r in rows)


def _upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels 1 and 0 from the buckets' sums: at most 65,536 grams, whatever the corpus."""
    grams, children = _EMPTY, _EMPTY
    for part in batches:
        for kind, keys, values in zip(*(part.column(n).to_pylist() for n in ("kind", "keys", "values"))):
            more = (np.frombuffer(keys, "<u8"), np.frombuffer(values, "<f8"))
            if kind == "count":
                grams = _add(grams, more)
            else:
                children = _add(children, more)
    if not len(grams[0]):
        return
    one = tree.Level(*grams)
    below = np.zeros(len(one.nodes))
    below[np.searchsorted(one.nodes, children[0])] = children[1]
    one.weigh(below)
    short, back = np.unique(tree.shorten(one.grams), return_inverse=True)
    zero = tree.Level(short, np.bincount(back, grams[1], len(short)))
    zero.weigh(np.bincount(np.searchsorted(zero.nodes, tree.shorten(one.nodes)), one.log_weighted, len(zero.nodes)))
    levels, places = [one, zero], [np.arange(len(one.grams)), back]
    alone = tree.mix(levels, places)
    low = tree.mix(levels, places, np.zeros((8, len(one.grams))))
    high = tree.mix(levels, places, np.ones((8, len(one.grams))))
    # A bit that not even the empty context has seen is an even guess.
    low, high = np.nan_to_num(low, nan=0.5), np.nan_to_num(high, nan=0.5)
    body = np.concatenate([low, high - low, np.nan_to_num(alone, nan=0.5)])
    yield pa.RecordBatch.from_arrays([pa.array([one.grams.astype("<u8").tobytes()], pa.binary()), pa.array([body.tobytes()], pa.binary())], ["grams", "body"])


def _answers(depth: int, upper: Upper):
    """Per bucket: the model first, then each chunk's request, answered with ln counts or log10 probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, model = None, None
        for part in rows_of(batches, 16):
            for chunk, bucket, kind, keys, values in zip(*(part.column(n).to_pylist() for n in _NAMES)):
                if chunk == -1:
                    held = (kind, bucket)
                    if kind == "word":
                        model = dict(zip(keys.split(b" "), np.frombuffer(values, "<i8").tolist()))
                    else:
                        grams = _keys(keys)
                        model = (grams, _finished(grams, np.frombuffer(values, "<f4").reshape(8, -1), depth, upper))
                    continue
                assert held == (kind, bucket)
                if kind == "word":
                    counts = np.array([model[w] for w in keys.split(b" ")], "<i8")
                    yield _batch([(chunk, bucket, kind, keys, counts.tobytes())])
                else:
                    found = model[1][np.searchsorted(model[0], _keys(keys))]
                    yield _batch([(chunk, bucket, kind, keys, found.astype("<f8").tobytes())])

    return run


def _finished(grams: np.ndarray, deeper: np.ndarray, depth: int, upper: Upper) -> np.ndarray:
    """log10 probability of each gram's byte."""
    last = ((grams >> np.uint64(8 * depth)) << np.uint64(8)) | (grams & np.uint64(255))
    at = np.searchsorted(upper.grams, last)
    deeper = deeper.astype(np.float64)
    return np.log10(np.where(np.isnan(deeper), upper.alone[:, at], upper.a[:, at] + upper.b[:, at] * deeper)).sum(0)


class Table:
    """Values of 64-bit keys in open addressing, looked up by the array."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.keys, self.values = np.full(1 << self.bits, ~np.uint64(0)), np.zeros(1 << self.bits)
        slot, left, tries = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            free = left[self.keys[slot[left]] == ~np.uint64(0)]
            self.keys[slot[free]] = keys[free]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            tries += 1
        here = self._slot(keys)
        for _ in range(tries):
            wrong = np.flatnonzero(self.keys[here] != keys)
            here[wrong] = (here[wrong] + 1) & ((1 << self.bits) - 1)
        self.values[here] = values

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        here = self._slot(keys)
        wrong = np.flatnonzero(self.keys[here] != keys)
        while len(wrong):
            here[wrong] = (here[wrong] + 1) & ((1 << self.bits) - 1)
            wrong = wrong[self.keys[here[wrong]] != keys[wrong]]
        return self.values[here]


def _scores(depth: int, tokens: int, distinct: int, ends: int):
    """Per chunk: answers first, then documents."""
    floor = math.log10(tokens + distinct + 1)
    end = math.log10(ends + 1) - floor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _chunks(batches):
            logs: dict[bytes, float] = {}
            known: set[bytes] = set()
            grams, table = ([], []), None
            for part in parts:
                kinds = part.column("kind").to_pylist()
                answers = sum(k is not None for k in kinds)
                for kind, keys, values in zip(kinds[:answers], part.column("keys").to_pylist(), part.column("values").to_pylist()):
                    if kind == "word":
                        counts = np.frombuffer(values, "<i8")
                        words = keys.split(b" ")
                        logs.update(zip(words, (np.log10(counts + 1.0) - floor).tolist()))
                        known.update(w for w, n in zip(words, counts.tolist()) if n > 0)
                    else:
                        grams[0].append(_keys(keys))
                        grams[1].append(np.frombuffer(values, "<f8"))
                part = part.slice(answers)
                if not part.num_rows:
                    continue
                if table is None:
                    table = Table(np.concatenate(grams[0]), np.concatenate(grams[1]))
                    grams = None
                texts = [t.lower() for t in byte_texts(part.column("text"))]
                score, base, count, have = [], [], [], []
                for a, b in _text_parts(texts):
                    keys, starts = tree.gram_keys(texts[a:b], depth)
                    score.append(np.add.reduceat(table[keys], starts[:-1]))
                    for text in texts[a:b]:
                        words = text.split()
                        base.append(math.fsum(map(logs.__getitem__, words)) + end)
                        count.append(len(words) + 1)
                        have.append(sum(map(known.__contains__, words)) + (ends > 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("train"), pa.array(count, pa.int64()), pa.array(have, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(np.concatenate(score), pa.float64())],
                    ["id", "train", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Texts are scored with ASCII letters in lower case; a null text counts as empty and is scored by its end alone.
    Learned from are the rows whose crc32(id) modulo ``folds`` is not ``held`` (a null identifier counts as empty
    text). ``score`` is the log10 probability of the bytes and of the text's end under the weighted context tree,
    ``base_score`` that of the words and an end under add-one counts. Repeated rows count and are scored once each.
    Without training rows every bit is an even guess. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = max(1, total_bytes(docs, text_col) // chunk_bytes)
    fold = crc_fold(F.col(id_col), folds)
    rows = docs.select(
        # By text as well: rows without an identifier, or with one in common, are in many chunks.
        F.pmod(F.xxhash64(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), text_col, F.lit(7)), F.lit(chunks)).alias("chunk"),
        F.col(id_col).alias("id"), (fold != held).alias("train"), F.col(text_col).alias("text"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(max(parts, chunks), "chunk")
    counted = cut_lineage(dealt.sortWithinPartitions("chunk").mapInArrow(_counted(depth, buckets), _PACKED))
    summed = cut_lineage(
        counted.repartition(2 * buckets, "kind", "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_totals(depth), _PACKED)
    )
    sums = {r["kind"]: r["n"] for r in summed.filter("kind IN ('end', 'tokens', 'distinct')").groupBy("kind").agg(F.sum("chunk").alias("n")).collect()}
    ends = sums.get("end", 0)
    tokens, distinct = sums.get("tokens", 0) + ends, sums.get("distinct", 0) + (ends > 0)
    top = summed.filter("chunk = -2").select("kind", "keys", "values").coalesce(1).mapInArrow(_upper, "grams binary, body binary").collect()
    body = np.frombuffer(top[0]["body"], "<f8").reshape(24, -1) if top else np.full((24, 0), 0.5)
    upper = Upper(np.frombuffer(top[0]["grams"], "<u8") if top else np.zeros(0, np.uint64), body[:8], body[8:16], body[16:])

    groups = -(-chunks // CHUNKS_PER_TASK)  # a bucket's requests are answered by several tasks, each with the bucket's model
    asked = counted.filter("kind <> 'end'").withColumn("salt", F.pmod("chunk", F.lit(groups)))
    model = summed.filter("chunk = -1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    answered = (
        model.unionByName(asked).repartition(2 * buckets * groups, "kind", "bucket", "salt")
        .sortWithinPartitions("kind", "bucket", "salt", "chunk").select(*_NAMES).mapInArrow(_answers(depth, upper), _PACKED)
    )
    null = F.lit(None)
    # Answers sort before documents: their order is 0.
    both = answered.select("chunk", F.lit(0).alias("rank"), "kind", "keys", "values", null.cast(kind).alias("id"), null.cast("boolean").alias("train"), null.cast("string").alias("text")).unionByName(
        rows.select("chunk", F.lit(1).alias("rank"), null.cast("string").alias("kind"), null.cast("binary").alias("keys"), null.cast("binary").alias("values"), "id", "train", "text")
    )
    shape = f"id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double"
    scored = both.repartition(max(parts, chunks), "chunk").sortWithinPartitions("chunk", "rank").drop("rank").mapInArrow(
        _scores(depth, tokens, distinct, ends), shape
    )
    return scored.select(
        "id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
