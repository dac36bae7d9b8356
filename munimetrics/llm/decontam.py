"""Benchmark decontamination: seeds of three words find passages, Smith-Waterman alignment scores them.

A copy that scores at least half of its item holds three words of it, one matched after the other, between which at most
two edits lie: with ``m`` matches it has at most ``2 m - n`` edits, and three at least in every two neighbouring gaps
would be more. So seeds are three words in order with up to two words left out between them, on both sides, and none
of these copies is without one (items of up to six words: two words with up to one left out).

Seeds of the items are held in a fixed-size Bloom filter; a scan of the documents keeps only the places whose seed may
be an item's. All seeds join documents and items and name diagonals; around them item and document are aligned word by
word. Passages with too few of the item's words to reach the threshold are not aligned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.common import byte_texts, cut_lineage, rows_of

#: Steps from the first to the second and on to the third word of a seed.
TRIPLES = ((1, 1), (1, 2), (2, 1), (2, 2), (1, 3), (3, 1))
PAIRS = ((1,), (2,))
#: Items of up to so many words are found by pairs, of up to two by all their words.
SHORT = 6
THRESHOLD = 0.5
BLOOM_BITS = 23
MATCH, MISMATCH, GAP = 2, -1, -1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SQUARE = np.uint64(0x9E3779B97F4A7C15**2 % 2**64)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class GramHasher:
    """64-bit hashes of all n-grams of a text: rolling polynomial sums, then mixed."""

    def __init__(self, words: int):
        self.words, self.powers, self.inverses = words, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self.powers):
            size = max(size, 2 * len(self.powers), 1 << 16)
            for name, base in (("powers", _BASE), ("inverses", np.uint64(_inverse(int(_BASE))))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if len(words) < self.words:
            return np.zeros(0, np.uint64)
        joined = b" ".join(words)
        self._grow(len(joined) + 1)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], stops[:-1] + 1))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((np.frombuffer(joined, np.uint8) + np.uint64(1)) * self.powers[: len(joined)], dtype=np.uint64)))
        first, last = begins[: len(words) - self.words + 1], stops[self.words - 1 :]
        return _mixed((sums[last] - sums[first]) * self.inverses[first])


#: Both words of an item of two, which have to stand side by side: told from the pairs of longer items by a mark.
WHOLE = (1, 0)


class Seeds:
    """Hashes of a text's seeds, of its words' hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.scaled = [words, words * _BASE, words * _SQUARE]

    def hashes(self, steps: tuple[int, ...]) -> np.ndarray:
        """Of the seeds of one kind of steps, by the word they start at."""
        mark, steps = (_BASE, (1,)) if steps == WHOLE else (np.uint64(0), steps)
        size = len(self.words) - sum(steps)
        if size <= 0:
            return np.zeros(0, np.uint64)
        out, at = self.scaled[len(steps)][:size] ^ mark, 0
        for left, step in zip(range(len(steps) - 1, -1, -1), steps):
            at += step
            out += self.scaled[left][at : at + size]
        return _mixed(out)


def _kinds(size: int) -> tuple[tuple[int, ...], ...]:
    """The seeds of an item of ``size`` words."""
    return TRIPLES if size > SHORT else PAIRS if size > 2 else (WHOLE,) if size == 2 else ((),)


def _slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def item_grams(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, gram, at, size, words)``: every seed of every item, the word it starts at, the item's and the seed's words.

    The last number is 0 for the whole of an item of two words.
    """
    kind = items.schema[item_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = GramHasher(1)
        for part in rows_of(batches, 512):
            rows, grams, at, sizes, words = [], [], [], [], []
            for row, text in enumerate(byte_texts(part.column(1))):
                own = Seeds(hasher(text))
                count = len(own.words)
                for steps in _kinds(count):
                    found = own.hashes(steps)
                    rows.append(np.full(len(found), row))
                    grams.append(found)
                    at.append(np.arange(len(found)))
                    sizes.append(np.full(len(found), count))
                    words.append(np.full(len(found), 0 if steps == WHOLE else len(steps) + 1))
            if rows:
                columns = [np.concatenate(c).astype(np.int64) for c in (at, sizes, words)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(grams).view(np.int64)), *map(pa.array, columns)],
                    ["item", "gram", "at", "size", "words"],
                )

    return items.select(F.col(item_col), F.col(text_col)).mapInArrow(run, f"item {kind}, gram long, at long, size long, words long")


def bloom(grams: DataFrame, bits: int = BLOOM_BITS) -> bytes:
    """Bit array of ``2 ** bits`` bits over the grams; eight arrays at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.zeros(1 << bits, bool)
        for part in batches:
            for slot in _slots(part.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                field[slot] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(field, bitorder="little").tobytes()], pa.binary())], ["bits"])

    parts = grams.select("gram").distinct().coalesce(8).mapInArrow(run, "bits binary").collect()
    field = np.zeros(1 << (bits - 3), np.uint8)
    for row in parts:
        field |= np.frombuffer(row["bits"], np.uint8)
    return field.tobytes()


def _reach(size: int, threshold: float) -> int:
    """Words that a copy of ``threshold`` or more can take up before or behind the item's own: those of its gaps."""
    return int(np.ceil(MATCH * size * (1 - threshold) / -GAP))


def places(docs: DataFrame, id_col: str, text_col: str, field: bytes, words: list[int], bits: int, reach: int) -> DataFrame:
    """``(id, first, print, passage, grams, at)``: stretches of documents around seeds that the filter does not rule out.

    The seeds are of each of the numbers of ``words``.
    A stretch reaches ``reach`` words to either side of each; overlapping ones are merged. ``first`` is its first word
    in the document and ``print`` its hash, ``at`` says where in it the seeds start.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, have = GramHasher(1), np.unpackbits(np.frombuffer(field, np.uint8), bitorder="little").astype(bool)
        kinds_of = [steps for n in words for steps in {0: (WHOLE,), 1: ((),), 2: PAIRS, 3: TRIPLES}[n]]
        for part in rows_of(batches, 512):
            ids, firsts, passages, grams, at = [], [], [], [], []
            for i, text in enumerate(byte_texts(part.column(1))):
                hits, kinds = [], []
                seeds = Seeds(hasher(text))
                for steps in kinds_of:
                    hashes = seeds.hashes(steps)
                    one, two = _slots(hashes, bits)
                    hit = np.flatnonzero(have[one])
                    hit = hit[have[two[hit]]]
                    hits.append(hit)
                    kinds.append(hashes[hit])
                hit, hashes = np.concatenate(hits), np.concatenate(kinds)
                if not len(hit):
                    continue
                order = np.argsort(hit, kind="stable")
                hit, hashes = hit[order], hashes[order]
                own, cuts = text.lower().split(), np.flatnonzero(np.diff(hit) > 2 * reach) + 1
                for run_of, gram in zip(np.split(hit, cuts), np.split(hashes, cuts)):
                    first = max(0, int(run_of[0]) - reach)
                    ids.append(i)
                    firsts.append(first)
                    passages.append(b" ".join(own[first : int(run_of[-1]) + reach]))
                    grams.append(gram.view(np.int64))
                    at.append(run_of - first)
            if ids:
                prints = np.fromiter(map(xxhash.xxh64_intdigest, passages), np.uint64, len(passages)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(ids)), pa.array(firsts, pa.int64()), pa.array(prints), pa.array(passages, pa.binary()),
                     pa.array(grams, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int64()))],
                    ["id", "first", "print", "passage", "grams", "at"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).filter(F.col(id_col).isNotNull()).mapInArrow(
        run, f"id {kind}, first long, print long, passage binary, grams array<long>, at array<long>"
    )


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best Smith-Waterman score of two word sequences, and the ends of the aligned stretch in item and passage."""
    ramp = np.arange(len(passage) + 1) * GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        fresh = np.zeros(len(row), np.int64)
        fresh[1:] = np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP)
        fresh = np.maximum(fresh, 0)
        row = np.maximum.accumulate(fresh - ramp) + ramp  # gaps along the passage
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), i + 1, top)
    return best


def _regions(diagonals: list[int], size: int, words: int, least: float) -> list[tuple[int, int]]:
    """Stretches of the document in which a copy that holds one of the seeds can lie, overlapping ones merged."""
    slack, out = _reach(size, least), []
    for d in sorted(diagonals):
        low, high = max(0, d - slack), min(words, d + size + slack)
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def best_alignment(item: list[bytes], document: list[bytes], diagonals: list[int], least: float) -> tuple[float, int, int]:
    """Score as a share of the full match of the item, and the words of the document from which to which it lies.

    Stretches that hold too few of the item's words for a share of ``least`` are passed over.
    """
    code = {w: i for i, w in enumerate(dict.fromkeys(item))}
    want = np.array([code[w] for w in item])
    wanted = np.bincount(want)
    best = (0.0, 0, 0)
    for low, high in _regions(diagonals, len(item), len(document), least):
        have = np.array([code.get(w, -1) for w in document[low:high]])
        held = np.bincount(have + 1, minlength=len(code) + 1)[1:]
        if np.minimum(wanted, held).sum() < max(least, best[0]) * len(item):  # every match takes a word of each
            continue
        score, item_end, end = align(want, have)
        share = score / (MATCH * len(item))
        if share > best[0]:
            _, _, back = align(want[:item_end][::-1], have[:end][::-1])
            best = (share, low + end - back, low + end)
    return best


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", threshold: float = THRESHOLD, bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """``(id, item, score, first_word, last_word)`` per document and item aligned with at least ``threshold``.

    Words are compared without regard to ASCII case. The score is the Smith-Waterman score (match 2, mismatch and
    gap -1) over that of the item itself. Every seed of an item counts, however many documents hold it, so that with a
    threshold of 0.5 or more no copy of an item of three or more words is lost; shorter items match where all their words
    stand. Null or empty texts match nothing; documents without
    an identifier cannot be named and match nothing, items without one match under a null item. Of several texts or
    passages for a document and an item the best aligned one is given. Empty tables give empty results.
    """
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item_text")).filter("item_text IS NOT NULL")
    items = items.withColumn("item", F.xxhash64("item_id", "item_text")).dropDuplicates(["item"])
    grams = cut_lineage(item_grams(items, "item", "item_text"))
    field = bloom(grams, bloom_bits)
    told = grams.agg(F.max("size").alias("longest"), F.collect_set("words").alias("words")).first()
    longest = told["longest"] or 0
    reach = longest + _reach(longest, threshold)
    found = cut_lineage(places(docs, id_col, text_col, field, sorted(told["words"]) or [3], bloom_bits, reach))
    hits = found.select("id", "first", "print", F.explode(F.arrays_zip("grams", F.col("at").alias("places"))).alias("hit"))
    pairs = (
        hits.select("id", "first", "print", F.col("hit.grams").alias("gram"), F.col("hit.places").alias("doc_at")).join(grams, "gram")
        .select("id", "first", "print", "item", "at", "size", "words", (F.col("doc_at") - F.col("at")).alias("diagonal"))
        .groupBy("id", "first", "print", "item")
        .agg(F.collect_set("diagonal").alias("diagonals"), F.size(F.collect_set("at")).alias("starts"), F.max("size").alias("size"), F.max("words").alias("words"))
    )
    # Of the m - 2 pairs of neighbouring gaps of a copy, all but those with a seed hold three edits or more, and all gaps
    # together hold at most 2 m - 2 n t: seeds start at this many words of the item, or there is no such copy.
    least = F.when(F.col("words") == 3, F.ceil((F.col("size") * (4 * threshold - 1) - 6) / 3 - 1e-9)).otherwise(1)
    pairs = pairs.where(F.col("starts") >= least).drop("starts", "size", "words")
    pairs = cut_lineage(pairs)
    passages = found.select("id", "first", "print", "passage")
    wanted = pairs.join(items, "item").join(passages.hint("merge"), ["id", "first", "print"])
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, 256):
            hits = []
            columns = (part.column("passage").to_pylist(), byte_texts(part.column("item_text")), part.column("diagonals").to_pylist(), part.column("first").to_pylist())
            for i, (passage, item, diagonals, start) in enumerate(zip(*columns)):
                share, first, last = best_alignment(item.lower().split(), passage.split(), diagonals, threshold)
                if share >= threshold:
                    hits.append((i, share, start + first, start + last))
            if hits:
                rows, share, first, last = zip(*hits)
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(rows), part.column("item_id").take(rows), pa.array(share, pa.float64()),
                     pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                    ["id", "item", "score", "first_word", "last_word"],
                )

    shape = f"id {kind}, item {item_kind}, score double, first_word long, last_word long"
    scored = wanted.select("id", "item_id", "diagonals", "item_text", "passage", "first").mapInArrow(score, shape)
    best = scored.groupBy("id", "item").agg(F.max(F.struct("score", "first_word", "last_word")).alias("best"))
    return best.select("id", "item", "best.*")
