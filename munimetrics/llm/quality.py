"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

The statistics of a whole text are standardised and mapped to cosines whose inner products approximate a Gaussian
kernel. Each task adds up its own part of the normal equations, which Spark sums cell by cell; the driver solves a
system of fixed size. Raw scores are counted in bins of fixed width and calibrated to shares by pooling adjacent
violators.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.common import byte_texts, crc_fold, cut_lineage

FEATURES = 192
WIDTH = 2.5  # of the kernel, in standard deviations of a statistic
RIDGE = 1.0
BINS = 1000
SEED = 11

#: Kinds of bytes: lower case, upper case, digit, white space, mark of a sentence, other sign, line feed, beyond ASCII.
_KIND = np.full(256, 7, np.uint8)
_KIND[:128] = 5
_KIND[list(range(97, 123))] = 0
_KIND[list(range(65, 91))] = 1
_KIND[list(range(48, 58))] = 2
_KIND[[32, 9, 11, 12, 13]] = 3
_KIND[list(b".,;:'\"()?-")] = 4
_KIND[10] = 6

NAMES = [
    "log_words", "word_length", "lower", "upper", "digit", "white", "mark", "sign", "line", "beyond", "bang", "bar",
    "distinct", "top", "repeated", "lines_distinct", "words_per_line", "letterless",
]


def statistics(text: bytes) -> list[float]:
    """The statistics named in ``NAMES``; shares are of the bytes or of the words. All are zero for an empty text."""
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    size, count = len(text), len(words)
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=8) / size
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    repeated = sum(map(bytes.__eq__, words, words[1:])) / count
    lines = [x for x in text.split(b"\n") if x.strip()]
    letterless = sum(n for w, n in seen.items() if not w.strip(b"!#$%&*+-./0123456789:;<=>?@[]^_{|}~,()'\"")) / count
    lower, upper, digit, white, mark, sign, line, beyond = kinds
    return [
        np.log1p(count), (size - count) / count, lower, upper, digit, white, mark, sign, line, beyond,
        text.count(b"!") / size, text.count(b"|") / size, len(seen) / count**0.8, max(seen.values()) / count, repeated,
        len(set(lines)) / len(lines), np.log1p(count / len(lines)), letterless,
    ]


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, stats)`` per row; a null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            stats = np.array([statistics(t) for t in byte_texts(part.column(1))]).reshape(-1)
            ends = np.arange(part.num_rows + 1, dtype=np.int32) * len(NAMES)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(stats, pa.float64()))], ["id", "stats"]
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores at which the calibrated share is known
    shares: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.edges, self.shares)


def fourier(standard: np.ndarray) -> np.ndarray:
    """A constant and ``FEATURES`` cosines with Gaussian frequencies, the same in every task."""
    rng = np.random.default_rng(SEED)
    frequency = rng.normal(0, 1 / WIDTH, (standard.shape[1], FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    waves = np.cos(np.clip(standard, -8, 8) @ frequency + phase) * np.sqrt(2 / FEATURES)
    return np.hstack([np.ones((len(standard), 1)), waves])


def pool_violators(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The non-decreasing shares closest to ``sums / counts`` by weighted squares, one per bin."""
    blocks: list[list[float]] = []
    for s, n in zip(sums.tolist(), counts.tolist()):
        blocks.append([s, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, bins = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][2] += bins
    return np.concatenate([np.full(bins, s / n) for s, n, bins in blocks]) if blocks else np.zeros(0)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def fit(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", folds: int = 3, held: int = 1) -> Model | None:
    """Learn from every labelled row whose crc32(id) modulo ``folds`` is not ``held``.

    Labels that are null, or on rows without an identifier, are not used; of several labels for one identifier the
    smallest counts. Without labelled rows there is no model.
    """
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.min(label_col).cast("double").alias("y"))
    rows = described.filter(crc_fold(F.col("id"), folds) != held).join(known, F.col("id") == F.col("label_id")).select("stats", "y")
    rows = cut_lineage(rows)
    places = [F.col("stats")[i] for i in range(len(NAMES))]
    moments = rows.agg(F.count("*"), F.avg("y"), *(F.avg(p) for p in places), *(F.stddev_pop(p) for p in places)).first()
    if not moments[0]:
        return None
    mean = np.array(moments[2 : 2 + len(NAMES)])
    scale = np.maximum(np.array(moments[2 + len(NAMES) :]), 1e-6)
    base = Model(mean, scale, np.zeros(0), np.zeros(0), np.zeros(0))
    size = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for part in batches:
            x, y = base.features(_matrix(part.column(0))), part.column(1).to_numpy(zero_copy_only=False)
            total += x.T @ np.column_stack([x, y])
        cells = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.reshape(-1))], ["cell", "value"])

    cells = rows.mapInArrow(equations, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    system = np.zeros(size * (size + 1))
    system[[c["cell"] for c in cells]] = [c["value"] for c in cells]
    system = system.reshape(size, size + 1)
    ridge = np.eye(size) * RIDGE
    ridge[0, 0] = 0
    base.weights = np.linalg.solve(system[:, :size] + ridge, system[:, size])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            raw = np.clip(base.raw(_matrix(part.column(0))), -0.5, 1.5)
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(raw * BINS).astype(np.int64)), part.column(1)], ["bin", "y"])

    counted = rows.mapInArrow(binned, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("s"), F.count("*").alias("n"))
    bins = sorted((r["bin"], r["s"], r["n"]) for r in counted.collect())  # 2 * BINS + 1 rows at most
    place, sums, counts = (np.array(c, float) for c in zip(*bins))
    base.edges, base.shares = (place + 0.5) / BINS, np.clip(pool_violators(sums, counts), 0, 1)
    return base


def scored(described: DataFrame, model: Model | None) -> DataFrame:
    """``(id, score)`` per row: the calibrated share of label 1, or 0.5 without a model."""
    kind = described.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            score = np.full(part.num_rows, 0.5) if model is None else model.score(_matrix(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score, pa.float64())], ["id", "score"])

    return described.mapInArrow(run, f"id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 3, held: int = 1) -> DataFrame:
    """``(id, score)`` per row of ``docs``; empty and null texts are scored by all-zero statistics, repeated rows once each."""
    described = cut_lineage(describe(docs, id_col, text_col))
    return scored(described, fit(described, labels, id_col, label_col, folds, held))
