"""Language ID: a byte convolutional network trained in numpy and applied to fixed-length windows of whole texts.

Bytes (ASCII lower-cased) are embedded, filters of several widths slide over a window, each filter keeps its largest
response in the window, and a softmax layer turns these into languages. A text is the mean of its windows'
distributions, weighted by the bytes in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from munimetrics.llm.common import byte_texts

WINDOW = 252  # a multiple of every width
WIDTHS = (2, 3, 4)
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_BATCH = 1024


@dataclass
class Network:
    classes: list[str]
    embedding: np.ndarray  # byte by dimension
    filters: list[np.ndarray]  # per width: width * dimension by filter
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest response of each filter in each window and, if asked for, the byte at which it starts."""
        count, dim = len(windows), self.embedding.shape[1]
        flat = self.embedding[windows].reshape(-1)
        best, place = [], []
        for width, kernel in zip(WIDTHS, self.filters):
            top = at = None
            for start in range(width):  # every start is one product over the bytes cut into runs of this width
                runs = (len(flat) // dim - start) // width
                out = flat[start * dim : (start + runs * width) * dim].reshape(runs, width * dim) @ kernel
                each = WINDOW // width
                if start:  # the last run of a window would reach into the next one
                    out = np.concatenate([out, np.zeros((count * each - runs, out.shape[1]), out.dtype)])
                out = out.reshape(count, each, -1)[:, : each - (start > 0)]
                if where:
                    arg = out.argmax(axis=1)
                    now = np.take_along_axis(out, arg[:, None], 1)[:, 0]
                    arg = arg * width + start
                    top, at = (now, arg) if top is None else (np.maximum(top, now), np.where(now > top, arg, at))
                else:
                    now = out.max(axis=1)
                    top = now if top is None else np.maximum(top, now)
            best.append(top)
            place.append(at)
        return np.concatenate(best, axis=1), np.concatenate(place, axis=1) if where else None

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(windows)[0] + self.bias, 0)
        return softmax(hidden @ self.dense + self.offset)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """All of the text in rows of ``WINDOW`` bytes; the last one is filled with zeros."""
    rows = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.lower().ljust(rows * WINDOW, b"\0"), np.uint8).reshape(rows, WINDOW)


def train(
    windows: np.ndarray, labels: np.ndarray, classes: list[str], dim: int = 8, filters: int = 16, epochs: int = 8,
    batch: int = 128, rate: float = 0.01, seed: int = 7,
) -> Network:
    """Adam on the cross-entropy; only the byte run that won the pooling passes a gradient on."""
    rng = np.random.default_rng(seed)
    total = filters * len(WIDTHS)
    net = Network(
        classes,
        rng.normal(0, 0.5, (256, dim)).astype(np.float32),
        [rng.normal(0, (w * dim) ** -0.5, (w * dim, filters)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        rng.normal(0, total**-0.5, (total, len(classes))).astype(np.float32),
        np.zeros(len(classes), np.float32),
    )
    params = [net.embedding, *net.filters, net.bias, net.dense, net.offset]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x, y = windows[pick], labels[pick]
            pool, place = net.pooled(x, where=True)
            hidden = np.maximum(pool + net.bias, 0)
            wrong = softmax(hidden @ net.dense + net.offset)
            wrong[np.arange(len(y)), y] -= 1
            wrong /= len(y)
            back = (wrong @ net.dense.T) * (hidden > 0)
            to_embedding, to_filters = np.zeros_like(net.embedding), []
            for k, width in enumerate(WIDTHS):
                own = slice(k * filters, (k + 1) * filters)
                runs = x[np.arange(len(x))[:, None, None], place[:, own, None] + np.arange(width)]  # row, filter, width
                taken = net.embedding[runs].reshape(len(x), filters, width * dim)
                to_filters.append(np.einsum("nf,nfd->df", back[:, own], taken))
                spread = back[:, own, None] * net.filters[k].T[None]
                np.add.at(to_embedding, runs, spread.reshape(len(x), filters, width, dim))
            grads = [to_embedding, *to_filters, back.sum(0), hidden.T @ wrong, wrong.sum(0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = 300,
    windows_per_doc: int = 4, folds: int = 3, held: int = 1,
) -> Network | None:
    """Train on a bounded sample: about ``per_class`` texts of each language, ``windows_per_doc`` windows of each.

    Rows with a null language, a null text or crc32(id) modulo ``folds`` equal to ``held`` are not learned from.
    The sample is chosen by a hash of text and language, so that it does not depend on identifiers, and texts that occur
    many times are taken once; at most ``2 * per_class`` texts of each language are taken, those of smallest hash.
    Without any labelled row there is no network.
    """
    from munimetrics.llm.common import crc_fold

    known = docs.filter(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (crc_fold(F.col(id_col), folds) != held)
    ).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.withColumn("draw", F.xxhash64("text", "lang", F.lit("sample")))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_class / max(n, 1)))))
    uniform = F.pmod("draw", F.lit(1 << 30)) / float(1 << 30)
    # Copies of a text share a draw and are one text of the sample.
    drawn = known.filter(uniform < F.element_at(share, F.col("lang"))).groupBy("lang", "draw").agg(F.min_by("text", "draw").alias("text"))
    first = Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(1 << 30)), "draw")
    chosen = drawn.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= 2 * per_class).select("draw", "text", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids, rows, langs = [], [], []
            for identifier, text, lang in zip(part.column(0).to_pylist(), byte_texts(part.column(1)), part.column(2).to_pylist()):
                own = windows_of(text)
                step = np.unique(np.linspace(0, len(own) - 1, windows_per_doc).astype(int))
                ids += [identifier] * len(step)
                rows += [own[i].tobytes() for i in step]
                langs += [lang] * len(step)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.binary()), pa.array(langs, pa.string())], ["id", "w", "lang"]
            )

    sample = chosen.mapInArrow(cut, "id long, w binary, lang string")
    rows = sorted((r["id"], bytes(r["w"]), r["lang"]) for r in sample.collect())
    classes = sorted({lang for _, _, lang in rows})
    if not classes:
        return None
    place = {c: i for i, c in enumerate(classes)}
    windows = np.frombuffer(b"".join(w for _, w, _ in rows), np.uint8).reshape(len(rows), WINDOW)
    return train(windows, np.array([place[lang] for _, _, lang in rows]), classes)


def _predict(net: Network | None, texts: list[bytes]) -> tuple[list[str], list[float]]:
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if net is None:
        return langs, scores
    sums = np.zeros((len(texts), len(net.classes)))
    held, owner, count = [], [], 0

    def settle() -> None:
        nonlocal held, owner, count
        if held:
            windows, rows = np.concatenate(held), np.concatenate(owner)
            for at in range(0, len(windows), _BATCH):
                own = windows[at : at + _BATCH]
                weight = np.count_nonzero(own, axis=1)[:, None]
                np.add.at(sums, rows[at : at + _BATCH], net.probabilities(own) * weight)
        held, owner, count = [], [], 0

    lettered = []
    for i, text in enumerate(texts):
        if not _LETTER.search(text.decode("utf-8", "replace")):
            continue
        lettered.append(i)
        own = windows_of(text)
        held.append(own)
        owner.append(np.full(len(own), i))
        count += len(own)
        if count >= 4 * _BATCH:
            settle()
    settle()
    for i in lettered:
        shares = sums[i] / sums[i].sum()
        best = int(shares.argmax())
        langs[i], scores[i] = net.classes[best], float(min(1.0, shares[best]))
    return langs, scores


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language of the whole text and its probability in two more columns.

    A null text and one without a letter get ``und`` and 0; so does every text if there is no network. Columns that
    already bear the names of the two new ones are replaced. Rows stay as they are, repeated ones too.
    """
    kept = [c for c in docs.columns if c not in (lang_out, score_out)]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    place = kept.index(text_col)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            langs, scores = _predict(net, byte_texts(part.column(place)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*kept, lang_out, score_out]
            )

    return rows.mapInArrow(run, f"{shape}, `{lang_out}` string, `{score_out}` double")
