"""Alignment of the tokens of two tokenizers, and how common the linked pairs are in the whole corpus.

Both tokenizers cut the same bytes. Two pointers per document, one a tokenizer, walk its token ends; all documents of a
batch take each step together in one vector of states, and finished ones are taken out of it. Where both ends fall on
one byte a group is cut, and the tokens of its two sides are linked, each with each. A long document stands in the
vector several times, from places on where both tokenizers have an end, so that it does not walk alone.

Documents and their links are packed in chunks, which are written once. Spark counts for each pair of ids how many
documents hold it, finds the most common partners of every id, and brings the counts back to the chunks that asked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from munimetrics.llm.common import cut_lineage, rows_of
from munimetrics.llm.tokens import TextEncoder, take_pieces, text_batches

#: Text bytes of a chunk, tokens after which a document enters the vector again, and tokens searched for such a place.
CHUNK_BYTES = 2 << 20
LANE = 1024
_WINDOW = 64
#: Steps whose cuts are handed on together.
_BLOCK = 256

_MARK = "▁"


class ByteTokens:
    """Ids with the bytes that each of them stands for."""

    def __init__(self, spelled: list[bytes]):
        self.widths = np.array([len(s) for s in spelled], np.int64)
        self.bytes = np.frombuffer(b"".join(spelled), "u1"), self.widths
        self.size = len(spelled)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return take_pieces(self.bytes, ids)[0]


def byte_level_characters() -> dict[str, int]:
    """The byte of every character of a byte-level vocabulary: printable Latin-1 is itself, the rest follows U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteLevelTokenizer(ByteTokens):
    """A byte-level vocabulary file; its special tokens are plain text."""

    def __init__(self, path: str):
        self.encoder = self.fresh(path)
        characters = byte_level_characters()
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            spelled[number] = bytes(characters[c] for c in token) if all(c in characters for c in token) else token.encode()
        super().__init__(spelled)

    @staticmethod
    def fresh(path: str) -> TextEncoder:
        return TextEncoder(path, plain_specials=True)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each text, joined, and their number by text."""
        ids, starts, ends = self.encoder.encode(pc.binary_join_element_wise(pa.scalar("", texts.type), texts, pa.scalar(" ", texts.type)))
        sizes = ends - starts
        where = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return ids[where + np.arange(len(where))], sizes


class PieceTokenizer(ByteTokens):
    """A model file of pieces, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        super().__init__([self._bytes(n) for n in range(self.model.get_piece_size())])

    def _bytes(self, number: int) -> bytes:
        piece = self.model.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace(_MARK, " ").encode()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(ids, "<u4") for ids in self.model.encode(texts.to_pylist(), num_threads=1)]
        return np.concatenate([np.zeros(0, "<u4"), *found]), np.array([len(f) for f in found], np.int64)


@cache
def _byte_level(path: str) -> ByteLevelTokenizer:
    return ByteLevelTokenizer(path)


@cache
def _pieces(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Where pointers start and where A's stops, one row for each document and each further place of a long one."""
    stops_a, stops_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    out = []
    for start_a, start_b, stop in zip((stops_a - sizes_a).tolist(), (stops_b - sizes_b).tolist(), stops_a.tolist()):
        at = start_a + lane
        while at + _WINDOW < stop:
            wanted = ends_a[at : at + _WINDOW]
            place = np.minimum(np.searchsorted(ends_b, wanted), len(ends_b) - 1)
            common = np.flatnonzero(ends_b[place] == wanted)
            if len(common):
                cut = at + int(common[0]) + 1
                out.append((start_a, start_b, cut))
                start_a, start_b, at = cut, int(place[common[0]]) + 1, cut
            at += lane
        if start_a < stop:
            out.append((start_a, start_b, stop))
    return np.array(out, np.int64).reshape(-1, 3)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, states: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Walk all ``states`` (rows of ``lanes``) at once; the groups cut, as their first and last-but-one places in A and B.

    In each step the pointer whose token ends first moves, both move where the ends meet, and there a group is cut.
    """
    a, b, stop = (states[:, k].copy() for k in range(3))
    first_a, first_b = a.copy(), b.copy()
    held: list[tuple[np.ndarray, ...]] = []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        a += end_a <= end_b
        b += end_b <= end_a
        cut = np.flatnonzero(end_a == end_b)
        if len(cut):
            past_a, past_b = a[cut], b[cut]
            held.append((first_a[cut], past_a, first_b[cut], past_b))
            first_a[cut], first_b[cut] = past_a, past_b
            if (past_a == stop[cut]).any():
                going = a < stop
                a, b, stop, first_a, first_b = (v[going] for v in (a, b, stop, first_a, first_b))
        if len(held) >= _BLOCK:
            yield tuple(map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def linked(first_a: np.ndarray, past_a: np.ndarray, first_b: np.ndarray, past_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in A and B of all links of the groups."""
    wide, count = past_b - first_b, (past_a - first_a) * (past_b - first_b)
    group = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)
    return first_a[group] + inner // wide[group], first_b[group] + inner % wide[group]


def spelled_groups(ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2;`` of all groups in order as bytes, and the end of each token's part, A's of a group before B's.

    ``last_a`` and ``last_b`` mark the last token of each group on either side.
    """
    digits = len(str(size))
    table = np.array([f"{n:>{digits}}" for n in range(size)], f"S{digits}").view("u1").reshape(size, digits)
    ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    place_a = np.arange(len(ids_a)) + np.repeat(ends_b - np.diff(ends_b, prepend=0), np.diff(ends_a, prepend=0))
    place_b = np.arange(len(ids_b)) + np.repeat(ends_a, np.diff(ends_b, prepend=0))
    signs = np.empty((len(ids_a) + len(ids_b), digits + 1), "u1")
    signs[place_a, :-1], signs[place_b, :-1] = table[ids_a], table[ids_b]
    signs[place_a, -1], signs[place_b, -1] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
    written = signs != ord(" ")
    return signs[written], np.cumsum(written.sum(1))


class Aligner:
    """Aligns batches of texts; see ``align`` for what it gives."""

    def __init__(self, path_a: str, path_b: str):
        # Both stay loaded in a worker process; the words that the first one remembers go with the task.
        self.a, self.b = _byte_level(path_a), _pieces(path_b)
        self.a.encoder = self.a.fresh(path_a)

    def batch(self, texts: pa.Array, lane: int = LANE) -> dict[str, np.ndarray | list]:
        """Counts by text, groups by text, distinct pairs with the number of texts, and their texts with multiplicity."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        count = len(texts)
        some = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        told = texts.take(pa.array(some))
        ids_a, sizes_a = self.a.encode(told)
        ids_b, sizes_b = self.b.encode(told)
        whole = self._whole(told, ids_a, sizes_a, ids_b, sizes_b)
        some = some[whole]
        ids_a, sizes_a = take_pieces((ids_a, sizes_a), whole)
        ids_b, sizes_b = take_pieces((ids_b, sizes_b), whole)
        # Both sides of a text have equally many bytes, so ends may be counted through all texts.
        ends_a, ends_b = np.cumsum(self.a.widths[ids_a]), np.cumsum(self.b.widths[ids_b])
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        owner = np.repeat(np.arange(len(some)), sizes_a)
        keys = [np.zeros(0, np.int64)]
        for groups in lockstep(ends_a, ends_b, lanes(ends_a, ends_b, sizes_a, sizes_b, lane)):
            last_a[groups[1] - 1] = last_b[groups[3] - 1] = True
            in_a, in_b = linked(*groups)
            pair = ids_a[in_a].astype(np.int64) * self.b.size + ids_b[in_b]
            keys.append(pair * max(1, len(some)) + owner[in_a])
        key = np.concatenate(keys)
        key.sort()
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        pair, text = np.divmod(key[starts], max(1, len(some)))
        pair_starts = np.flatnonzero(np.diff(pair, prepend=-1))
        out = {k: np.zeros(count, np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
        out["n_a"][some], out["n_b"][some] = sizes_a, sizes_b
        out["n_groups"][some] = np.bincount(owner[last_a], minlength=len(some))
        multiple = np.diff(starts, append=len(key))
        np.add.at(out["n_links"], some[text], multiple)
        spelled, bounds = spelled_groups(ids_a, ids_b, last_a, last_b, max(self.a.size, self.b.size))
        stops = bounds[np.cumsum(sizes_a + sizes_b) - 1].tolist() if len(some) else []
        groups_of: list[bytes] = [b""] * count
        for place, start, stop in zip(some.tolist(), [0, *stops], stops):
            groups_of[place] = spelled[start : stop - 1].tobytes()
        distinct = pair[pair_starts]
        return out | {
            "groups": groups_of, "a": distinct // self.b.size, "b": distinct % self.b.size,
            "docs": np.diff(pair_starts, append=len(pair)), "text": some[text], "multiple": multiple,
        }

    def _whole(self, told: pa.Array, ids_a: np.ndarray, sizes_a: np.ndarray, ids_b: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
        """The texts that both sides spell byte by byte, with a space before."""
        sides = []
        for own, ids, sizes in ((self.a, ids_a, sizes_a), (self.b, ids_b, sizes_b)):
            ends = np.concatenate(([0], np.cumsum(own.widths[ids])))[np.concatenate(([0], np.cumsum(sizes)))]
            sides.append((own.joined(ids).tobytes(), ends.tolist()))
        (body_a, ends_a), (body_b, ends_b) = sides
        good = []
        for n, text in enumerate(told.cast(pa.large_binary()).to_pylist()):
            spaced = b" " + text
            if body_a[ends_a[n] : ends_a[n + 1]] == spaced == body_b[ends_b[n] : ends_b[n + 1]]:
                good.append(n)
        return np.array(good, np.int64)


def _integers(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes()


def align(
    docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups])`` and pairs ``(a, b, docs, best)``.

    ``docs`` of a pair is how many documents hold it linked, ``best`` whether no other partner of ``a`` stands in more;
    ``n_best`` and ``count_sum`` count and sum these over a document's links. A null or empty text, or one that either
    tokenizer does not spell byte by byte (with a space before), has no tokens: its numbers are zero and its groups the
    empty text, whose digest is empty as well. Rows that repeat an identifier or text are separate documents. An empty
    table gives no rows. Other columns are ignored. ``groups`` adds the groups as text, ``a1,a2|b1;a3|b2,b3``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    counted = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = None, TaskContext.get().partitionId() << 32
        for part in text_batches(batches, 1, CHUNK_BYTES):
            aligner = aligner or Aligner(tokenizer_a, tokenizer_b)
            got = aligner.batch(part.column(1))
            digests = [hashlib.sha256(g).hexdigest() if g else "" for g in got["groups"]]
            lists = [pa.array([v], pa.list_(pa.int64())) for v in (got[k] for k in counted)]
            told = [pa.array([[g.decode() for g in got["groups"]] if groups else None], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                 *lists, pa.array([digests], pa.list_(pa.string())), *told,
                 *(pa.array([got[k]], pa.list_(pa.int32())) for k in ("a", "b", "docs")),
                 pa.array([_integers(got["text"])], pa.binary()), pa.array([_integers(got["multiple"])], pa.binary())],
                names,
            )
            number += 1

    names = ["chunk", "ids", *counted, "digests", "groups", "a", "b", "docs", "text", "multiple"]
    lists = ", ".join(f"{k} array<bigint>" for k in counted)
    shape = (
        f"chunk long, ids array<{kind}>, {lists}, digests array<string>, groups array<string>, "
        "a array<int>, b array<int>, docs array<int>, text binary, multiple binary"
    )
    chunks = cut_lineage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, shape))

    asked = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("place", "pair"))
    asked = asked.select("chunk", "place", "pair.a", "pair.b", "pair.docs")
    counts = asked.groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    # One row per pair of ids that occurs; the written table tells Spark its size for the join below.
    pairs = cut_lineage(counts.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best")))
    answers = asked.drop("docs").join(pairs, ["a", "b"]).groupBy("chunk").agg(F.collect_list(F.struct("place", "docs", "best")).alias("answers"))
    joined = chunks.drop("a", "b").withColumnRenamed("docs", "held").join(answers, "chunk", "left")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows_of(batches, 1):
            row = {k: part.column(n) for n, k in enumerate(part.schema.names)}
            count = len(row["ids"].flatten())
            docs_of, best = np.zeros(0, np.int64), np.zeros(0, bool)
            held = row["held"].flatten().to_numpy()
            if row["answers"][0].is_valid:
                answer = row["answers"].flatten()
                place = answer.field(0).to_numpy()
                docs_of, best = np.zeros(len(held), np.int64), np.zeros(len(held), bool)
                docs_of[place], best[place] = answer.field(1).to_numpy(), answer.field(2).to_numpy(zero_copy_only=False)
            text, multiple = (np.frombuffer(row[k][0].as_py(), "<u4").astype(np.int64) for k in ("text", "multiple"))
            pair = np.repeat(np.arange(len(held)), held)
            n_best, total = np.zeros(count, np.int64), np.zeros(count, np.int64)
            np.add.at(n_best, text, multiple * best[pair])
            np.add.at(total, text, multiple * docs_of[pair])
            told = [row["groups"].flatten()] if groups else []
            yield pa.RecordBatch.from_arrays(
                [row["ids"].flatten(), *(row[k].flatten() for k in counted), pa.array(n_best), pa.array(total), row["digests"].flatten(), *told],
                ["id", *counted, "n_best", "count_sum", "groups_sha256", *(["groups"] if groups else [])],
            )

    longs = ", ".join(f"{k} long" for k in [*counted, "n_best", "count_sum"])
    rows = joined.mapInArrow(sums, f"id {kind}, {longs}, groups_sha256 string" + (", groups string" if groups else ""))
    return rows, pairs
