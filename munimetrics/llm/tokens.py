"""Whole texts to token ids with a public tokenizer file, each distinct chunk of a batch encoded once.

Chunks are cut only where the file's pre-tokenizer and normaliser give the same ids as on the whole text:

* byte-level files: before a single space, and around a single line feed, that stand between characters which are no
  white space; the chunk keeps its space. A text with other runs of white space is cut before single spaces alone.
* files that drop white space (``strips``): at ASCII white space, which no token spans and nothing composes with.

A chunk of plain Latin letters (below U+0180, without U+0130, whose lower case is no letter) and closing signs is the
ids of the letters and those of the signs. Many such letter runs are encoded as one text and told apart afterwards.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters that composition leaves alone and whose lower case is one letter, and signs that never join them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_PLAIN = rf"^(?P<head> ?[{_LETTERS}]+)(?P<tail>[.,;:!?%&*$#|]*)$"
#: White space that is no single space or line feed, and the zero byte, which marks cuts.
_RUNS = (
    r"[ \n][ \n]|[\x00\x09\x0b-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")
#: Text bytes that are encoded at once.
BATCH_BYTES = 8 << 20
_JOINED = 200

Pieces = tuple[np.ndarray, np.ndarray]  # joined ids, number of ids of each piece


def take_pieces(pieces: Pieces, which: np.ndarray) -> Pieces:
    """The pieces that ``which`` names, in its order."""
    ids, sizes = pieces
    lengths = sizes[which]
    where = np.repeat((np.cumsum(sizes) - sizes)[which] - (np.cumsum(lengths) - lengths), lengths)
    where += np.arange(len(where))
    return ids[where], lengths


def _join(*pieces: Pieces) -> Pieces:
    return np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces])


def text_batches(batches: Iterator[pa.RecordBatch], column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose texts in ``column`` have about ``most`` bytes; a longer text has a slice of its own."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


@cache
def _loaded(path: str, plain_specials: bool) -> tuple[Any, np.ndarray, str]:
    """The tokenizer, the length of its entries, and the suffix of those that close a word; once in a worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain_specials
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix") or ""
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, number in vocabulary.items():
        widths[number] = token.endswith(suffix) if suffix else len(token)
    return tokenizer, widths, suffix


class TextEncoder:
    """Encodes batches of texts; ``remember`` letter runs stay known from batch to batch (some 10 MB for the default).

    The tokenizer itself stays loaded in a worker process, what an encoder remembers goes with it.
    """

    def __init__(self, path: str, plain_specials: bool = False, remember: int = 150_000):
        # One character of a byte-level entry stands for one byte; the other kind closes a run with a suffix.
        self.tokenizer, self.widths, _ = _loaded(path, plain_specials)
        upper, lower, spaced = (self._alone([t])[0].tolist() for t in ("AbC", "abc", " abc"))
        self.folds, self.strips = upper == lower, lower == spaced
        self.remember = remember
        self.known, self.known_ids = pa.array([], pa.large_string()), self._alone([])

    def _alone(self, texts: list[str]) -> Pieces:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(i) for i in found], np.int64)
        return np.fromiter((i for ids in found for i in ids), "<u4", int(sizes.sum())), sizes

    def _joined(self, words: pa.Array, separator: str) -> Pieces:
        """Ids of letter runs, many of them in one text; where their ends cannot be told, one by one."""
        count = len(words)
        if not count:
            return self._alone([])
        offsets = np.minimum(np.arange(0, count + _JOINED, _JOINED), count)
        texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), words), pa.scalar(separator, pa.large_string()))
        ids, _ = self._alone(texts.to_pylist())
        if self.strips:
            ends = np.flatnonzero(self.widths[ids]) + 1
            if len(ends) == count and ends[-1] == len(ids):
                return ids, np.diff(ends, prepend=0)
        else:
            bounds = np.concatenate(([0], np.cumsum(self.widths[ids])))
            sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
            after = np.full(count, len(separator))
            after[offsets[1:] - 1] = 0
            last = np.cumsum(sizes + after) - after
            ends, starts = np.searchsorted(bounds, last), np.searchsorted(bounds, last - sizes)
            if bounds[-1] == last[-1] and (bounds[ends] == last).all() and (bounds[starts] == last - sizes).all():
                # What stands between two runs is a piece of its own that nobody asks for.
                cuts = np.diff(np.column_stack((starts, ends)).ravel(), append=len(ids))
                return take_pieces((ids, cuts), np.arange(0, 2 * count, 2))
        return self._alone(words.to_pylist())

    def _runs(self, heads: pa.Array) -> Pieces:
        """Ids of distinct letter runs."""
        place = pc.index_in(heads, value_set=self.known)
        new = heads.filter(pc.is_null(place))
        if self.strips:
            fresh, ids = new, self._joined(new, " ")
        else:
            spaced = pc.starts_with(new, " ")
            fresh = pa.concat_arrays([new.filter(spaced), new.filter(pc.invert(spaced))])
            ids = _join(self._joined(new.filter(spaced), ""), self._joined(new.filter(pc.invert(spaced)), "\n"))
        known, known_ids = pa.concat_arrays([self.known, fresh]), _join(self.known_ids, ids)
        found = take_pieces(known_ids, pc.index_in(heads, value_set=known).to_numpy())
        room = min(self.remember, len(known))
        if room > len(self.known):
            short = np.flatnonzero(pc.less(pc.binary_length(known), 24).to_numpy(zero_copy_only=False))[:room]
            self.known, self.known_ids = known.take(pa.array(short)), take_pieces(known_ids, short)
        return found

    def _chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Joined chunks, the number of chunks by text, and the place of each such text in ``texts``."""
        if self.strips:
            lists, order = pc.ascii_split_whitespace(texts), np.arange(len(texts))
            return lists.flatten(), pc.list_value_length(lists).to_numpy(), order
        runs = pc.match_substring_regex(texts, _RUNS)
        even = texts.filter(pc.invert(runs))
        marked = pc.replace_substring(pc.replace_substring(even, " ", "\0 "), "\n", "\0\n\0")
        lists = pc.split_pattern(marked, "\0")
        cut = [_BEFORE_SPACE.split(t) for t in texts.filter(runs).to_pylist()]
        chunks = pa.concat_arrays([lists.flatten(), pa.array([c for p in cut for c in p], pa.large_string())])
        counts = np.concatenate([pc.list_value_length(lists).to_numpy(), np.array([len(p) for p in cut], np.int64)])
        return chunks, counts, np.argsort(runs.to_numpy(zero_copy_only=False), kind="stable")

    def _distinct(self, chunks: pa.Array) -> Pieces:
        """Ids of distinct chunks."""
        plain = pc.extract_regex(chunks, _PLAIN)
        other = pc.is_null(plain).to_numpy(zero_copy_only=False)
        heads, tails = (plain.field(k).filter(pc.is_valid(plain)) for k in (0, 1))
        if self.folds and self.strips:
            heads = pc.utf8_lower(heads)
        heads, tails = heads.dictionary_encode(), tails.dictionary_encode()
        first = self._runs(heads.dictionary)
        second, alone = self._alone(tails.dictionary.to_pylist()), self._alone(chunks.filter(pa.array(other)).to_pylist())
        # Two pieces a chunk; the last of all pieces is empty.
        pair = np.full((len(chunks), 2), len(first[1]) + len(second[1]) + len(alone[1]))
        pair[~other, 0] = heads.indices.to_numpy()
        pair[~other, 1] = tails.indices.to_numpy() + len(first[1])
        pair[other, 0] = np.arange(len(alone[1])) + len(first[1]) + len(second[1])
        ids, sizes = take_pieces(_join(first, second, alone, (np.zeros(0, "<u4"), np.zeros(1, np.int64))), pair.ravel())
        return ids, sizes.reshape(-1, 2).sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Joined ids, and where each text's ids start and end in them; a null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        chunks, counts, order = self._chunks(texts)
        coded = chunks.dictionary_encode()
        del chunks
        ids, sizes = take_pieces(self._distinct(coded.dictionary), coded.indices.to_numpy())
        bounds = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
        starts, ends = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        starts[order], ends[order] = bounds[:-1], bounds[1:]
        pa.default_memory_pool().release_unused()
        return ids, starts, ends
