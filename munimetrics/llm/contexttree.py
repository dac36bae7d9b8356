"""Context-tree weighting over counted byte grams: the arithmetic, vectorised with numpy.

A gram is an unsigned 64-bit key: the ``depth`` context bytes, the most recent first, then the predicted byte in the
low eight bits. The predicted byte is decomposed into eight binary decisions, each with its own context tree whose
node at level ``d`` is known by the ``d`` most recent bytes and the bits decided so far (``1`` followed by them).
A node holds the Krichevsky-Trofimov estimate of its zeros and ones; its weighted probability is half of that
estimate plus half of the product of its children's. After training, the probability of the next bit is the mixture
of the estimates along the context path, each weighted by the posterior that the tree ends at that node.
"""

from __future__ import annotations

import numpy as np

PAD = 0xFF  # never a byte of UTF-8: fills the context before a text and is predicted after it

_HALF = np.log(0.5)
_LOG_PI = np.log(np.pi)


def gram_keys(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every byte of every text and of its end, and where each text starts in them (one more at the end)."""
    gap = bytes([PAD]) * depth
    stream = np.frombuffer(gap + gap.join(texts) + gap, dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    count = int(ends[-1]) if len(texts) else 0
    # Between two texts lie depth pads, the first of which is the end predicted for the former.
    shift = np.repeat(np.arange(len(texts), dtype=np.int64) * (depth - 1), lengths)
    at = np.arange(count, dtype=np.int64) + shift
    keys = np.zeros(len(stream) - depth, dtype=np.uint64)
    for back in range(1, depth + 1):
        keys <<= np.uint64(8)
        keys |= stream[depth - back : len(stream) - back]
    keys <<= np.uint64(8)
    keys |= stream[depth:]
    return keys[at], np.concatenate(([0], ends))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0: Stirling's series after shifting the argument by eight."""
    y = x + 8.0
    product = x * (x + 1) * (x + 2) * (x + 3)
    product = np.log(product) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - product


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - _LOG_PI


class Level:
    """Binary nodes at one context length, from the grams cut to that length."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        byte = (grams & np.uint64(255)) | np.uint64(256)
        context = (grams >> np.uint64(8)) << np.uint64(8)
        keys = np.concatenate([context | (byte >> np.uint64(8 - j)) for j in range(8)])
        self.grams = grams
        self.nodes, place = np.unique(keys, return_inverse=True)
        self.place = place.reshape(8, len(grams))
        self.ones = np.zeros(len(self.nodes))
        total = np.zeros(len(self.nodes))
        for j in range(8):
            bit = ((grams >> np.uint64(7 - j)) & np.uint64(1)).astype(np.float64)
            total += np.bincount(self.place[j], counts, len(self.nodes))
            self.ones += np.bincount(self.place[j], counts * bit, len(self.nodes))
        self.zeros = total - self.ones
        self.seen = total > 0
        self.log_kt = np.where(self.seen, log_kt(self.zeros, self.ones), 0.0)
        self.log_weighted = self.log_kt
        self.log_stop = np.zeros(len(self.nodes))

    def weigh(self, children: np.ndarray) -> None:
        """``children``: per node, the sum of ln weighted probabilities of its children."""
        self.log_weighted = np.logaddexp(_HALF + self.log_kt, _HALF + children)
        self.log_stop = _HALF + self.log_kt - self.log_weighted

    def estimate(self, j: int, place: np.ndarray, bit: np.ndarray) -> np.ndarray:
        ones, zeros = self.ones[place], self.zeros[place]
        return (np.where(bit, ones, zeros) + 0.5) / (ones + zeros + 1.0)


def shorten(grams: np.ndarray) -> np.ndarray:
    """The grams without their oldest context byte."""
    return ((grams >> np.uint64(16)) << np.uint64(8)) | (grams & np.uint64(255))


def build(grams: np.ndarray, counts: np.ndarray, deepest: int, shallowest: int) -> tuple[list[Level], list[np.ndarray]]:
    """Levels ``deepest`` to ``shallowest`` of distinct grams of the deepest, and for each the gram's place in it."""
    levels, places = [Level(grams, counts)], [np.arange(len(grams))]
    for _ in range(deepest - shallowest):
        below = levels[-1]
        short, back = np.unique(shorten(below.grams), return_inverse=True)
        counts = np.bincount(back, counts, len(short)).astype(np.float64)
        level = Level(short, counts)
        parents = np.searchsorted(level.nodes, shorten(below.nodes))
        level.weigh(np.bincount(parents, below.log_weighted, len(level.nodes)))
        levels.append(level)
        places.append(back[places[-1]])
    return levels, places


def mix(levels: list[Level], places: list[np.ndarray], start: np.ndarray | None = None) -> np.ndarray:
    """Probability of each of the eight bits of each gram, mixed from the deepest to the last of ``levels``.

    ``start`` holds what deeper levels have already mixed, not a number where none of them has been seen. A node
    that training never reached passes on the estimate of the node above.
    """
    grams = levels[0].grams
    mixed = np.full((8, len(grams)), np.nan) if start is None else start
    for level, place in zip(levels, places, strict=True):
        for j in range(8):
            bit = (grams >> np.uint64(7 - j)) & np.uint64(1) > 0
            node = level.place[j][place]
            own = level.estimate(j, node, bit)
            stop = np.exp(level.log_stop[node])
            deep = mixed[j]
            both = np.where(np.isnan(deep), own, stop * own + (1 - stop) * deep)
            mixed[j] = np.where(level.seen[node], both, deep)
    return mixed
