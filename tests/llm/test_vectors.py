import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from munimetrics.llm import vectorcodes


def brute_force(rows, parts=8, entries=16, rounds=6):
    """Plain integers, every distance measured in every round."""
    kept = [(i, label, v) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    length = len(kept[0][2])
    width = -(-length // parts)
    kept = [(i, label, [math.floor(Fraction(x) * 4096) for x in v] + [0] * (parts * width - length)) for i, label, v in kept if len(v) == length]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min(range(len(books[p])), key=lambda k: (distance(c[p], books[p][k]), k)) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        picked = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, a in zip(cut, picked) if a[p] == k]
                if own:
                    books[p][k] = [sum(column) // len(own) for column in zip(*own)]
    picked = assign()
    return [
        (i, label, bytes(a), sum(distance(c[p], books[p][a[p]]) for p in range(parts))) for (i, label, _), c, a in zip(kept, cut, picked)
    ], books


def check(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    coded, history = vectorcodes.compress(frame, **settings)
    want, books = brute_force(rows, **settings)

    def order(r):
        return (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2])

    got = [(r.id, r.label, bytes(r.code), r.error) for r in coded.collect()]
    assert history[-1] == books
    assert sorted(got, key=order) == sorted([(*w[:3], w[3] if w[3] < 1 << 63 else None) for w in want], key=order)
    return coded


@pytest.mark.parametrize("length,count", [(16, 400), (64, 60), (10, 50), (8, 5)])
def test_equals_measuring_every_distance(spark, length, count):
    rng = np.random.default_rng(length)
    centres = rng.normal(0, 1, (12, length))
    rows = [(int(n), int(n % 3), (centres[n % 12] + rng.normal(0, 0.2, length)).tolist()) for n in rng.permutation(count)]
    check(spark, rows)


def test_nulls_ties_repeats_and_far_values(spark):
    rows = [(n, n % 2, [float(n % 4)] * 8) for n in range(40)]  # ties between equal entries
    rows += [(7, 1, [3.0] * 8), (None, None, [0.5] * 8), (None, 2, [0.25] * 8), (41, None, [-0.3] * 8)]
    rows += [(50, 1, None), (51, 1, []), (52, 1, [float("nan")] * 8), (53, 1, [1.0, None] + [0.0] * 6), (54, 1, [float("inf")] * 8), (55, 1, [1.0] * 9)]
    check(spark, rows)
    coded = check(spark, rows + [(60, 3, [1e18, -1e30] + [0.0] * 6), (61, 3, [-1e18] * 8), (-5, 3, [1e300] + [0.0] * 7)])
    totals = {(r.label, r.label_error) for r in vectorcodes.label_errors(coded).collect()}
    assert len({label for label, _ in totals}) == len(totals) == 5


def test_fewer_entries_and_no_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(n, 0, rng.normal(0, 1, 12).tolist()) for n in range(200)]
    check(spark, rows, parts=3, entries=7, rounds=4)
    check(spark, rows, parts=3, entries=1, rounds=0)
    nothing = spark.createDataFrame([(1, 1, None)], "vec_id long, label int, embedding array<float>")
    coded, books = vectorcodes.compress(nothing)
    assert coded.columns == ["id", "label", "code", "error"] and coded.count() == 0 and books == []


def test_clashing_columns(spark):
    rows = [(n, n % 2, [n / 7.0] * 8, "x", 1) for n in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, id string, sums int")
    coded, books = vectorcodes.compress(frame)
    assert coded.count() == 30 and vectorcodes.label_errors(coded).count() == 30
    assert vectorcodes.codebook_frame(spark, books[-1]).count() == 8 * 16


def test_bounds_save_measuring():
    """Net displacement keeps more bounds closed than the sum of drifts, and no bound is ever wrong."""
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 900, (8, 4))
    rows = np.floor(np.concatenate([c + rng.normal(0, 60, (500, 4)) for c in centres]))
    books = [[[int(v) for v in c] for c in np.floor(centres + rng.normal(0, 25, centres.shape))] for _ in range(6)]
    state, drift, checked = vectorcodes.Bounds(len(rows)), 0, 0
    for number in range(len(books)):
        state.advance(rows, books[: number + 1])
        assert (state.entry == vectorcodes.squared_distances(rows, books[number]).argmin(1)).all()
        checked += len(rows)
    moves = np.array(books, float)
    net = np.sqrt(((moves[-1] - moves[0]) ** 2).sum(1))
    drift = np.sqrt(((moves[1:] - moves[:-1]) ** 2).sum(2)).sum(0)
    assert (net <= drift).all() and (net < drift).any()
    assert state.rescanned < checked / 3


def test_digest_is_plain():
    assert vectorcodes.digest([[[1, -2], [3, 4]]]) == hashlib.sha256(b"1,-2,3,4").hexdigest()
