from itertools import permutations

import numpy as np
import pytest

from munimetrics.operators import assignment, clustering


def frame_of(spark, table):
    rows = [(i, j) for i, line in enumerate(table) for j, n in enumerate(line) for _ in range(n)]
    return spark.createDataFrame([*rows, (None, 0), (0, None)], "cluster int, label int")


def total(table, pairs):
    assert len({p[0] for p in pairs}) == len({p[1] for p in pairs}) == len(pairs)
    assert all(table[i][j] for i, j in pairs)
    return sum(table[i][j] for i, j in pairs)


def best(table):
    square = np.zeros((max(map(len, (table, table[0]))),) * 2, int)
    square[: len(table), : len(table[0])] = table
    return max(sum(square[i, j] for i, j in enumerate(p)) for p in permutations(range(len(square))))


def test_largest_overlap_first_is_not_best(spark):
    table = [[10, 9], [9, 1]]
    frame = frame_of(spark, table)
    first = [tuple(r) for r in clustering.label_pairs(frame, "cluster", "label").collect()]
    pairs = [tuple(r) for r in assignment.best_label_pairs(frame, "cluster", "label").collect()]
    assert total(table, first) == 11 and total(table, pairs) == 18 and sorted(pairs) == [(0, 1), (1, 0)]


@pytest.mark.parametrize("seed", range(40))
def test_equals_all_permutations_of_seven(seed):
    rng = np.random.default_rng(seed)
    shape = [(7, 7), (7, 4), (3, 7), (7, 7)][seed % 4]
    table = rng.integers(0, 60, shape) * (rng.random(shape) < [1, 0.7, 0.5, 0.3][seed % 4])
    table[0, 0] = max(1, table[0, 0])
    i, j = np.nonzero(table)
    used_i, used_j = np.unique(i, return_inverse=True)[1], np.unique(j, return_inverse=True)[1]
    chosen = assignment.settle(used_i, used_j, table[i, j])
    assert total(table, list(zip(i[chosen], j[chosen]))) == best(table)


def test_tables_of_seven_in_tasks_and_in_rounds(spark):
    table = np.random.default_rng(9).integers(0, 9, (7, 7))
    table[2:4, :5] = 0
    table[0:2, 5:] = 0
    frame = frame_of(spark, table)
    small = [tuple(r) for r in assignment.best_label_pairs(frame, "cluster", "label").collect()]
    assert total(table, small) == best(table)
    little = np.array([[5, 4, 0], [4, 0, 3], [0, 6, 5]])
    rounds = [tuple(r) for r in assignment.best_label_pairs(frame_of(spark, little), "cluster", "label", part=1).collect()]
    assert total(little, rounds) == best(little)
    assert assignment.best_label_pairs(frame.limit(0), "cluster", "label").count() == 0
