"""The kNN kernel against all distances, with ties, copies and empty sides."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from kiln.operators import knn
from kiln.operators import similarity as SI

SCHEMA = "id long, v array<double>, y int"


def _distance(a, b) -> float:
    d = 0.0
    for x, y in zip(a, b):  # sum() would add with compensation
        d += (x - y) ** 2
    return d


def _brute(test, train, k):
    out = {}
    for i, v, _ in test:
        if v is None or None in v:
            continue
        d = sorted((_distance(v, w), j) for j, w, _ in train if w is not None and None not in w)
        out[i] = [(j, x) for x, j in d[:k]]
    return out


@pytest.mark.parametrize("block", [7, 16384])
def test_equals_all_distances(spark, block):
    rng = np.random.default_rng(block)
    points = np.round(rng.normal(size=(60, 5)), 1)  # rounded: many ties
    train = [(int(i), [float(x) for x in points[i % 40]], int(i % 3)) for i in range(90)]
    train += [(1000, None, 1), (1001, [1.0, None, 0.0, 0.0, 0.0], 1)]
    test = [(int(i), [float(x) for x in points[i]], 0) for i in range(60)] + [(2000, None, 0)]
    got = {}
    for r in SI.knn_neighbours(spark.createDataFrame(test, SCHEMA), spark.createDataFrame(train, SCHEMA),
                               "id", "v", "y", 4, block_rows=block).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.neighbour, r.sq_dist))
    assert got == _brute(test, train, 4)


def test_empty_sides_and_few_rows(spark):
    some = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, [0.5, 1.0], 1)], SCHEMA)
    none = some.filter("1 = 0")
    for test, train, n in ((some, none, 0), (none, some, 0), (none, none, 0), (some, some, 4)):
        got = SI.knn_neighbours(test, train, "id", "v", "y", 5)
        assert got.count() == n and got.columns == ["id", "neighbour", "neighbour_label", "sq_dist", "rank"]


def test_far_tiles_are_left_out_and_offsets_stay_exact():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 32)) * 50
    train = np.concatenate([c + rng.normal(size=(2000, 32)) for c in centres]) + 1e6
    tiles = knn.Tiles(train, pa.chunked_array([pa.array(np.arange(len(train)))]))
    q = centres[3] + rng.normal(size=(20, 32)) + 1e6
    row, col, dist = tiles.nearest(q, 3)
    assert tiles.compared < len(tiles.bounds) / 2
    for i in range(20):
        d = ((train - q[i]) ** 2).sum(axis=1)
        assert sorted(col[row == i]) == sorted(np.argsort(d, kind="stable")[:3])
