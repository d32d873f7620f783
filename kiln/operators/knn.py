"""The k nearest rows within one cell of test rows x train rows (M5).

Train rows are sorted along the leading principal components of the cell and
cut into tiles. The distance from a test row to a tile's bounding box in those
components is a lower bound of its distance to every row of the tile, since
an orthogonal projection shortens no distance less than zero: a tile farther
than the k-th best so far is left out. The rest is compared by one matrix
product per tile; only rows that may belong to the k best (within the rounding
error of the product) get their exact distance, added up dimension by
dimension, and are merged into the k best of each test row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

COMPONENTS = 8
TEST_TILE = 256
TRAIN_TILE = 1024


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return np.asarray(pc.list_flatten(lists)).reshape(len(lists), -1)


def _exact(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Squared distances of matched rows, summed in the order of dimensions."""
    out = np.zeros(len(q))
    for a, b in zip(q.T, t.T):
        out += (a - b) ** 2
    return out


class Tiles:
    """Train rows in tiles along their principal components."""

    def __init__(self, t: np.ndarray, ids: pa.ChunkedArray):
        self.mean = t.mean(axis=0)
        centred = t - self.mean
        size, axes = np.linalg.eigh(centred.T @ centred)
        self.axes = axes[:, np.argsort(-size)[:COMPONENTS]]
        flat = centred @ self.axes
        self.order = np.argsort(flat[:, 0], kind="stable")
        self.rows, flat = t[self.order], flat[self.order]
        tie = np.empty(len(t), np.int64)  # place of each row in the order of ids
        tie[np.asarray(pc.sort_indices(ids))] = np.arange(len(t))
        self.tie = tie[self.order]
        self.norm = (centred[self.order] ** 2).sum(axis=1)
        self.bounds = range(0, len(t), TRAIN_TILE)
        self.low = np.stack([flat[a:a + TRAIN_TILE].min(axis=0) for a in self.bounds])
        self.high = np.stack([flat[a:a + TRAIN_TILE].max(axis=0) for a in self.bounds])
        self.compared = 0  # tiles met, for tests

    def nearest(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(test row, train row, distance) of the k best of each test row."""
        centred = q - self.mean
        flat, norm = centred @ self.axes, (centred ** 2).sum(axis=1)
        out = np.maximum(np.maximum(self.low[None] - flat[:, None], flat[:, None] - self.high[None]), 0)
        bound = (out ** 2).sum(axis=2)
        slack = 1e-12 * (norm + self.norm.max()) * (1 + q.shape[1])  # far above the rounding of the products
        row, col, dist = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        limit = np.full(len(q), np.inf)
        for tile in np.argsort(bound.min(axis=0), kind="stable"):
            live = np.flatnonzero(bound[:, tile] - slack <= limit)
            if not len(live):
                continue
            self.compared += 1
            a = self.bounds[tile]
            rows = self.rows[a:a + TRAIN_TILE]
            near = norm[live, None] + self.norm[None, a:a + TRAIN_TILE] - 2 * (centred[live] @ (rows - self.mean).T)
            most = np.partition(near, k - 1, axis=1)[:, k - 1] if near.shape[1] > k else np.full(len(live), np.inf)
            r, c = np.nonzero(near <= (np.minimum(most, limit[live]) + 2 * slack[live])[:, None])
            r, c = live[r], c + a
            row, col = np.concatenate([row, r]), np.concatenate([col, c])
            dist = np.concatenate([dist, _exact(q[r], self.rows[c])])
            order = np.lexsort((self.tie[col], dist, row))
            row, col, dist = row[order], col[order], dist[order]
            first = np.searchsorted(row, row)  # where this test row begins
            keep = np.arange(len(row)) - first < k
            row, col, dist = row[keep], col[keep], dist[keep]
            count = np.bincount(row, minlength=len(q))
            ends = np.cumsum(count)
            full = count == k
            limit[full] = dist[ends[full] - 1]
        return row, self.order[col], dist


def nearest_in_cell(k: int):
    def run(test: pa.Table, train: pa.Table) -> pa.Table:
        names = ["id", "neighbour", "neighbour_label", "sq_dist"]
        if not test.num_rows or not train.num_rows:
            kinds = [test.schema.field("id").type, train.schema.field("neighbour").type,
                     train.schema.field("neighbour_label").type, pa.float64()]
            return pa.schema(list(zip(names, kinds))).empty_table()
        tiles, q = Tiles(_matrix(train["v"]), train["neighbour"]), _matrix(test["v"])
        # test rows along the first component, so that those of a tile share their neighbourhood
        order = np.argsort((q - tiles.mean) @ tiles.axes[:, 0], kind="stable")
        parts = []
        for a in range(0, len(q), TEST_TILE):
            some = order[a:a + TEST_TILE]
            row, col, dist = tiles.nearest(q[some], k)
            parts.append((some[row], col, dist))
        row, col, dist = (np.concatenate(x) for x in zip(*parts))
        return pa.table([test["id"].take(pa.array(row)), train["neighbour"].take(pa.array(col)),
                         train["neighbour_label"].take(pa.array(col)), pa.array(dist)], names=names)
    return run
