"""Whitening of embeddings: principal components of the covariance found by
QDWH spectral divide and conquer (``qdwh``), applied to all rows as one
broadcast matrix.

Entries become whole numbers, ``floor(scale * entry) + offset``, so counts,
sums and deviations are exact in any order. Three passes read the vectors
alone: sums per dimension; products of the rows centred by those sums; the
covariance of the whitened rows, as a check. A task adds up its rows as matrix
products and hands on one row per dimension, summed by Spark; the driver
receives dimension x dimension numbers. Nothing but these aggregates is
shuffled. The model that is broadcast has dimension x components numbers,
whatever the number of rows.

Defined results: rows whose vector is null, empty or holds a null or
non-finite entry are dropped, as are vectors of another length than the most
common one (of equally common ones the shortest) and entries beyond 2**40 /
``scale``; repeated rows count as often as they occur; null ids stay; a
component whose variance is zero up to rounding has no whitened value and is
left out, so equal rows, a single row and an empty table give empty arrays or
no rows; a deviation beyond a long is null; other columns are carried along,
those with the names of the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import prepare
from kiln.llm.qdwh import components

MOST = float(1 << 40)


@dataclass
class Whitening:
    """The fitted model: ``axes`` holds a component per column, divided by the
    root of its eigenvalue."""
    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    scale: float
    offset: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> np.ndarray:
        total = self.values.sum()
        return self.values[:self.axes.shape[1]] / total if total > 0 else self.values[:0]


def _points(column: pa.Array, dim: int, scale: float, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows kept, and their entries as whole numbers in doubles."""
    fits = np.asarray(pc.fill_null(pc.list_value_length(column), -1)) == dim
    flat = pc.list_flatten(column.filter(pa.array(fits))).cast(pa.float64())
    v = np.asarray(pc.fill_null(flat, np.nan)).reshape(-1, dim)
    good = (np.isfinite(v) & (np.abs(v) * scale < MOST)).all(axis=1)
    return np.flatnonzero(fits)[good], np.floor(v[good] * scale) + offset


def _dimension(df: DataFrame, vec: str) -> int:
    sound = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    top = (df.filter(sound & (F.size(vec) > 0)).groupBy(F.size(vec).alias("dim")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "dim").limit(1).collect())
    return top[0].dim if top else 0


def _products(df: DataFrame, vec: str, dim: int, scale: float, offset: int, rows, size: int) -> np.ndarray:
    """Sum over all vectors of the outer products of ``rows(x)``, which has
    ``size`` columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            _, x = _points(b.column(0), dim, scale, offset)
            y = rows(x)
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(size, dtype=np.int32)),
                                          "row": pa.array(list(total), pa.list_(pa.float64()))})
    parts = df.select(vec).mapInArrow(run, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for r in cells.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "v")))["v"].alias("row")).collect():
        out[r.i] = r.row
    return out


def fit(df: DataFrame, vec: str, most: int = 8, scale: float = 1024.0, offset: int = 100_000) -> Whitening:
    """Mean, eigenvalues and the first ``most`` components of all vectors."""
    prepare(df.sparkSession)
    dim = _dimension(df, vec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dim + 1)
        for b in batches:
            _, x = _points(b.column(0), dim, scale, offset)
            # parts of 1024 rows: sums of whole numbers below 2**52 are exact in doubles
            for lo in range(0, len(x), 1024):
                part = x[lo:lo + 1024]
                total = [t + int(s) for t, s in zip(total, [len(part), *part.sum(axis=0)])]
        yield pa.RecordBatch.from_pydict({"sums": pa.array([[str(t) for t in total]], pa.list_(pa.string()))})
    found = {}
    if dim:
        parts = df.select(vec).mapInArrow(run, "sums array<string>").select(F.posexplode("sums").alias("i", "s"))
        found = {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    n, sums = found.get(0, 0), [found.get(i + 1, 0) for i in range(dim)]
    if not n:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), scale, offset)
    mean = np.array([s / n for s in sums])
    values, vectors = components(_products(df, vec, dim, scale, offset, lambda x: x - mean, dim) / n)
    real = min(most, int((values > values[0] * dim * np.finfo(float).eps).sum()) if values[0] > 0 else 0)
    return Whitening(dim, n, sums, values, vectors[:, :real] / np.sqrt(values[:real]), scale, offset)


def identity_error(df: DataFrame, vec: str, model: Whitening) -> float:
    """Largest entry, in absolute value, of the covariance of the whitened
    vectors minus the identity."""
    k = model.axes.shape[1]
    if not k:
        return 0.0
    sent, mean = df.sparkSession.sparkContext.broadcast(model.axes), model.mean
    # a column of ones beside the whitened values gives their sums as well
    total = _products(df, vec, model.dim, model.scale, model.offset,
                      lambda x: np.concatenate([(x - mean) @ sent.value, np.ones((len(x), 1))], axis=1), k + 1) / model.n
    return float(np.abs(total[:k, :k] - np.outer(total[k, :k], total[k, :k]) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)**2."""
    whole = x.astype(np.int64)
    reach = max((max(abs(int(whole[:, i].max()) * n - s), abs(int(whole[:, i].min()) * n - s))
                 for i, s in enumerate(sums)), default=0) if len(x) else 0
    largest = int(np.abs(whole).max()) if len(x) else 0
    if reach * reach * len(sums) < 1 << 63 and n * largest < 1 << 62:
        d = whole * n - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in whole.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def transform(df: DataFrame, vec: str, model: Whitening) -> DataFrame:
    """The rows kept, with ``deviation`` (long: n**2 times the squared distance
    from the mean) and ``whitened`` (array of double, a value per component)."""
    prepare(df.sparkSession)
    new = {"deviation": T.LongType(), "whitened": T.ArrayType(T.DoubleType())}
    keep = [f for f in df.schema if f.name.lower() not in new]
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            if not m.n:
                continue
            rows, x = _points(b.column(vec), m.dim, m.scale, m.offset)
            if not len(rows):
                continue
            w = (x - m.mean) @ m.axes
            ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            part = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [part.column(f.name) for f in keep]
                + [pa.array(_deviations(x, m.n, m.sums), pa.int64()),
                   pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(w.ravel()))],
                names=[f.name for f in keep] + list(new))
    return df.mapInArrow(run, T.StructType(keep + [T.StructField(c, t) for c, t in new.items()]))
