"""Importance resampling of documents towards a target distribution.

Words are lower-cased (A-Z only) runs of letters, digits and everything beyond
ASCII; features are all runs of 1 to ``most`` words, hashed to ``buckets``
buckets by their CRC-32. A bucket's gain is the log ratio of its smoothed
shares in the target and in the documents, in thousandths, rounded down; a
document's weight is the sum of the gains of its features, read from one array
with an entry per bucket. Its score adds Gumbel noise drawn from its id, so
that taking the highest scores draws without replacement in proportion to the
weights.

The exact cutoff comes from weighted median-of-medians rounds over the stored
keys. In a round every partition reports how many of its remaining keys lie on
either side of the last pivot, and the median of each side. The driver keeps
the side that holds the cutoff and takes as next pivot the median of the
partition medians, weighted by their remaining sizes: at least a quarter of the
remaining keys lies on either side of it, so every round discards that share,
and the rounds are logarithmic in the rows. It receives one row per partition
and round, never keys in bulk. The rows up to the cutoff are sorted and
numbered; all others are not shuffled.

Equal scores go to the smaller id (null last), rows equal in both to the one
earlier in the stored stage. The stage is written once, so a lost executor
re-reads the same keys.

Defined results: a null text has no words and weight 0; a null id counts as
the text '' in the noise; repeated rows are rows of their own; with fewer than
``100 / percent`` eligible documents nothing is drawn; empty tables give no
rows, an empty target gives gains from the documents alone; columns named in
``carry`` come along, others do not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import fresh, prepare, work_dir, written
from kiln.llm.crcgrams import Grams
from kiln.operators.prefix import running_sum

BUCKETS = 10_000
KEY = ("neg", "no_id", "id", "at")  # ascending order of these: the draw order
_WORKER: list[Grams] = []


def _grams() -> Grams:
    if not _WORKER:
        _WORKER.append(Grams())
    return _WORKER[0]


def bucket_counts(texts: DataFrame, text: str, buckets: int = BUCKETS, most: int = 3) -> np.ndarray:
    """Features per bucket over all texts: one array per task, summed by
    bucket; ``buckets`` numbers reach the driver."""
    prepare(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, portions in _grams().batch(b.column(0), most):
                for _, crc in portions:
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(met.astype(np.int32)), "n": pa.array(total[met])})
    parts = texts.select(text).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths of a nat, rounded down."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, text: str, gain: np.ndarray, most: int = 3) -> DataFrame:
    """``docs`` without its text, with n_words, n_features and weight."""
    keep = [f for f in docs.schema if f.name != text]
    table = gain.astype(np.float64)  # sums of whole numbers below 2**53 are exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, n, portions in _grams().batch(b.column(text), most):
                weight = np.zeros(len(n))
                for of, crc in portions:
                    weight += np.bincount(of, weights=table[crc % np.uint32(len(table))], minlength=len(n))
                features = sum(np.maximum(n - k, 0) for k in range(most))
                part = b.slice(lo, len(n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in keep]
                    + [pa.array(n), pa.array(features), pa.array(weight.astype(np.int64))],
                    names=[f.name for f in keep] + ["n_words", "n_features", "weight"])
    schema = docs.select(*[f.name for f in keep]).schema
    for c in ("n_words", "n_features", "weight"):
        schema = schema.add(c, "long")
    return docs.mapInArrow(run, schema)


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _side(keys: np.ndarray) -> tuple[int, list[int]]:
    """Rows and their lower median, in draw order."""
    if not len(keys):
        return 0, [0, 0, 0, 0]
    order = np.lexsort(keys.T[::-1])
    return len(keys), keys[order[(len(keys) - 1) // 2]].tolist()


def _report(pivot: tuple[int, ...] | None):
    """Per partition: rows before and behind the pivot, and their medians."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([np.asarray(b.column(c)) for c in KEY], axis=1) for b in batches if b.num_rows]
        if not parts:
            return
        keys = np.concatenate(parts)
        if pivot is None:
            before, behind = keys, keys[:0]
        else:
            less, equal = np.zeros(len(keys), bool), np.ones(len(keys), bool)
            for i, p in enumerate(pivot):
                less |= equal & (keys[:, i] < p)
                equal &= keys[:, i] == p
            before, behind = keys[less], keys[~less & ~equal]
        row = [x for n, m in (_side(before), _side(behind)) for x in (n, *m)]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], names=_REPORT)
    return run


_REPORT = [f"{side}_{c}" for side in ("before", "behind") for c in ("n", *KEY)]


def _bound(key: tuple[int, ...]) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(KEY, key)])


def cutoff(keys: DataFrame, n: int) -> tuple[int, ...] | None:
    """The n-th key (columns KEY, all long and unique as a whole) in ascending
    order; None for n < 1. ``keys`` is a written table that holds at least n."""
    if n < 1:
        return None
    key, lo, hi, pivot = F.struct(*KEY), None, None, None
    while True:
        rest = keys.select(*KEY)
        if lo is not None:  # the first column's own bound lets the scan skip row groups
            rest = rest.filter((F.col("neg") >= lo[0]) & (key > _bound(lo)))
        if hi is not None:
            rest = rest.filter((F.col("neg") <= hi[0]) & (key < _bound(hi)))
        found = rest.mapInArrow(_report(pivot), ", ".join(f"{c} long" for c in _REPORT)).collect()
        before = sum(r.before_n for r in found)
        if pivot is not None and before == n - 1:
            return pivot
        side = "before" if pivot is None or before >= n else "behind"
        if pivot is not None:
            if side == "before":
                hi = pivot
            else:
                lo, n = pivot, n - before - 1
        medians = sorted((tuple(r[f"{side}_{c}"] for c in KEY), r[f"{side}_n"]) for r in found if r[f"{side}_n"])
        half, run = sum(m for _, m in medians) / 2, 0
        for m, size in medians:
            run += size
            if run >= half:
                pivot = m
                break


def draw(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
         buckets: int = BUCKETS, most: int = 3, id_col: str = "doc_id", text_col: str = "text",
         target_text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Every document's id (as ``doc_id``), n_words, n_features, weight, score
    and ``rank`` in the draw (null: not drawn). Drawn are floor(percent / 100
    of) the documents with at least ``min_words`` words. ``id_col`` holds
    whole numbers."""
    gain = gains(bucket_counts(docs, text_col, buckets, most), bucket_counts(target, target_text, buckets, most))
    own = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    if {c.lower() for c in carry} & {*own, *KEY}:
        raise ValueError(f"carried columns must not be named {own + list(KEY)}")
    text, = fresh(docs, "text")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text), *carry)
    scored = weights(slim, text, gain, most).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    stored = written(scored.select(
        "*", (-F.col("score")).alias("neg"), F.col("doc_id").isNull().cast("long").alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"),
        F.monotonically_increasing_id().alias("at")), work_dir(docs.sparkSession, "resample"))
    fit = stored.filter(F.col("n_words") >= min_words)
    last = cutoff(fit, fit.count() * percent // 100)
    no_rank = F.lit(None).cast("long").alias("rank")
    columns = [*own[:-1], *carry]
    if last is None:
        return stored.select(*columns, no_rank)
    won = (F.col("n_words") >= min_words) & (F.struct(*KEY) <= _bound(last))
    winners = running_sum(stored.filter(won).withColumn("_one", F.lit(1).cast("long")), KEY, ["_one"])
    return (winners.select(*columns, F.col("cum__one").alias("rank"))
            .unionByName(stored.filter(~won).select(*columns, no_rank)))
