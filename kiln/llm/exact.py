"""Exact dedup by two passes over a Bloom filter.

Pass 1 puts the digest of every text into Bloom filters, one per task, which
tell for each of their bits whether one text or more than one set it; the
filters are merged bit by bit in steps of ``FAN_IN``. Pass 2 looks every
digest up: if all of its bits were set more than once, the text may have a
copy. Only those rows are shuffled and grouped by digest; the rest are alone
for certain and pass straight through.

The filter has ``BITS_PER_ROW`` bits per row, up to ``max_filter_mb`` (it is
broadcast, so its size is bounded by that parameter). Beyond that many rows
more lone texts are shuffled in vain, but the result stays exact.

Defined results: a null text counts as empty, so all null and empty texts
equal each other; a row with a null id loses against one with an id; of rows
that repeat the same id and text one stays; an empty table gives an empty
result; other columns, whatever their names, are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import fresh, join_hot, prepare, work_dir, written

BITS_PER_ROW = 16
HASHES = 4
FAN_IN = 32
SEGMENT = 1 << 16  # bytes of a filter that travel as one row


def text_digest(text):
    """SHA-256 of the UTF-8 text as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _bits(digests: pa.Array, mask: int) -> np.ndarray:
    """HASHES bit numbers per digest, from its first 16 bytes."""
    raw = np.frombuffer(digests.buffers()[-1], dtype=np.uint8)
    at = np.frombuffer(digests.buffers()[1], dtype=np.int32)[digests.offset:digests.offset + len(digests) + 1]
    raw = raw[at[0]:at[-1]].reshape(len(digests), 32)
    h = np.ascontiguousarray(raw[:, :16]).view("<u8")
    step = h[:, 1] | np.uint64(1)
    return np.stack([(h[:, 0] + np.uint64(i) * step) & np.uint64(mask) for i in range(HASHES)], axis=1)


def _merge(once: np.ndarray, twice: np.ndarray, more_once: np.ndarray, more_twice: np.ndarray) -> None:
    twice |= more_twice | (once & more_once)
    once |= more_once


def _partial(column: str, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(bits // 8, dtype=np.uint8)
        twice = np.zeros(bits // 8, dtype=np.uint8)
        seen = False
        for b in batches:
            if not b.num_rows:
                continue
            seen = True
            # bits of one text count once; a bit met by a second text counts as repeated
            at = np.sort(_bits(b.column(column), bits - 1), axis=1)
            first = np.ones(at.shape, dtype=bool)
            first[:, 1:] = at[:, 1:] != at[:, :-1]
            at, n = np.unique(at[first], return_counts=True)
            new_once, new_twice = np.zeros_like(once), np.zeros_like(twice)
            one = (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
            np.bitwise_or.at(new_once, (at >> np.uint64(3)).astype(np.int64), one)
            rep = n > 1
            np.bitwise_or.at(new_twice, (at[rep] >> np.uint64(3)).astype(np.int64), one[rep])
            _merge(once, twice, new_once, new_twice)
        if not seen:
            return
        task = TaskContext.get().partitionId()
        for s in range(0, len(once), SEGMENT):
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([s // SEGMENT], pa.int32()), "part": pa.array([task], pa.int32()),
                "once": pa.array([once[s:s + SEGMENT].tobytes()], pa.binary()),
                "twice": pa.array([twice[s:s + SEGMENT].tobytes()], pa.binary())})
    return run


_FILTER = "segment int, part int, once binary, twice binary"


def _merge_group(t: pa.Table) -> pa.Table:
    once = twice = None
    for a, b in zip(t["once"].to_pylist(), t["twice"].to_pylist()):
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        if once is None:
            once, twice = a.copy(), b.copy()
        else:
            _merge(once, twice, a, b)
    return pa.table({"segment": t["segment"][:1], "part": t["part"][:1],
                     "once": pa.array([once.tobytes()], pa.binary()), "twice": pa.array([twice.tobytes()], pa.binary())})


def repeated_filter(digests: DataFrame, column: str, rows: int, max_filter_mb: int = 64) -> np.ndarray:
    """The bits that more than one row of ``digests[column]`` sets: the
    driver holds at most ``max_filter_mb``."""
    bits = 1 << max(int(np.ceil(np.log2(max(rows, 1) * BITS_PER_ROW))), 16)
    bits = min(bits, 1 << int(np.log2(max_filter_mb * 8 * 2**20)))
    parts = digests.select(column).mapInArrow(_partial(column, bits), _FILTER)
    left = digests.rdd.getNumPartitions()
    while left > 1:  # each step merges FAN_IN tasks' filters, segment by segment
        parts = (parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
                 .groupBy("segment", "part").applyInArrow(_merge_group, _FILTER))
        left = -(-left // FAN_IN)
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in parts.select("segment", "twice").toLocalIterator():
        part = np.frombuffer(r["twice"], np.uint8)
        out[r["segment"] * SEGMENT:r["segment"] * SEGMENT + len(part)] = part
    return out


def flag_repeated(docs: DataFrame, column: str, digests: DataFrame, flag: str, rows: int,
                  max_filter_mb: int = 64) -> DataFrame:
    """Both passes: ``docs`` with a boolean ``flag`` that is false only where
    no other row has the same value in ``column``. Pass 1 reads the filter's
    bits from ``digests`` (the same values, in a narrow table); in pass 2 only
    the digest goes to Python, the row stays in the JVM."""
    twice = repeated_filter(digests, "digest", rows, max_filter_mb)
    shared, mask = docs.sparkSession.sparkContext.broadcast(twice.tobytes()), len(twice) * 8 - 1

    @F.arrow_udf("boolean")
    def maybe(d: pa.Array) -> pa.Array:
        bits = np.frombuffer(shared.value, np.uint8)
        at = _bits(d, mask)
        hit = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
        return pa.array(hit.all(axis=1))

    return docs.withColumn(flag, maybe(F.col(column)))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_mb: int = 64) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept,
    text_sha256. Of equal texts the row with the largest id is kept."""
    spark = docs.sparkSession
    prepare(spark)
    slim = docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"))
    slim = written(slim.withColumn("row", F.monotonically_increasing_id()), work_dir(spark, "digests"))
    total = slim.count()
    flagged = written(flag_repeated(slim, "digest", slim, "maybe", total, max_filter_mb), work_dir(spark, "flagged"))
    maybe = flagged.filter("maybe").drop("maybe")
    groups = maybe.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("keep"),
                                         F.count(F.lit(1)).alias("group_size"))
    copies = join_hot(maybe, groups, ["digest"]).select(
        "id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"),
        "digest")
    alone = flagged.filter("NOT maybe").select("id", F.col("id").alias("keep_id"),
                                               F.lit(1).cast("long").alias("group_size"),
                                               F.lit(True).alias("kept"), "digest")
    return alone.unionByName(copies).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                                            F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_filter_mb: int = 64) -> DataFrame:
    """Rows of ``docs`` without copies of equal texts, all columns whole. Rows
    that cannot have a copy pass without a shuffle."""
    spark = docs.sparkSession
    prepare(spark)
    digest, maybe, whole = fresh(docs, "digest", "maybe", "whole")
    slim = written(docs.select(text_digest(F.col(text_col)).alias("digest")), work_dir(spark, "digests"))
    flagged = flag_repeated(docs.withColumn(digest, text_digest(F.col(text_col))), digest, slim, maybe,
                            slim.count(), max_filter_mb)
    alone = flagged.filter(~F.col(maybe)).select(*docs.columns)
    order = F.struct(F.col(id_col), F.xxhash64(*[F.col(c) for c in docs.columns]))
    kept = (flagged.filter(maybe).groupBy(digest)
            .agg(F.max_by(F.struct(*[F.col(c) for c in docs.columns]), order).alias(whole)))
    return alone.unionByName(kept.select(f"{whole}.*"))
