"""Substring dedup by level-wise doubling of repeated word windows.

Wanted: every word that a window of ``window`` words covers whose words also
start anywhere else. If a window is repeated, so is each shorter window in it;
so short windows are counted first and only windows whose short one is
repeated are extended to twice its length, until the wanted length is reached
(``levels(35)`` is 18, 35).

At a level of l words each candidate window is represented by its anchor: of
the l-word windows in it the one with the least hash. Equal windows have equal
anchors, so nothing is lost, and neighbouring windows mostly share theirs: only
about 2 / (window - l + 2) of the places are counted. A candidate whose anchor
occurs once in the corpus dies. At the last level the anchor is the window
itself, told apart by 96 bits of hash.

Equal texts are counted once, as text with its number of copies. The distinct
texts are written once, bucketed by their digest; every level and the end join
what they need to that table without moving a text again. Anchors travel as
narrow rows in one aggregation with a combine before the shuffle, so an anchor
that much of the corpus shares is only counted. What comes back are the anchors
that die: each belongs to one text, which the same aggregation tells.

Defined results: a null or empty text has no words and no windows; nothing is
removed from texts shorter than a window; copies of a text of at least
``window`` words lose every word; repeated rows are copies; an empty table
gives no rows; other columns are carried by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm import words as W
from kiln.llm.common import fresh, join_hot, prepare, remove, shuffles_dropped, work_dir, written
from kiln.llm.tokens import ragged

SLICE_BYTES = 4 << 20
BASE = 12  # windows shorter than this are too common to thin anything


def levels(window: int) -> list[int]:
    """Window lengths, each at most twice the one before, up to ``window``."""
    out = [window]
    while (out[0] + 1) // 2 >= BASE:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _slide(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over every run of n entries, by doubling."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = op(x[:len(x) - step], x[step:])
        have += step
    return x


class _Slice:
    """Words of some texts, and the windows in them."""

    def __init__(self, column, window: int):
        self.window = window
        self.data, self.start, self.end, self.h, self.first = W.words(column)
        self.n_words = np.diff(self.first)
        step = np.zeros(len(self.h) + 1, np.int64)  # +1 where a text's windows begin, -1 behind their last start
        long = np.flatnonzero(self.n_words >= window)
        np.add.at(step, self.first[long], 1)
        np.add.at(step, self.first[long + 1] - window + 1, -1)
        self.alive = np.cumsum(step[:-1]) > 0

    def hashes(self, length: int, other: bool = False) -> np.ndarray:
        """Per place the hash of the window that starts there, never 0; 0 where the buffer ends."""
        out = np.zeros(len(self.h), np.uint64)
        w = W.windows(W.mix(self.h + np.uint64(0x9E37)) if other else self.h, length)
        out[:len(w)] = np.maximum(w, np.uint64(1))
        return out

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the anchor per window start, places of the anchors of all
        windows that are alive)."""
        span = self.window - length + 1
        h = self.hashes(length)
        least = np.zeros(len(h), np.uint64)
        if len(h) >= span:
            m = _slide(h, span, np.minimum)
            least[:len(m)] = m
        least[~self.alive] = 0
        top = _slide(np.concatenate([np.zeros(span - 1, np.uint64), least]), span, np.maximum)
        return least, np.flatnonzero((top == h) & (h > 0))

    def drop(self, length: int, dead: np.ndarray) -> None:
        """Windows whose anchor is in ``dead`` (sorted) die."""
        self.alive &= ~_within(self.anchors(length)[0], dead)

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, side="right") - 1


def _slices(column) -> Iterator[tuple[int, int]]:
    _, offsets = W.utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1, lo + 1)
        yield lo, hi
        lo = hi


def _within(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Is each entry of ``x`` in ``found`` (sorted)?"""
    if not len(found):
        return np.zeros(len(x), bool)
    return found[np.minimum(np.searchsorted(found, x), len(found) - 1)] == x


def _check(s: _Slice, window: int) -> np.ndarray:
    """31 further bits of hash of the windows."""
    return s.hashes(window, other=True) >> np.uint64(33)


def _lists(column: pa.Array) -> np.ndarray:
    """All entries of a list<long> column, sorted, as unsigned numbers."""
    return np.unique(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _emit(steps: list[int], window: int):
    """Counts of the anchors of level ``steps[-1]``; the levels before have
    left their dead anchors in columns s0, s1, ..."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in _slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                s = _Slice(part.column("text"), window)
                for i, length in enumerate(steps[:-1]):
                    s.drop(length, _lists(part.column(f"s{i}")))
                _, at = s.anchors(steps[-1])
                if not len(at):
                    continue
                h = s.hashes(steps[-1])[at]
                c = _check(s, window)[at] if steps[-1] == window else np.zeros(len(at), np.uint64)
                doc = s.doc_of(at)
                order = np.lexsort((c, h, doc))
                h, c, doc = h[order], c[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(h)))
                doc = doc[first]
                copies = part.column("copies").to_numpy()[doc]
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(h[first].view(np.int64)), "c": pa.array(c[first].astype(np.int32)),
                    "rid": part.column("rid").take(pa.array(doc)),
                    "n": pa.array(np.minimum(n * np.minimum(copies, 2), 2).astype(np.int32))})
    return run


def _finish(steps: list[int], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in _slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                s = _Slice(part.column("text"), window)
                for i, length in enumerate(steps):
                    if length == window:
                        s.alive &= ~(_within(s.hashes(window), _lists(part.column(f"s{i}")))
                                     & _within(_check(s, window), _lists(part.column("c"))))
                    else:
                        s.drop(length, _lists(part.column(f"s{i}")))
                # words covered by a repeated window
                step = np.zeros(len(s.h) + window + 1, np.int64)
                at = np.flatnonzero(s.alive)
                step[at] += 1
                step[at + window] -= 1
                gone = np.cumsum(step[:len(s.h)]) > 0
                kept = np.flatnonzero(~gone)
                length = s.end[kept] - s.start[kept] + 1  # with a blank behind the word
                idx = ragged(s.start[kept], length)
                raw = s.data[np.minimum(idx, max(len(s.data) - 1, 0))] if len(idx) else np.zeros(0, np.uint8)
                raw[np.cumsum(length) - 1] = 0x20
                ends = np.concatenate([[0], np.cumsum(length)])
                n_kept = np.searchsorted(kept, s.first)
                texts, buf = [], raw.tobytes()
                for i in range(len(s.n_words)):
                    a, z = ends[n_kept[i]], ends[n_kept[i + 1]]
                    texts.append(buf[a:max(z - 1, a)])
                yield pa.RecordBatch.from_pydict({
                    "digest": part.column("digest"), "n_words": pa.array(s.n_words.astype(np.int64)),
                    "n_removed": pa.array((s.n_words - np.diff(n_kept)).astype(np.int64)),
                    "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    "kept": pa.array(texts, pa.binary()).cast(pa.string())})
    return run


def text_key(text):
    """128 bits of the SHA-256 of a text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def distinct_texts(docs: DataFrame, text_col: str) -> tuple[DataFrame, str, str]:
    """The distinct texts (digest, copies, rid, text), bucketed by digest in
    as many buckets as shuffles have partitions, so that joins by digest move
    only the other side. Returns the table, its name and its folder."""
    spark = docs.sparkSession
    t = F.coalesce(F.col(text_col), F.lit(""))
    d = (docs.select(text_key(t).alias("digest"), t.alias("text")).groupBy("digest")
         .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
         .withColumn("rid", F.monotonically_increasing_id()))
    name, folder = f"kiln_texts_{uuid.uuid4().hex[:12]}", work_dir(spark, "texts")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_dropped(spark):
        d.write.bucketBy(parts, "digest").sortBy("digest").option("path", folder).format("parquet").saveAsTable(name)
    return spark.table(name), name, folder


def repeats(docs: DataFrame, window: int = 35, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per distinct text: digest (``text_key``), n_words, n_removed,
    kept_sha256 (of the kept words joined by one space) and, if asked for,
    the kept text itself."""
    spark = docs.sparkSession
    prepare(spark)
    texts, name, folder = distinct_texts(docs, text_col)
    done, state, steps = [folder], texts, levels(window)
    ids = texts.select("rid", "digest")
    none = F.array().cast("array<long>")
    for k, length in enumerate(steps):
        rows = state.mapInArrow(_emit(steps[:k + 1], window), "h long, c int, rid long, n int")
        counted = rows.groupBy("h", "c").agg(F.sum("n").alias("total"), F.min("rid").alias("rid"))
        last = [F.collect_list(F.col("c").cast("long")).alias("c")] if length == window else []
        dead = counted.filter("total = 1").groupBy("rid").agg(F.collect_list("h").alias(f"s{k}"), *last)
        done.append(work_dir(spark, f"level{length}"))
        dead = written(dead.join(ids, "rid").drop("rid"), done[-1])
        state = state.join(dead, "digest", "left")
        state = state.withColumns({c: F.coalesce(c, none) for c in dead.columns if c != "digest"})
    out = "digest binary, n_words long, n_removed long, kept_sha256 string, kept string"
    result = state.mapInArrow(_finish(steps, window), out)
    result = written(result if with_text else result.drop("kept"), work_dir(spark, "repeats"))
    spark.sql(f"DROP TABLE {name}")
    remove(spark, *done)
    return result


def removed(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, kept_sha256."""
    slim = written(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("digest")),
                   work_dir(docs.sparkSession, "rows"))
    met = join_hot(slim, repeats(docs, window, text_col), ["digest"])
    return met.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, window: int = 35, text_col: str = "text") -> DataFrame:
    """``docs`` with the text replaced by its kept words, joined by one space."""
    digest, key, kept = fresh(docs, "digest", "key", "kept")
    r = repeats(docs, window, text_col, with_text=True).select(F.col("digest").alias(key), F.col("kept").alias(kept))
    d = docs.withColumn(digest, text_key(F.col(text_col)))
    r = r.withColumnRenamed(key, digest)
    return join_hot(d, r, [digest]).select(*[F.col(kept).alias(c) if c == text_col else F.col(c) for c in docs.columns])
