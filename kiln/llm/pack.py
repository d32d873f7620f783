"""Harmonic packing of documents into sequences of ``capacity`` tokens.

A document's whole sequences come first; what is left of it, 1 to
``capacity - 1`` tokens, is its rest. Rests fall into reciprocal-capacity
classes: class k holds lengths in (capacity / (k + 1), capacity / k], and a
bin of class k takes exactly k rests. Such a bin is more than k / (k + 1)
full; the next rest closes its gap: it is cut there, and what remains of it
is put into the class of its own length. A rest that is shorter than the gap
fills it whole, and the one after it goes on. So full bins have no padding,
at most one document is cut per bin, and at most one bin waits for its gap.

Each worker fills the bins of its own partition and needs nothing from the
others: there is no shuffle. It holds less than one bin per class that occurs,
that is at most about 2 * sqrt(capacity) bins. At the end of a partition the
open bins are joined, largest class first, into full sequences and, for the
last, sequences whose lengths are powers of two, which need no padding either.

Rows come from the scan in a fixed order, so a retried task packs alike; the
sequence id holds the partition and a count within it.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each for itself; a null id stays null; an empty table gives no rows;
other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import prepare
from kiln.llm.tokens import encoder

PER_PARTITION = 1 << 40  # sequence ids of one partition
BATCH_BYTES = 4 << 20  # ids of one batch of pieces


class Piece(NamedTuple):
    """A stretch of a document's ids; ``raw`` are 4 bytes each."""

    doc: Any
    start: int
    tokens: int  # of the whole document
    raw: bytes

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids and the others."""
        return self._replace(raw=self.raw[:4 * n]), self._replace(start=self.start + n, raw=self.raw[4 * n:])


class Bins:
    """The open bins of one partition. ``add`` and ``close`` return the bins
    that are done, each as a list of pieces."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: dict[int, list[Piece]] = {}
        self.waiting: list[Piece] = []  # a bin with all its rests and a gap
        self.gap = 0

    def add(self, rest: Piece) -> list[list[Piece]]:
        """Put a rest of 1 to capacity - 1 ids where it belongs."""
        done = []
        if self.gap:
            if _size(rest) <= self.gap:
                head, rest = rest, None
            else:
                head, rest = rest.cut(self.gap)
            self.waiting.append(head)
            self.gap -= _size(head)
            if not self.gap:
                done.append(self.waiting)
        if rest is not None:
            k = self.capacity // _size(rest)
            members = self.open.setdefault(k, [])
            members.append(rest)
            if len(members) == k:
                del self.open[k]
                gap = self.capacity - sum(map(_size, members))
                if gap:
                    self.waiting, self.gap = members, gap
                else:
                    done.append(members)
        return done

    def close(self) -> list[list[Piece]]:
        """Join what is open: full bins, then powers of two."""
        left = (self.waiting if self.gap else []) + [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(map(_size, left))
        self.open, self.waiting, self.gap = {}, [], 0
        done: list[list[Piece]] = []
        left.reverse()
        while total:
            room = min(self.capacity, 1 << (total.bit_length() - 1))
            total -= room
            done.append([])
            while room:
                p = left.pop()
                if _size(p) > room:
                    p, more = p.cut(room)
                    left.append(more)
                done[-1].append(p)
                room -= _size(p)
        return done


def _size(p: Piece) -> int:
    return len(p.raw) // 4


def _packer(path: str, kind: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, kind)
        sequence = TaskContext.get().partitionId() * PER_PARTITION
        bins = Bins(capacity)
        rows: list[tuple] = []
        held = 0
        id_type = None

        def batch() -> pa.RecordBatch:
            nonlocal rows, held
            doc, start, length, tokens, raw, seq, offset = zip(*rows)
            rows, held = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, id_type), *[pa.array(c, pa.int64()) for c in (start, length, tokens)],
                 pa.array(raw, pa.binary()), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                names=["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"])

        def put(pieces: list[Piece]) -> None:
            nonlocal sequence, held
            at = 0
            for p in pieces:
                rows.append((p.doc, p.start, _size(p), p.tokens, p.raw, sequence, at))
                at += _size(p)
            held += 4 * at
            sequence += 1

        for b in batches:
            id_type = b.schema.field(0).type
            docs = b.column(0).to_pylist()
            for lo, ids, n in enc.encode(b.column(1)):
                raw = memoryview(ids.astype("<u4").tobytes())
                first = 0
                for doc, tokens in zip(docs[lo:lo + len(n)], n.tolist()):
                    whole = tokens // capacity * capacity
                    for start in range(0, whole, capacity):
                        a = 4 * (first + start)
                        put([Piece(doc, start, tokens, bytes(raw[a:a + 4 * capacity]))])
                        if held >= BATCH_BYTES:
                            yield batch()
                    if tokens > whole:
                        rest = Piece(doc, whole, tokens, bytes(raw[4 * (first + whole):4 * (first + tokens)]))
                        for done in bins.add(rest):
                            put(done)
                    if held >= BATCH_BYTES:
                        yield batch()
                    first += tokens
        for done in bins.close():
            put(done)
        if rows:
            yield batch()
    return run


def pack(docs: DataFrame, tokenizer: str, kind: str = "space", capacity: int = 2048,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (unsigned
    32-bit little-endian), sequence_id, offset. ``capacity`` is a power of two."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    prepare(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind_of_id = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_packer(tokenizer, kind, capacity),
                           f"doc_id {kind_of_id}, start long, length long, doc_tokens long, ids binary, "
                           "sequence_id long, offset long")


def pieces(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
