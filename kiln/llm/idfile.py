"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Documents are range-partitioned and sorted by id, tokenised, and written in
segments (one file each, about ``SEGMENT_IDS`` ids). Within a segment ids are
replaced by their frequency rank, so the commonest ids take one byte. A rank
takes 1 to 4 bytes; the lengths of four ranks stand in one control byte, and
control bytes are kept apart from the data bytes. A reader looks the control
bytes up in a table of 256 x 4 lengths and gathers all ranks of the segment
with numpy, then looks the ranks up in the segment's rank table.

File layout, all little-endian: magic ``KVB1``; uint32 size of the rank table;
uint64 documents, ids, data bytes; then rank table (uint32 ids), document ids
(int64), a byte per document that is 1 if its id is null, ids per document
(uint64), control bytes, data bytes; uint32 crc32 of all that.

Defined results: a null or empty text is the end id alone; a null document id
comes first; rows with equal ids follow in the order of their texts; an empty
table writes no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import one_by_one, prepare, work_dir, written
from kiln.llm.storage import new_name, reading, writing
from kiln.llm.tokens import encoder

SEGMENT_IDS = 4 << 20
MAGIC = b"KVB1"
_HEAD = struct.Struct("<4sIQQQ")
_CODES = np.stack([np.arange(256) >> (2 * i) & 3 for i in range(4)], axis=1).astype(np.uint8)
LENGTHS = _CODES + 1  # bytes of the four values that a control byte describes


def encode_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[:len(v)] = code
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    keep = np.arange(4, dtype=np.uint8) <= code[:, None]
    return control.astype(np.uint8), v.view(np.uint8).reshape(-1, 4)[keep]


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values, by table lookup and one gather per byte place."""
    lens = LENGTHS[control].ravel()[:n]
    at = np.cumsum(lens, dtype=np.int64) - lens
    out = data[at].astype(np.uint32)
    for place in (1, 2, 3):
        more = np.flatnonzero(lens > place)
        out[more] |= data[at[more] + place].astype(np.uint32) << np.uint32(8 * place)
    return out


def pack_segment(doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    freq = np.bincount(ids)
    table = np.flatnonzero(freq)
    table = table[np.lexsort((table, -freq[table]))].astype("<u4")  # rank -> id, the commonest first
    rank = np.zeros(len(freq), np.uint32)
    rank[table] = np.arange(len(table), dtype=np.uint32)
    control, data = encode_values(rank[ids])
    body = b"".join([_HEAD.pack(MAGIC, len(table), len(doc_ids), len(ids), len(data)), table.tobytes(),
                     doc_ids.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(),
                     counts.astype("<u8").tobytes(), control.tobytes(), data.tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, is null, ids per document, ids) of a file's bytes."""
    magic, n_table, n_docs, n_ids, n_data = _HEAD.unpack_from(raw)
    if magic != MAGIC or struct.unpack("<I", raw[-4:])[0] != zlib.crc32(memoryview(raw)[:-4]):
        raise ValueError("not a whole token-id file")
    at, parts = _HEAD.size, []
    for dtype, n in (("<u4", n_table), ("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs), ("u1", -(-n_ids // 4)),
                     ("u1", n_data)):
        parts.append(np.frombuffer(raw, dtype, n, at))
        at += parts[-1].nbytes
    table, doc_ids, nulls, counts, control, data = parts
    return doc_ids, nulls.astype(bool), counts.astype(np.int64), table[decode_values(control, data, n_ids)]


_FILES = "part int, number int, path string, n_docs long, n_ids long"


def _writer(path: str, kind: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number = encoder(path, kind), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            doc_ids, nulls, counts, ids = (np.concatenate(x) for x in zip(*held))
            held.clear()
            name = new_name(folder, f"ids-{part:06d}-{number:05d}", ".kvb")
            with writing(name) as out:
                out.write(pack_segment(doc_ids, nulls, counts, ids))
            number += 1
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "number": pa.array([number - 1], pa.int32()),
                "path": pa.array([name]), "n_docs": pa.array([len(doc_ids)], pa.int64()),
                "n_ids": pa.array([len(ids)], pa.int64())})

        for b in batches:
            keys = b.column(0)
            nulls = keys.is_null().to_numpy(zero_copy_only=False)
            keys = keys.fill_null(0).to_numpy(zero_copy_only=False)
            for lo, ids, n in enc.encode(b.column(1)):
                held.append((keys[lo:lo + len(n)], nulls[lo:lo + len(n)], n, ids))
                if sum(len(x[3]) for x in held) >= SEGMENT_IDS:
                    yield flush()
        if held:
            yield flush()
    return run


def write(docs: DataFrame, folder: str, tokenizer: str, kind: str = "word",
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending id order and return the committed list
    of files, with ``start``: ids in all files before. The list has a row per
    file, so numbering it in one window stays small."""
    prepare(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # rows of one id, or without one, are dealt by the beginning of their texts, which sorts as the texts do
    ordered = slim.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    files = written(ordered.mapInArrow(_writer(tokenizer, kind, folder), _FILES), f"{folder}/files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            with reading(path) as f:
                doc_ids, nulls, counts, ids = unpack_segment(f.read())
            ends = np.cumsum(counts)
            lo = 0
            while lo < len(counts):  # batches of about 4 MB of ids
                first = int(ends[lo] - counts[lo])
                hi = max(int(np.searchsorted(ends, first + (1 << 20), side="right")), lo + 1)
                raw = ids[first:int(ends[hi - 1])].astype("<u4").tobytes()
                at = np.concatenate([[0], ends[lo:hi] - first]) * 4
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids[lo:hi], mask=nulls[lo:hi]),
                    pa.array(start + ends[lo:hi] - counts[lo:hi]),
                    pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(at.astype(np.int32)),
                                                                 pa.py_buffer(raw)])],
                    names=["doc_id", "start", "ids"])
                lo = hi


def read(files: DataFrame) -> DataFrame:
    """Documents of the listed files: doc_id, start (ids of all documents
    before), ids (unsigned 32-bit little-endian). Files are read side by side."""
    return one_by_one(files.select("path", "start")).mapInArrow(_read, "doc_id long, start long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, kind: str = "word") -> DataFrame:
    """Write ``docs`` and read the files back."""
    return read(write(docs, work_dir(docs.sparkSession, "idfiles"), tokenizer, kind))
