"""Legacy archives: ARC records read and rewritten as WARC.

An ARC file begins with a version block (``filedesc://``), whose body states
the version and the names of the header fields; each record is one header line
of blank-separated fields and a body of the declared length. Version 1 has
URL, IP address, date, content type and length; version 2 adds result code,
checksum, location, offset and file name. A URL may hold blanks, so the fields
are counted from the right. A file holds any number of records and may be
packed by gzip, whole or a member per record; files may be joined, each with
its own version block. Files come as values (row, arc) or by path (row, path);
a path is streamed a record at a time, whatever the file's length.

The body of a record from an HTTP server begins with the server's own head,
which is kept as it is; the payload is what follows it. A body without one is
all payload, and a head is made for it.

A record becomes a WARC ``response``: identifiers, timestamps, types and
digests that ARC lacks are synthesised. The record id is a UUID (version 8)
that holds the file's row number and, behind its first record, the place in
the file; the payload digest is the SHA-256 of the payload. Of records with
equal payloads of at least ``REVISIT_BYTES`` the first by (row, place) is the
response; the others are ``revisit`` records of it, which keep their HTTP head
but not the payload.

Archives are written as gzip files with a member per record, rolled at about
``FILE_BYTES``, in the shared folder; the list of files is committed by Spark.
Readers stream one file at a time.

Defined results: a null payload is empty; a null row id gives a record id of
its own kind and reads back as null; files with equal ids have records each,
which share their record ids; a null file, or one with a version block alone,
has no records; an empty table writes no file; a file without a version block
and malformed header lines raise with their text; other columns are not
carried.
"""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import Any, BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import join_hot, one_by_one, prepare, work_dir, written
from kiln.llm.storage import new_name, reading, writing

REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An extension field: bytes of the payload, which a revisit does not hold.
LENGTH = "X-Payload-Length"
BATCH_BYTES = 8 << 20
#: Header fields of an ARC record by version (fixed values of the format).
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"),
}


# ---- ARC ------------------------------------------------------------------

def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 kiln\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    head = {1: f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n",
            2: f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}\n"}[version]
    return head.encode() + body


def arc_record(version: int, url: str, date: str, body: bytes, mime: str = "text/html", name: str = "-") -> bytes:
    extra = f"200 {hashlib.sha256(body).hexdigest()} - 0 {name} " if version == 2 else ""
    return f"{url} 0.0.0.0 {date} {mime} {extra}{len(body)}\n".encode() + body + b"\n"


def unpacked(stream: BinaryIO) -> BinaryIO:
    """The stream itself, or what its gzip members hold."""
    f = io.BufferedReader(stream)
    return io.BufferedReader(gzip.GzipFile(fileobj=f)) if f.peek(2)[:2] == b"\x1f\x8b" else f


def parse_arc(source: bytes | BinaryIO) -> Iterator[tuple[dict, bytes]]:
    """(header fields, body) of every record of an ARC file, plain or packed,
    without its version blocks."""
    f = unpacked(io.BytesIO(source) if isinstance(source, bytes) else source)
    version = 0
    while line := f.readline():
        if line in (b"\n", b"\r\n"):
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        block = text.startswith("filedesc://")
        if not block and not version:
            raise ValueError(f"no ARC version block before {text[:200]!r}")
        names = ARC_FIELDS[version if not block else 1 if text.count(" ") == 4 else 2]
        fields = text.rsplit(" ", len(names) - 1)
        if len(fields) != len(names) or not fields[-1].isdigit():
            raise ValueError(f"not an ARC header line: {text[:200]!r}")
        body = f.read(int(fields[-1]))
        if len(body) != int(fields[-1]):
            raise ValueError(f"ARC record is cut short: {text[:200]!r}")
        if not block:
            yield dict(zip(names, fields)), body
            continue
        version = int(body[:1]) if body[:1].isdigit() else 0
        if version not in ARC_FIELDS:
            raise ValueError(f"unknown ARC version {body[:20]!r}")


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, payload); no head if the body does not begin
    with a status line."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    ends = [at + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if (at := body.find(mark)) >= 0]
    end = min(ends, default=len(body))
    return body[:end], body[end:]


# ---- WARC -----------------------------------------------------------------

def record_id(row: int | None, digest: bytes, place: int = 0, unnamed: str = "") -> str:
    """``urn:uuid`` of version 8: the 64 bits of the file's row and 24 bits of
    the payload digest, or of the place of a record behind the first one.
    Without a row, ``unnamed`` tells the record from all others."""
    low = digest[:3]
    if row is None:
        mark, value = "b", int.from_bytes(hashlib.sha256(unnamed.encode()).digest()[:8], "big")
    else:
        mark, value = "9" if place else "a", row & (2**64 - 1)
        low = place.to_bytes(3, "big") if place else low
    h = f"{value:016x}"
    return f"<urn:uuid:6b696c6e-{h[:4]}-8{h[4:7]}-{mark}{h[7:10]}-{h[10:16]}{low.hex()}>"


def row_of(record: str) -> int | None:
    """The row number in a record id, null if it holds none."""
    parts = record.strip("<>").removeprefix("urn:uuid:").split("-")
    if parts[0] != "6b696c6e" or parts[3][0] not in "a9":
        return None
    value = int(parts[1] + parts[2][1:] + parts[3][1:] + parts[4][:6], 16)
    return value - 2**64 if value >= 2**63 else value


def warc_date(arc_date: str) -> str:
    """ISO 8601 of an ARC date of 14 digits; shorter dates are filled up."""
    digits = (arc_date + "19960101000000"[len(arc_date):])[:14]
    return dt.datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in {**fields, "Content-Length": str(len(block))}.items())
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def convert(r: dict[str, Any], rid: str, original: str | None) -> bytes:
    """The WARC record of a row of ``records``: a response, or a revisit of
    the record id ``original``."""
    payload, digest = r["payload"], r["digest"].hex()
    http = r["head"] or (f"HTTP/1.1 {r['code']} OK\r\nContent-Type: {r['mime']}\r\n"
                         f"Content-Length: {len(payload)}\r\n\r\n").encode()
    fields = {"WARC-Type": "revisit" if original else "response", "WARC-Record-ID": rid,
              "WARC-Date": warc_date(r["date"]), "WARC-Target-URI": r["url"].replace("\r", "%0D"),
              "WARC-IP-Address": r["ip"], "Content-Type": "application/http; msgtype=response",
              "WARC-Payload-Digest": f"sha256:{digest}", LENGTH: str(len(payload))}
    if original:
        fields |= {"WARC-Refers-To": original, "WARC-Profile": PROFILE}
        return warc_record(fields, http)
    block = http + payload
    return warc_record(fields | {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}"}, block)


def parse_warc(stream) -> Iterator[tuple[dict, bytes]]:
    """(fields, block) of every record of an open, unpacked WARC stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8").partition(":")
            fields[k.strip()] = v.strip()
        n = int(fields["Content-Length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("WARC record is cut short")
        yield fields, block


# ---- Spark ----------------------------------------------------------------

def to_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
           date: str = "20240101000000") -> DataFrame:
    """Legacy input: (row, arc), an ARC file of one record per page, the body
    with a server's head as in a crawl. Rows with an odd id are version 2, the
    others version 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arcs = []
            for row, url, body in zip(*[b.column(i).to_pylist() for i in range(3)]):
                version = 2 if (row or 0) % 2 else 1
                url = (url or "-").replace("\n", "%0A")
                body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + (body or b"")
                arcs.append(arc_version_block(version, "pages.arc", date) + arc_record(version, url, date, body))
            yield pa.RecordBatch.from_pydict({"row": b.column(0), "arc": pa.array(arcs, pa.binary())})

    slim = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(body_col).cast("binary"))
    return slim.mapInArrow(run, "row long, arc binary")


_PARSED = ("row long, place long, url string, ip string, date string, mime string, code string, head binary, "
           "payload binary, digest binary")
_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*[x.split() for x in schema.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(zip(*rows), types)], names=list(names))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, arc or path) -> records, in batches of about BATCH_BYTES."""
    rows: list[tuple] = []
    size = 0
    for b in batches:
        for row, arc in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if arc is None:
                continue
            with reading(arc) if isinstance(arc, str) else io.BytesIO(arc) as f:
                for place, (h, body) in enumerate(parse_arc(f)):
                    head, payload = split_http(body)
                    rows.append((row, place, h["URL"], h["IP-address"], h["Archive-date"], h["Content-type"],
                                 h.get("Result-code", "200"), head, payload, hashlib.sha256(payload).digest()))
                    size += len(body)
                    if size >= BATCH_BYTES or len(rows) == 5000:
                        yield _batch(rows, _PARSED)
                        rows, size = [], 0
    if rows:
        yield _batch(rows, _PARSED)


def records(arcs: DataFrame) -> DataFrame:
    """One row per record of ARC files given as values (row, arc) or by path
    (row, path): row, place in the file, url, ip, date, mime, code, head,
    payload, digest. Files by path are dealt one by one over the tasks."""
    if "path" in arcs.columns:
        return one_by_one(arcs.select(F.col("row").cast("long"), F.col("path").cast("string"))).mapInArrow(_parse, _PARSED)
    return arcs.select(F.col("row").cast("long"), F.col("arc").cast("binary")).mapInArrow(_parse, _PARSED)


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        waiting = (row for b in batches for row in b.to_pylist())
        row = next(waiting, None)
        while row is not None:
            name, size, n = new_name(folder, f"part-{part:06d}", ".warc.gz"), 0, 0
            with writing(name) as out:
                while row is not None and size < FILE_BYTES:
                    digest, to = row["digest"], row["original"]
                    rid = record_id(row["row"], digest, row["place"], f"{name} {n}")
                    packed = gzip.compress(convert(row, rid, to and record_id(to["row"], digest, to["place"])), 6, mtime=0)
                    out.write(packed)
                    size, n, row = size + len(packed), n + 1, next(waiting, None)
            yield pa.RecordBatch.from_pydict({"path": pa.array([name]), "records": pa.array([n], pa.int64())})
    return run


def write(arcs: DataFrame, folder: str) -> DataFrame:
    """Convert ARC files, (row, arc) or (row, path), to WARC files and return
    the committed list of files (path, records)."""
    spark = arcs.sparkSession
    prepare(spark)
    found = records(arcs)
    facts = written(found.select("row", "place", "digest", F.length("payload").alias("bytes")), work_dir(spark, "payloads"))
    large = facts.filter(F.col("bytes") >= REVISIT_BYTES).drop("bytes")
    named = F.when(F.col("row").isNotNull(), F.struct("row", "place"))
    groups = (large.groupBy("digest").agg(F.min(named).alias("original"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1 AND original IS NOT NULL").drop("n"))
    first = F.col("row").eqNullSafe(F.col("original.row")) & (F.col("place") == F.col("original.place"))
    again = join_hot(large, groups, ["digest"]).filter(~first).select(
        F.col("row").alias("r"), F.col("place").alias("p"), F.col("digest").alias("d"), "original").distinct()
    same = found.row.eqNullSafe(again.r) & (found.place == again.p) & (found.digest == again.d)
    files = found.join(again, same, "left").drop("r", "p", "d").mapInArrow(_writer(folder), "path string, records long")
    return written(files, f"{folder}/files")


_RECORD = ("row long, record_id string, target_uri string, date string, record_type string, payload_digest string, "
           "payload_bytes long, refers_to long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path in b.column(0).to_pylist():
            rows: list[tuple] = []
            with reading(path) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for f, block in parse_warc(io.BufferedReader(stream)):
                    payload = split_http(block)[1]
                    digest = f["WARC-Payload-Digest"].partition(":")[2]
                    length = int(f[LENGTH])
                    if f["WARC-Type"] == "response" and (len(payload) != length
                                                         or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {f['WARC-Record-ID']} does not fit its digest")
                    to = f.get("WARC-Refers-To")
                    rows.append((row_of(f["WARC-Record-ID"]), f["WARC-Record-ID"], f["WARC-Target-URI"], f["WARC-Date"],
                                 f["WARC-Type"], digest, length, row_of(to) if to else None))
                    if len(rows) == 5000:
                        yield _batch(rows, _RECORD)
                        rows = []
            if rows:
                yield _batch(rows, _RECORD)


def read(files: DataFrame) -> DataFrame:
    """The records of the listed files, payloads checked against their digests."""
    return one_by_one(files.select("path")).mapInArrow(_read, _RECORD)
