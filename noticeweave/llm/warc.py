"""WARC archives: one gzip member a record, written by tasks to the shared folder and read back record by record.

The reader takes the file in small pieces, inflates member after member, frames each record by its Content-Length and compares the
payload with its SHA-1; it holds one record at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.llm.shared_files import new_file, open_stream
from noticeweave.operators.durable import durable, new_folder

#: Payloads of fewer bytes are always stored.
LEAST = 1000
_READ = 1 << 16
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (page_id, url, html) with payload_digest and refers_to: the largest page_id with an equal payload of at least `least`
    bytes, null for that page itself and for smaller payloads. Rows that repeat the largest page_id are all responses."""
    told = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("payload_digest", F.sha1("html"))
    last = told.where(F.octet_length("html") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("last"), F.count("*").alias("times")).where("times > 1").drop("times")
    return told.join(last, "payload_digest", "left").select("page_id", "url", "html", "payload_digest", F.expr("CASE WHEN NOT last <=> page_id THEN last END").alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, uncompressed."""
    kind = "response" if refers_to is None else "revisit"
    block = _HTTP % len(payload) + (payload if refers_to is None else b"")
    named = "null" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{named}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (see revisits) as one archive a task; rows (path, records). Compute it once: see durable()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        count = 0
        with new_file(folder, f"part-{TaskContext.get().partitionId():06d}", ".warc.gz") as (path, out):
            while batch is not None:
                html = batch.column("html").cast(pa.large_string()).cast(pa.large_binary())
                for i, (page_id, url, digest, refers_to) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload_digest", "refers_to")))):
                    out.write(_member(record(page_id, url, html[i].as_py(), digest, refers_to)))
                count += batch.num_rows
                batch = next(batches, None)
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], names=["path", "records"])

    return pages.mapInArrow(run, "path string, records long")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip stream, in order."""
    rest = b""
    while True:
        inflate, record_, need, headers = zlib.decompressobj(31), bytearray(), None, {}
        began = False
        while not inflate.eof:
            rest = rest or stream.read(_READ)
            if not rest:
                if began:
                    raise ValueError("the archive ends within a record")
                return
            began = True
            record_ += inflate.decompress(rest)
            rest = inflate.unused_data if inflate.eof else b""
            if need is None and (end := record_.find(b"\r\n\r\n")) >= 0:
                version, *lines = bytes(record_[:end]).decode().split("\r\n")
                if not version.startswith("WARC/"):
                    raise ValueError("not a WARC record")
                headers = dict(line.split(": ", 1) for line in lines)
                need = end + 4, int(headers["Content-Length"])
        if need is None or len(record_) != sum(need) + 4 or record_[-4:] != b"\r\n\r\n":
            raise ValueError("a record is not as long as it says")
        yield headers, bytes(record_[need[0] : -4])


def _parsed(path: str) -> Iterator[tuple]:
    with open_stream(path) as stream:
        for headers, block in read_records(stream):
            payload, digest = block[block.index(b"\r\n\r\n") + 4 :], headers["WARC-Payload-Digest"].removeprefix("sha1:")
            size = int(headers["WARC-Payload-Length"])
            if headers["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
                raise ValueError(f"{headers['WARC-Record-ID']}: the payload is not what its digest says")
            own, other = (headers.get(k, "<urn:page:null>")[10:-1] for k in ("WARC-Record-ID", "WARC-Refers-To"))
            yield None if own == "null" else int(own), headers.get("WARC-Target-URI"), payload if headers["WARC-Type"] == "response" else None, size, digest, headers["WARC-Type"], None if other == "null" else int(other)


_ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives in manifest (path), with verified payloads (null for revisits; left out if not wanted)."""
    schema = _ROW if payload else _ROW.remove(2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for row in _parsed(path):
                    rows.append(row if payload else row[:2] + row[3:])
                    size += len(row[2] or b"") if payload else 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kinds = {"page_id": "long", "url": "string", "payload": "binary", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long"}
    return manifest.select("path").mapInArrow(run, ", ".join(f"{f.name} {kinds[f.name]}" for f in schema))


def round_trip(pages: DataFrame, payload: bool = False) -> DataFrame:
    """Archives of pages (page_id, url, html), read back: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the
    payloads if wanted. One row a page, repeats included; null html is an empty payload; null ids and urls stay null. Long
    payloads are written and read whole; other columns are not read; an empty table gives an empty result."""
    folder = new_folder(pages.sparkSession, "warc")
    manifest = durable(write_archives(revisits(pages), folder), "warc-manifest")
    return read_archives(manifest.repartition(max(1, manifest.count())), payload)
