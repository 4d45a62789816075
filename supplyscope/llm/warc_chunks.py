"""WARC archives from a chunked record table.

A payload is a run of rows ``(record, chunk_no, data)`` of bounded size. Each
row carries the byte count and SHA-1 of the payload up to its end, so the last
row of a record has the payload's size and digest, and no task holds more of
a payload than a chunk. Records with equal payloads (size and SHA-1) are
written once: the one with the largest page id is the response, the others
are revisits that refer to it. Archives are files of one gzip member per
record, streamed in both directions.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.common import reliable, stage_table
from supplyscope.session import drop_path

CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"          # the pages carry no capture time


def chunk_table(pages: DataFrame, chunk: int = CHUNK, key: str = "page_id", url: str = "url",
                html: str = "html") -> DataFrame:
    """``(record, chunk_no, chunks, page_id, url, data, bytes, digest)``; null payloads are empty.

    Rows of a record come from one input row, in order, so the digest runs
    along within the scan's tasks and nothing is shuffled.
    """
    body = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    rows = pages.select(F.monotonically_increasing_id().alias("record"), F.col(key).cast("long").alias("page_id"),
                        F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.octet_length("body") / F.lit(chunk)).cast("int")))
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.withColumn("data", F.substring("body", F.col("chunk_no") * chunk + 1, F.lit(chunk))).drop("body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, size = hashlib.sha1(), 0
        for b in batches:
            sizes, digests = [], []
            for no, data in zip(b.column("chunk_no").to_pylist(), b.column("data")):
                if no == 0:
                    sha, size = hashlib.sha1(), 0
                data = data.as_buffer()
                sha.update(data)
                size += len(data)
                sizes.append(size)
                digests.append(base64.b32encode(sha.copy().digest()).decode())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                                             names=[*b.schema.names, "bytes", "digest"])

    names = ["record", "chunk_no", "chunks", "page_id", "url", "data"]
    return rows.select(*names).mapInArrow(run, "record long, chunk_no int, chunks int, page_id long, url string, "
                                               "data binary, bytes long, digest string")


def record_types(chunks: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``(record, bytes, digest, record_type, refers_to, refers_record)`` per record.

    Of equal payloads the largest page id is the response (a null id is the
    smallest; of repeated ids the later row). The group of a payload is one
    row, so a payload that a third of the records share is a skewed equi-join
    of narrow rows, which adaptive execution splits.
    """
    one = chunks.where("chunk_no = chunks - 1").select("record", "page_id", "bytes", "digest")
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("k"), "page_id", "record")).alias("best")
    group = one.groupBy("digest", "bytes").agg(best, F.count(F.lit(1)).alias("n")).where("n > 1")
    group = group.where(F.col("bytes") >= min_revisit_bytes)
    j = one.join(group, ["digest", "bytes"], "left")
    again = F.col("best").isNotNull() & (F.col("best.record") != F.col("record"))
    return j.select("record", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                    F.when(again, "revisit").otherwise("response").alias("record_type"),
                    F.when(again, F.col("best.page_id")).alias("refers_to"),
                    F.when(again, F.col("best.record")).alias("refers_record"))


def _uri(page_id: int | None, record: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{record}>"


def _head(r: dict) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {r['payload_bytes']}\r\n\r\n").encode()
    revisit = r["record_type"] == "revisit"
    target = re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", r["url"] or "")
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {_uri(r['page_id'], r['record'])}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}",
             "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(http) + (0 if revisit else r['payload_bytes'])}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_uri(r['refers_to'], r['refers_record'])}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def write_archives(chunks: DataFrame, types: DataFrame, root: str) -> DataFrame:
    """Stream the records into one archive per task; returns the committed ``(file, records)``.

    Only responses bring their data, and a record's chunks meet in order in
    one task. Names are unique to the task attempt.
    """
    rows = (chunks.drop("bytes", "digest", "chunks").join(types, "record")
            .where("record_type = 'response' or chunk_no = 0")
            .withColumn("data", F.when(F.col("record_type") == "response", F.col("data")))
            .repartition("record").sortWithinPartitions("record", "chunk_no"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, records, gz = None, None, 0, None
        for b in batches:
            for i, r in enumerate(b.drop_columns(["data"]).to_pylist()):
                if out is None:
                    fs, base = pafs.FileSystem.from_uri(root)
                    fs.create_dir(base, recursive=True)
                    name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{base}/{name}")
                if r["chunk_no"] == 0:
                    if gz is not None:
                        out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(gz.compress(_head(r)))
                    records += 1
                data = b.column("data")[i].as_buffer()
                if data is not None:
                    out.write(gz.compress(data))
        if out is not None:
            out.write(gz.compress(b"\r\n\r\n") + gz.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["file", "records"])

    return reliable(rows.mapInArrow(run, "file string, records long"))


class Members:
    """Forward reader of concatenated gzip members, a bounded buffer at a time."""

    def __init__(self, src, step: int = CHUNK):
        self.src, self.step, self.z, self.raw, self.buf = src, step, None, b"", b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.src.read(self.step)
                if not self.raw:
                    return False
            if self.z is None:
                self.z = zlib.decompressobj(31)
            got = self.z.decompress(self.raw, self.step)
            self.raw = self.z.unconsumed_tail or self.z.unused_data
            if self.z.eof:
                self.z = None
            if got:
                self.buf += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.buf.find(mark)) < 0:
            if not self.more():
                if self.buf.strip():
                    raise ValueError("the archive ends within a record")
                return None
        head, self.buf = self.buf[:at], self.buf[at + len(mark):]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buf and not self.more():
                raise ValueError("the archive ends within a record")
            part, self.buf = self.buf[:n], self.buf[n:]
            n -= len(part)
            yield part


def read_records(src) -> Iterator[dict]:
    """Records of one archive; payloads are hashed as they pass, never held."""
    m = Members(src)
    while (head := m.until(b"\r\n\r\n")) is not None:
        lines = head.decode().lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record begins here: {lines[0][:40]!r}")
        h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        http = m.until(b"\r\n\r\n")
        left = int(h["Content-Length"]) - len(http) - 4
        sha, size = hashlib.sha1(), 0
        for part in m.take(left):
            sha.update(part)
            size += len(part)
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        full = int(re.search(rb"Content-Length: (\d+)", http)[1])
        if h["WARC-Type"] == "response":
            if (size, base64.b32encode(sha.digest()).decode()) != (full, digest):
                raise ValueError(f"{h['WARC-Record-ID']}: the payload is not the one that was written")
        page, ref = (re.fullmatch(r"<urn:x-page:(-?\d*):\d+>", h.get(k, "")) for k in ("WARC-Record-ID", "WARC-Refers-To"))
        yield {"page_id": int(page[1]) if page[1] else None, "payload_bytes": full, "payload_digest": digest,
               "record_type": h["WARC-Type"], "refers_to": int(ref[1]) if ref and ref[1] else None}
        m.until(b"\r\n\r\n")


def read_archives(files: DataFrame, root: str) -> DataFrame:
    """One row per record of the archives named by ``files(file)``, an archive per row of work."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name in b.column("file").to_pylist():
                fs, base = pafs.FileSystem.from_uri(root)
                with fs.open_input_stream(f"{base}/{name}") as src:
                    held = []
                    for r in read_records(src):
                        held.append(r)
                        if len(held) == 10_000:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    return files.select("file").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, "
                                                "record_type string, refers_to long")


def archive_pages(pages: DataFrame, root: str, chunk: int = CHUNK, **names: str) -> DataFrame:
    """Write ``pages`` as archives below ``root`` and return the committed file list.

    Null html is an empty payload; empty payloads are payloads like others. A
    null or repeated page id is kept (repeated rows are records of their own).
    An empty table writes nothing. Other columns are not read.
    """
    chunks, staged = stage_table(chunk_table(pages, chunk, **names), "warc-chunks", compression="zstd")
    files = write_archives(chunks, record_types(chunks), root)
    drop_path(pages.sparkSession, staged)
    return files
