"""WARC archives: writer, and a reader that splits files at any byte.

Writing: each task packs its pages into gzip files of one member per record. A
task attempt uses file names of its own; the manifest of files, written with
Spark's commit protocol, lists only the attempts that counted.

Reading: files are cut into byte ranges without an index. A task looks for the
gzip magic in its range, takes a candidate for a record only if the member's
first bytes decode to a WARC header, and owns every record that starts inside
its range, reading past the range's end to finish the last one.

Of pages with equal payloads of at least ``least_bytes`` bytes the one with the
smallest id is a response and the others are revisits without the payload.
Digests are grouped map-side; the list of revisits is broadcast only if its
measured size allows it, else joined by id.

Cases: null html is an empty payload; null urls have no target header and come
back null; rows that repeat the smallest id are all responses; a null id is a
revisit of a smaller one if there is any, else a response; an empty table gives
no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote_to_bytes

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcraft.llm.membership import bound_batches
from fieldcraft.session import broadcast_if_small, materialize, scratch_path

DATE = "2024-01-01T00:00:00Z"
FILE_BYTES, SPLIT_BYTES, READ_BYTES, PROBE = 256 << 20, 8 << 20, 1 << 20, 1 << 10
MAGIC = b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
MANIFEST = "path string, bytes long, records long"
RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(url: str) -> str:
    return quote(url, safe=":/?#[]@!$&'()*+,;=~-._")


def record(page_id, url, payload: bytes, refers_to, is_revisit: bool) -> bytes:
    """One WARC record (not compressed)."""
    digest = digest32(payload)
    block = HTTP + b"Content-Length: %d\r\n\r\n" % len(payload) + (b"" if is_revisit else payload)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{url}:{digest}")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if is_revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"X-Refers-To-Page: {refers_to}")
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    head += [f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record's bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    f = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(f["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    num = lambda k: int(f[k]) if k in f else None
    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
    if f["WARC-Type"] == "response" and digest != digest32(payload):
        raise ValueError(f"payload digest of {f['WARC-Record-ID']} does not match")
    uri = f.get("WARC-Target-URI")
    return {"page_id": num("X-Page"), "url": None if uri is None else unquote_to_bytes(uri).decode(),
            "record_type": f["WARC-Type"],
            "payload_bytes": len(payload) if f["WARC-Type"] == "response" else num("X-Payload-Length"),
            "payload_digest": digest, "refers_to": num("X-Refers-To-Page"), "payload": payload}


def _member(raw: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def _store(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


def mark_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``page_id, url, html, refers_to`` (null for responses), ``revisit``."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("size"))
    groups = (keyed.filter(F.col("size") >= least_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
              .select(F.col("digest").alias("key"), "first"))
    groups = materialize(groups, "payloads")
    # only pages of a repeated payload, without their html
    again = keyed.join(broadcast_if_small(groups), F.col("digest") == F.col("key"))
    again = (again.filter("first IS NOT NULL AND (page_id IS NULL OR page_id <> first)")
             .select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "first").distinct())
    again = materialize(again, "revisits")
    on = (F.col("page_id").eqNullSafe(F.col("__page"))) & (F.sha1(html) == F.col("__digest"))
    return (pages.join(broadcast_if_small(again), on, "left")
            .select("page_id", "url", "html", F.col("first").alias("refers_to"),
                    F.col("first").isNotNull().alias("revisit")))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 6,
                   file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``folder``; the manifest."""
    bound_batches(pages.sparkSession)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        t = TaskContext.get()
        stem = f"{base}/pages-{t.partitionId():05d}-{t.taskAttemptId()}"
        out, path, size, n, made = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(c for c in batch.columns)):
                page, url, html, refers, revisit = (x.as_py() for x in row)
                if out is None:
                    path, size, n = f"{stem}-{len(made):04d}.warc.gz", 0, 0
                    out = store.open_output_stream(path, compression=None)
                member = _member(record(page, url, (html or "").encode(), refers, revisit), level)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    out.close()
                    made.append((path, size, n))
                    out = None
        if out is not None:
            out.close()
            made.append((path, size, n))
        if made:
            yield pa.record_batch([pa.array(c) for c in zip(*made)], ["path", "bytes", "records"])

    return materialize(mark_revisits(pages.select("page_id", "url", "html"), least_bytes)
                       .mapInArrow(run, MANIFEST), "manifest")


class _Range:
    """Bytes of a file from ``start`` on, fetched as they are asked for."""

    def __init__(self, file, start: int, size: int) -> None:
        self.file, self.start, self.size, self.data = file, start, size, bytearray()

    def until(self, end: int) -> None:
        end = min(end, self.size)
        have = self.start + len(self.data)
        if end > have:
            self.file.seek(have)
            self.data += self.file.read(end - have)

    def drop(self, pos: int) -> None:
        del self.data[:pos - self.start]
        self.start = pos


def records_in(file, size: int, start: int, end: int):
    """(offset, record bytes) of the members that start in [start, end)."""
    buf, pos = _Range(file, start, size), start
    while pos < end:
        buf.until(pos + READ_BYTES)
        at = buf.data.find(MAGIC, pos - buf.start)
        if at < 0:
            pos = max(pos, buf.start + len(buf.data) - len(MAGIC) + 1)
            if buf.start + len(buf.data) >= size:
                return
            buf.drop(pos)
            continue
        pos = buf.start + at
        if pos >= end:
            return
        buf.drop(pos)
        buf.until(pos + PROBE)
        try:
            head = zlib.decompressobj(31).decompress(bytes(buf.data[:PROBE]), 64)
        except zlib.error:
            head = b""
        if not re.match(rb"WARC/1\.[01]\r\n", head):
            pos += 1
            continue
        d, parts, used = zlib.decompressobj(31), [], 0
        while not d.eof:
            if used >= len(buf.data):
                if pos + used >= size:
                    raise ValueError(f"record at byte {pos} is cut off")
                buf.until(pos + used + READ_BYTES)
            chunk = bytes(buf.data[used:used + READ_BYTES])
            parts.append(d.decompress(chunk))
            used += len(chunk) - len(d.unused_data)
        yield pos, b"".join(parts)
        pos += used


def read_archives(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES,
                  with_payload: bool = True) -> DataFrame:
    """Records of the files of a manifest, read by byte ranges."""
    splits = manifest.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    n = splits.count()
    keep = RECORD if with_payload else RECORD.replace(", payload binary", "")
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batches):
        import pyarrow as pa
        types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        store, _ = _store(folder)
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held = [], 0
                with store.open_input_file(path) as f:
                    for _, raw in records_in(f, size, start, min(start + split_bytes, size)):
                        rows.append(parse(raw))
                        held += len(raw)
                        if held > READ_BYTES:
                            yield pa.record_batch([pa.array([r[c] for r in rows], types.get(c, pa.string()))
                                                   for c in names], names)
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array([r[c] for r in rows], types.get(c, pa.string()))
                                           for c in names], names)

    return splits.repartition(max(1, n)).mapInArrow(run, keep)


def round_trip(pages: DataFrame, least_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write all pages, then read the archives back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, least_bytes), folder, split_bytes, with_payload=False)
