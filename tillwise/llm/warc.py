"""WARC archives: a writer with one gzip member per record, and a sequential reader.

``write_archives`` turns rows into WARC/1.1 ``response`` records, or ``revisit``
records for payloads already written, in files under a shared folder; it returns a
manifest of the files of committed tasks. ``read_archives`` streams each listed file
member by member: bytes are inflated as they are read, the block is framed by its
Content-Length, and digests are verified. A task holds one record at a time.

Files are opened through pyarrow's file systems, so the folder may be any URI these
know (a mounted folder, HDFS, S3). A task that is run again writes under a new name,
and the manifest lists that name only.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.workspace import fresh_path, materialise

FILE_BYTES = 256 << 20
_READ_BYTES = 1 << 18
_BATCH_BYTES = 8 << 20

# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "path string, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary, problem string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _clean(value: str) -> str:
    """A header value: control characters and white space percent-encoded, so none can end a line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), value)


def record_bytes(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member. With ``refers_to`` it is a revisit without its payload."""
    digest = sha1_base32(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode("ascii")
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", HTTP_TYPE),
        ("WARC-Block-Digest", "sha1:" + sha1_base32(block)),
        ("WARC-Payload-Digest", "sha1:" + digest),
        ("Content-Length", str(len(block))),
    ]
    if uri is not None:
        head.insert(3, ("WARC-Target-URI", _clean(uri)))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head).encode("utf-8")
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + press.flush()


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _write(batches: Iterator[pa.RecordBatch], folder: str, limit: int) -> Iterator[pa.RecordBatch]:
    system, root = _place(folder)
    out = path = None
    records = size = 0

    def done() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

    for batch in batches:
        for record_id, uri, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            data = record_bytes(record_id, uri, payload or b"", refers_to)
            if out is not None and size + len(data) > limit:
                yield done()
                out = None
            if out is None:
                name = f"{uuid.uuid4().hex}.warc.gz"
                path = f"{folder}/{name}"
                out = system.open_output_stream(f"{root}/{name}", compression=None)
                records = size = 0
            out.write(data)
            records += 1
            size += len(data)
    if out is not None:
        yield done()


def write_archives(
    rows: DataFrame,
    record_id: Column,
    uri: Column,
    payload: Column,
    refers_to: Column,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per row and return the manifest ``path, records, bytes``.

    ``payload`` is text or binary; null counts as empty. A null ``uri`` leaves the
    header out. Rows with a non-null ``refers_to`` (a record id) become revisits.
    """
    spark = rows.sparkSession
    folder = fresh_path(spark, "warc")
    system, root = _place(folder)
    system.create_dir(root, recursive=True)
    chosen = rows.select(
        record_id.cast("string"), uri.cast("string"), payload.cast("binary"),
        refers_to.cast("string"),
    )
    return materialise(
        chosen.mapInArrow(lambda batches: _write(batches, folder, file_bytes), MANIFEST),
        "warc-manifest",
    )


def members(stream) -> Iterator[tuple[bytes, str | None]]:
    """The inflated gzip members of a stream one after another, with what went wrong."""
    rest = b""
    while True:
        rest = rest or stream.read(_READ_BYTES)
        if not rest:
            return
        inflate, parts = zlib.decompressobj(31), []
        try:
            while not inflate.eof:
                parts.append(inflate.decompress(rest))
                rest = b""
                if not inflate.eof:
                    rest = stream.read(_READ_BYTES)
                    if not rest:
                        yield b"".join(parts), "truncated member"
                        return
        except zlib.error:
            # Where the next member begins cannot be known.
            yield b"".join(parts), "damaged member"
            return
        rest = inflate.unused_data
        yield b"".join(parts), None


def _headers(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, _, value = line.partition(b":")
        found[name.strip().lower().decode("utf-8", "replace")] = (
            value.strip().decode("utf-8", "replace")
        )
    return found


def parse_record(data: bytes, problem: str | None = None) -> dict:
    """Fields of one inflated record; ``problem`` names the first check that failed."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not problem and (not mark or not lines[0].startswith(b"WARC/")):
        problem = "no WARC header"
    named = _headers(lines[1:])
    length = named.get("content-length", "")
    size = int(length) if length.isdigit() else len(rest)
    block = rest[:size]
    if not problem and (not length.isdigit() or rest[size:] != b"\r\n\r\n"):
        problem = "length mismatch"
    claimed = named.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = named.get("warc-type")
    payload, payload_bytes = block, len(block)
    if named.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        told = _headers(http.split(b"\r\n")[1:]).get("content-length", "")
        payload_bytes = int(told) if kind == "revisit" and told.isdigit() else len(payload)
    if not problem and "warc-block-digest" in named and (
        named["warc-block-digest"] != "sha1:" + sha1_base32(block)
    ):
        problem = "block digest mismatch"
    if not problem and claimed and kind != "revisit" and claimed != sha1_base32(payload):
        problem = "payload digest mismatch"
    bare = lambda name: named[name].strip("<>") if name in named else None
    return {
        "record_type": kind,
        "record_id": bare("warc-record-id"),
        "target_uri": named.get("warc-target-uri"),
        "refers_to": bare("warc-refers-to"),
        "payload_digest": claimed or None,
        "payload_bytes": payload_bytes,
        "payload": None if kind == "revisit" else payload,
        "problem": problem,
    }


def _read(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inside = _place(path)
            rows, size = [], 0
            with system.open_input_stream(inside, compression=None) as stream:
                for data, problem in members(stream):
                    rows.append({"path": path} | parse_record(data, problem))
                    size += len(data)
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the files in ``manifest.path``, each file read in order by one task.

    Damaged archives do not fail the job: a record that fails a check is returned with
    its ``problem``; what follows a damaged gzip member in its file cannot be read.
    A revisit's ``payload`` is null; its ``payload_bytes`` is the length its HTTP
    header gives for the payload it stands for.
    """
    fields = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, fields[t]) for n, t in (c.split() for c in RECORDS.split(", "))])
    files = max(1, manifest.count())
    return (
        manifest.select("path")
        .repartition(files)
        .mapInArrow(lambda batches: _read(batches, schema), RECORDS)
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; the manifest is returned.

    Of pages with equal payloads the one with the largest page_id is the response,
    the others revisit it (pages that share that largest id are all responses, and
    so is a group whose ids are all null). Null html is an empty payload. Columns
    beyond the three are ignored. Only (page_id, digest) is shuffled to find the
    groups; a hot payload is combined before the shuffle.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", F.sha1(html).alias("digest"), F.length(html).alias("size"))
    first = keyed.groupBy("digest", "size").agg(
        F.max("page_id").alias("refers_to"), F.count("*").alias("copies")
    )
    # Written, so that Spark knows its size when it chooses the join with the pages.
    revisits = materialise(
        keyed.join(first.where("copies > 1"), ["digest", "size"])
        .where("refers_to is not null and not (page_id <=> refers_to)")
        .select(F.col("page_id").alias("revisit_id"), F.col("digest").alias("revisit_digest"),
                "refers_to")
        .distinct(),
        "warc-revisits",
    )
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest")).join(
        revisits,
        F.expr("page_id <=> revisit_id and digest = revisit_digest"),
        "left",
    )
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("none")))
    return write_archives(
        rows, name(F.col("page_id")), F.col("url"), F.col("html"),
        F.when(F.col("refers_to").isNotNull(), name(F.col("refers_to"))),
    )


def page_of(record_id: Column) -> Column:
    """The page id in a record id made by ``archive_pages``; null where there is none."""
    return F.regexp_extract(record_id, r"^urn:page:(-?\d+)$", 1).try_cast("long")
