"""Web archives: a writer of gzip WARC files and a splittable reader.

Every record is a gzip member of its own.  The reader deals byte ranges of the files to tasks: a task scans its range for the gzip
magic, takes a candidate for a record only if its first bytes decode to a WARC version line and the whole member decodes with
its checksum, and owns the records that start inside the range, reading past its end for the last one.  After a record
the next is looked for where its member ends.  Payloads that were written before are stored as revisits that name the first
record.  Files are written under a new name by every task attempt, and only the names that reach the manifest (a table in the
shared folder) are read, so an attempt that is lost or repeated leaves nothing behind that counts.

Defined results: a null html is an empty payload; a null url leaves out the target; of equal payloads the records with the smallest
page_id are responses and those with larger ones revisits, and a record without page_id is a response; an empty table gives no
records.  Only page_id, url and html are read, whatever other columns there are.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.session import new_stage_path, write_stage

#: A file is closed when it has reached this size; a range of a file that one task reads.
ARCHIVE_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
#: Payload bytes of a batch of rows.
BATCH_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "2000-01-01T00:00:00Z"
_BLOCK = 1 << 20

RECORD = (
    "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, intact boolean, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(record_type: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """One record as one gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in headers.items() if v is not None] + [f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def page_urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_member(page: int | None, url: str | None, body: bytes | None, sha1: bytes, size: int, first: int | None) -> bytes:
    """A response with its payload, or (``first`` is given) a revisit of the record of that page."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = {
        "WARC-Record-ID": page_urn(page),
        "WARC-Target-URI": None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(sha1).decode(),
        "Content-Type": "application/http; msgtype=response",
    }
    if first is None:
        return member("response", headers, head + body)
    headers |= {"WARC-Refers-To": page_urn(first), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return member("revisit", headers, head)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages to ``folder``, which every executor must reach; returns the manifest (path, size, records)."""
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"))
    rows = rows.select("*", F.unhex(F.sha1("body")).alias("sha1"), F.octet_length("body").cast("long").alias("size"))
    firsts = write_stage(rows.groupBy("sha1", "size").agg(F.min("page_id").alias("least")), "warc-firsts")
    first = F.when(F.col("page_id") > F.col("least"), F.col("least"))
    dealt = rows.join(firsts, ["sha1", "size"]).select("page_id", "url", "sha1", "size", first.alias("first"), "body")
    dealt = dealt.withColumn("body", F.when(F.col("first").isNull(), F.col("body")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = FileSystem.from_uri(folder)
        out, path, size, records = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for page, url, sha1, length, first_page, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{path}", compression=None)  # members are packed already
                    info = member("warcinfo", {"WARC-Record-ID": uuid.uuid4().urn.join("<>"), "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size, records = len(info), 1
                data = page_member(page, url, data, sha1, length, first_page)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{path}", size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{path}", size, records))
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(("path", "size", "records"), map(list, zip(*done, strict=True)), strict=True)))

    store, root = FileSystem.from_uri(folder)
    store.create_dir(root)
    return write_stage(dealt.mapInArrow(run, "path string, size long, records long"), "warc-manifest")


class Window:
    """Reads of one file through a block that is kept."""

    def __init__(self, file: Any) -> None:
        self.file, self.base, self.data = file, 0, b""

    def at(self, offset: int, least: int = 1) -> memoryview:
        """The bytes known from ``offset`` on: ``least`` of them unless the file ends before."""
        if not self.base <= offset <= offset + least <= self.base + len(self.data):
            self.file.seek(offset)
            self.base, self.data = offset, self.file.read(max(_BLOCK, least))
        return memoryview(self.data)[offset - self.base :]

    def find_magic(self, offset: int, end: int) -> int | None:
        """The first place before ``end`` where the magic begins."""
        while offset < end:
            here = self.at(offset, len(MAGIC))
            found = self.data.find(MAGIC, offset - self.base)
            if found >= 0:
                return self.base + found if self.base + found < end else None
            if len(here) < len(MAGIC):
                return None
            offset += len(here) - len(MAGIC) + 1
        return None

    def member(self, offset: int) -> tuple[bytes, int] | None:
        """The record in the gzip member at ``offset`` and the offset of the member's end; None if there is no such record."""
        opener = zlib.decompressobj(31)
        parts, seen, fed = [], b"", offset
        try:
            while not opener.eof:
                data = self.at(fed)[: 1 << 16]
                if not data:
                    return None
                part = opener.decompress(data)
                fed += len(data)
                parts.append(part)
                if len(seen) < 7:
                    seen += part[:7]
                    if not b"WARC/1."[: len(seen)] == seen[:7]:
                        return None
        except zlib.error:
            return None
        return (b"".join(parts), fed - len(opener.unused_data)) if seen[:7] == b"WARC/1." else None


def parse_record(raw: bytes) -> dict[str, Any] | None:
    """The fields of ``RECORD`` that the record itself holds; None where its headers make no record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    length = fields.get("content-length", "")
    if not length.isdecimal() or len(rest) < int(length) or "warc-type" not in fields:
        return None
    block = rest[: int(length)]
    out: dict[str, Any] = {"record_type": fields["warc-type"], "record_id": fields.get("warc-record-id")}
    out |= {"target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to")}
    out["payload_digest"] = (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        said = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
        if out["record_type"] == "revisit":
            return out | {"payload_bytes": int(said[1]) if said else None, "intact": True, "payload": None}
    else:
        payload = block
    intact = out["payload_digest"] is None or base32_sha1(payload) == out["payload_digest"]
    return out | {"payload_bytes": len(payload), "intact": intact, "payload": payload}


def records_from(file: Any, start: int, end: int) -> Iterator[tuple[int, dict[str, Any]]]:
    """The records that start in [start, end) with their offsets."""
    window, at = Window(file), start
    while (found := window.find_magic(at, end)) is not None:
        got = window.member(found)
        record = parse_record(got[0]) if got else None
        if record is None:
            at = found + 1
        else:
            yield found, record
            at = got[1]


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records (``RECORD``) of the files of ``manifest`` (path, size), read range by range."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long")))
    ranges = manifest.where("size > 0").select("path", starts.alias("start"))
    ranges = ranges.repartition(max(1, ranges.count()))  # a task for each range
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.schema(dict(zip(names, [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.bool_(), pa.binary()], strict=True)))
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    for offset, record in records_from(file, start, start + split_bytes):
                        rows.append({"path": path, "offset": offset} | record)
                        held += len(record["payload"] or b"") + 500
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=types)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=types)

    return ranges.mapInArrow(run, RECORD)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = new_stage_path(spark, "warc")
    records = read_archives(write_archives(pages, folder)).where("record_type in ('response', 'revisit')")
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as long)")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.when(F.col("intact"), F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )
