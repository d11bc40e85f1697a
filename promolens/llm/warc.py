"""WARC archives as a Spark data source.

Writing: every task writes one archive, a gzip member for each record.  Each
member's header carries its compressed and uncompressed size (the ``sl`` field
that the WARC standard describes), so a reader can step over a record without
decompressing it.  Only files named in the manifest, which is written once all
tasks are done, belong to the archive; files of failed attempts do not.

Reading: the driver plans a partition for each stretch of about ``SPLIT`` bytes of
a file, from the manifest's record offsets.  A task decompresses the first bytes of
a member, parses the headers, tests record type and header predicates, and only
then decompresses the payload, and that only if a payload is asked for; else it
jumps to the next member.  Predicates come as options, or from Spark's filters when
``spark.sql.python.filterPushdown.enabled`` is on.

A payload that occurs again is written once: ``plan_revisits`` makes every copy a
revisit record that names the record with the smallest id.

Defined results: a null payload is an empty one; a null id is written without a
record id and, where its payload occurs with an id elsewhere, as a revisit; rows
that share the smallest id are all responses; a null URI is left out and control
characters in a URI are percent-encoded; an empty table gives an empty archive.
Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

# Fixed values of the formats
FORMAT = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
LENGTH_FIELD = "X-Full-Payload-Length"
MANIFEST = "_records.json"
SCHEMA = ("record_id string, record_type string, target_uri string, payload_digest string, refers_to string, "
          "payload_length long, payload binary")
#: Column -> WARC header
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}

#: Bytes of a read partition, bytes first decompressed of a member, rows of a batch and bytes of its payloads.
SPLIT, HEAD, ROWS, BATCH_BYTES = 16 << 20, 1 << 10, 512, 8 << 20


def _open(uri: str):
    if uri.startswith("/"):
        return arrow_fs.LocalFileSystem(), uri
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)", "file:///", uri))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records ------------------------------------------------------------------

def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [FORMAT, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int = 1) -> bytes:
    """One gzip member whose extra field ``sl`` holds compressed and raw size."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(raw) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + (12).to_bytes(2, "little") + b"sl" + (8).to_bytes(2, "little")
            + (size & 0xFFFFFFFF).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little") + body
            + zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little"))


def parse_headers(head: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and where the block begins; None if the headers go on."""
    end = head.find(b"\r\n\r\n")
    if end < 0:
        return None
    first, *lines = head[:end].decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4


def members(stream, start: int, end: int) -> Iterator[tuple[bytes, "callable"]]:
    """From a binary stream, for each member that begins in [start, end): its first
    decompressed bytes and a function that decompresses all of it."""
    at = start
    while at < end:
        stream.seek(at)
        top = stream.read(24)
        if len(top) < 24 or top[:4] != b"\x1f\x8b\x08\x04" or top[12:14] != b"sl":
            raise ValueError(f"no sized gzip member at byte {at}")
        size = int.from_bytes(top[16:20], "little")
        body = stream.read(min(size - 32, HEAD))
        unpack = zlib.decompressobj(-15)
        head = unpack.decompress(body, 4 * HEAD)

        def rest(unpack=unpack, head=head, at=at, size=size, had=len(body)) -> bytes:
            stream.seek(at + 24 + had)
            return head + unpack.decompress(unpack.unconsumed_tail + stream.read(size - 32 - had)) + unpack.flush()

        yield head, rest
        at += size


# --- the data source ----------------------------------------------------------

@dataclass
class _Written(WriterCommitMessage):
    name: str
    size: int
    offsets: list[int]


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sized_warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = _FilteredReader if self.options.get("pushdown", "false") == "true" else _Reader
        return kind(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], schema.names, self.options.get("date", "1970-01-01T00:00:00Z"))


class _Writer(DataSourceArrowWriter):
    """Rows: record_id, record_type, target_uri, refers_to, payload_digest, payload_length, payload."""

    def __init__(self, path: str, names: list[str], date: str):
        self.path, self.names, self.date = path, names, date

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        files, folder = _open(self.path)
        files.create_dir(folder, recursive=True)
        name, at, offsets, marked = f"part-{uuid.uuid4().hex}.warc.gz", 0, [], -SPLIT
        with files.open_output_stream(f"{folder}/{name}", compression=None) as out:
            for batch in iterator:
                for lo in range(0, batch.num_rows, ROWS):
                    for row in batch.slice(lo, ROWS).to_pylist():
                        member = gzip_member(self.record(row))
                        if at - marked >= SPLIT:
                            offsets.append(at)
                            marked = at
                        out.write(member)
                        at += len(member)
        return _Written(name, at, offsets)

    def record(self, row: dict) -> bytes:
        revisit = row["record_type"] == "revisit"
        fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", self.date)]
        if row["target_uri"] is not None:
            fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["target_uri"])))
        fields += [("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"), (LENGTH_FIELD, str(row["payload_length"])),
                   ("Content-Type", "application/http; msgtype=response")]
        if revisit:
            fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", row["refers_to"])]
        payload = b"" if revisit else row["payload"] or b""
        block = HTTP_HEAD.format(row["payload_length"]).encode() + payload
        return record_bytes([(k, v) for k, v in fields if v is not None], block)

    def commit(self, messages) -> None:
        files, folder = _open(self.path)
        files.create_dir(folder, recursive=True)
        listed = [{"name": m.name, "size": m.size, "offsets": m.offsets} for m in messages if m is not None]
        with files.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps(listed).encode())

    def abort(self, messages) -> None:
        files, folder = _open(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{folder}/{m.name}")


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.names = options["path"], schema.names
        self.verify = options.get("verify", "false") == "true"
        #: header name in small letters -> test on its value
        self.tests: list[tuple[str, str, object]] = []
        if options.get("record_types"):
            self.tests.append(("warc-type", "in", options["record_types"].split(",")))
        for k, v in json.loads(options.get("headers") or "{}").items():
            self.tests.append((k.lower(), "prefix", v))

    def partitions(self) -> list[InputPartition]:
        files, folder = _open(self.path)
        with files.open_input_stream(f"{folder}/{MANIFEST}") as f:
            listed = json.loads(f.read())
        return [InputPartition((x["name"], a, b)) for x in listed
                for a, b in zip(x["offsets"], [*x["offsets"][1:], x["size"]])] or [InputPartition(("", 0, 0))]

    def wanted(self, fields: dict[str, str]) -> bool:
        for header, kind, value in self.tests:
            have = fields.get(header)
            if have is not None and header == "warc-payload-digest":
                have = have.removeprefix("sha1:")
            if have is None or not (have in value if kind == "in" else have.startswith(value)):
                return False
        return True

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        name, start, end = partition.value
        schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n == "payload_length" else pa.string())
                            for n in self.names])
        if not name:
            return
        files, folder = _open(self.path)
        rows, held = [], 0
        with files.open_input_file(f"{folder}/{name}") as stream:
            for head, rest in members(stream, start, end):
                raw = None
                if (parsed := parse_headers(head)) is None:
                    raw = rest()
                    parsed = parse_headers(raw)
                fields, block_at = parsed
                if not self.wanted(fields):
                    continue
                row = {n: fields.get(HEADERS[n].lower()) for n in self.names if n in HEADERS}
                if row.get("payload_digest"):
                    row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
                row["payload_length"] = int(fields[LENGTH_FIELD.lower()]) if LENGTH_FIELD.lower() in fields else None
                if "payload" in self.names and fields.get("warc-type") != "revisit":
                    raw = rest() if raw is None else raw
                    block = raw[block_at:block_at + int(fields["content-length"])]
                    payload = row["payload"] = block[block.find(b"\r\n\r\n") + 4:]
                    if self.verify and f"sha1:{base32_sha1(payload)}" != fields.get("warc-payload-digest"):
                        raise ValueError(f"digest of {fields.get('warc-record-id')} does not fit its payload")
                    held += len(payload)
                rows.append(row)
                if len(rows) >= ROWS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class _FilteredReader(_Reader):
    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            header = HEADERS.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if header and isinstance(f, EqualTo):
                self.tests.append((header.lower(), "in", [f.value]))
            elif header and isinstance(f, In):
                self.tests.append((header.lower(), "in", list(f.value)))
            elif header and isinstance(f, StringStartsWith):
                self.tests.append((header.lower(), "prefix", f.value))
            else:
                yield f


# --- DataFrame functions ------------------------------------------------------

def plan_revisits(pages: DataFrame, *, key="page_id", uri="url", payload="html", least_bytes: int = 0) -> DataFrame:
    """Rows for ``write``.  Payloads move once, in the join with the payloads that
    occur more than once; a payload with very many copies is a skewed key of a
    plain join, which adaptive execution splits."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("_id"), F.col(uri).alias("target_uri"), data.alias("payload"),
                        F.unhex(F.sha1(data)).alias("_digest"))
    again = (rows.where(F.octet_length("payload") >= least_bytes).groupBy("_digest")
             .agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    joined = rows.join(again, "_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.col(c).cast("string"), F.lit(">"))
    return joined.select(
        name("_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.when(revisit, name("_first")).alias("refers_to"),
        _base32(F.col("_digest")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def _base32(digest):
    """Base32 of 20 bytes: each 5 bytes are 8 digits."""
    out = []
    for i in range(4):
        part = F.conv(F.substring(F.hex(digest), 10 * i + 1, 10), 16, 32)
        out.append(F.translate(F.lpad(part, 8, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    return F.concat(*out)


def write(records: DataFrame, path: str) -> None:
    records.sparkSession.dataSource.register(WarcSource)
    records.write.format(WarcSource.name()).mode("append").save(path)


def read(spark: SparkSession, path: str, *, record_types: list[str] | None = None,
         headers: dict[str, str] | None = None, columns: list[str] | None = None, verify: bool = False) -> DataFrame:
    """The records, of the given types and whose headers begin with the given
    values; without ``payload`` among ``columns`` no payload is decompressed."""
    spark.dataSource.register(WarcSource)
    pushdown = (spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") or "false").lower()
    source = spark.read.format(WarcSource.name()).option("pushdown", pushdown).option("verify", str(verify).lower())
    if record_types:
        source = source.option("record_types", ",".join(record_types))
    if headers:
        source = source.option("headers", json.dumps(headers))
    if columns:
        kinds = dict(x.strip().split(" ") for x in SCHEMA.split(","))
        source = source.schema(", ".join(f"{c} {kinds[c]}" for c in columns))
    return source.load(path)
