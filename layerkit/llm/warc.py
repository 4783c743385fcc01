"""WARC archives as a Python data source: ``format("warc")``.

Reading plans partitions of whole records: ranges of files at the record
borders that the writer has noted, whole files where nothing is noted, small
ones together. Of every record the header is parsed first. Predicates on
header columns (record type, ids, address, date, content type, digest) are
pushed down and decide there; the payload of a record that fails them, or of
any record where no payload is asked for, is not decoded: the reader goes on
to the next record by the lengths that stand in the headers. Archives are
plain (``.warc``) or one gzip member per record (``.warc.gz``); the writer
puts each member's length into its header, in the extra field ``sl``, so
members are skipped unread. Members without it are inflated and dropped.

Writing gives every task its own files. Their names go to the driver, which
lists them in a manifest at the end; readers follow the manifests, so what a
lost or repeated attempt left behind is never read.

``write_archives`` writes a page per record, equal payloads once: the page of
the largest id holds the payload (``response``), the others refer to it
(``revisit``).

Defined cases: a NULL payload is empty; a NULL address leaves the header out
and is read as NULL; control characters and spaces in ids and addresses are
percent-encoded; a NULL id is smaller than any other and read as NULL; rows
that repeat the largest id and its payload are all responses; an empty table
gives a manifest without files, which is read as no rows; a folder without
manifests is read whole, ``*.warc`` and ``*.warc.gz``; other columns are not
looked at, whatever their names. A record that does not begin as one, is cut
off, or (with ``verify``) has another digest than it states, raises.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import col, counted_join, stage

# The format's own words.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page"
HTTP_TYPES = ("response", "revisit", "request")

FILE_BYTES = 1 << 28
SPLIT_BYTES = 1 << 25
BUFFER = 1 << 20
BATCH_BYTES = 1 << 22
BATCH_ROWS = 2_000
MANIFEST = "_manifest-"

# The columns of a record. Those of the first list stand in its header.
HEADER_COLUMNS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "profile": "WARC-Profile",
    "refers_to_id": "WARC-Refers-To",
}
SCHEMA = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in HEADER_COLUMNS],
        T.StructField("page_id", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)
PUSHED = {*HEADER_COLUMNS, "page_id", "refers_to"}


def _page_urn(page_id: str | None) -> str:
    return f"<{PAGE_URN}>" if page_id is None else f"<{PAGE_URN}:{quote(page_id, safe='')}>"


def _page_of(record_id: str | None) -> str | None:
    inner = (record_id or "").strip("<>")
    return unquote(inner[len(PAGE_URN) + 1 :]) if inner.startswith(PAGE_URN + ":") else None


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def base32_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


# --- one record


def encode_record(row: dict, date: str) -> bytes:
    """The bytes of a record from ``record_type, record_id, target_uri,
    payload, payload_bytes, payload_digest`` and, for a revisit, ``refers_to_id``."""
    revisit, payload = row["record_type"] == "revisit", row["payload"] or b""
    size = row["payload_bytes"] if revisit else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [VERSION, f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {date}"]
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {_one_line(row['target_uri'])}")
    head.append(f"WARC-Payload-Digest: sha1:{row['payload_digest']}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {row['refers_to_id']}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """One gzip member that states its own length (extra field ``sl``)."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    head, tail = 10 + 2 + 12, struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    length = head + len(body) + len(tail)
    if length >> 32:
        return zlib.compress(data, level, 31)
    extra = b"sl" + struct.pack("<HII", 8, length, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def parse_headers(head: bytes) -> dict[str, str]:
    """Header lines by their names as written, continued lines joined."""
    out, last = {}, None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            out[last] = value.strip()
    return out


# --- a file of records


class _Window:
    """A file read forwards through one buffer; skipping what was not read yet
    moves the place only."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.at, self.data = 0, b""

    def take(self, start: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``start``: fewer at the file's end only."""
        if start < self.at or start + n > self.at + len(self.data):
            held = self.data[start - self.at :] if self.at <= start <= self.at + len(self.data) else b""
            self.file.seek(start + len(held))
            self.at, self.data = start, held + self.file.read(max(n - len(held), BUFFER))
        return self.data[start - self.at : start - self.at + n]


class _Plain:
    """A record in a plain archive, at ``start``."""

    def __init__(self, window: _Window, start: int):
        self.window, self.start = window, start

    def read(self, at: int, n: int) -> bytes:
        return self.window.take(self.start + at, n)

    def end(self, length: int) -> int:
        return self.start + length


class _Member:
    """A record in a gzip member at ``start``, inflated only as far as read."""

    def __init__(self, window: _Window, start: int):
        self.window, self.start, self.fed = window, start, start
        self.z, self.out = zlib.decompressobj(31), bytearray()
        head = window.take(start, 24)
        if head[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at byte {start}")
        stated = head[3] & 4 and len(head) == 24 and head[12:14] == b"sl"
        self.length = struct.unpack_from("<I", head, 16)[0] if stated else None

    def _inflate(self, upto: int) -> None:
        while len(self.out) < upto and not self.z.eof:
            piece = self.z.unconsumed_tail or self._feed()
            self.out += self.z.decompress(piece, max(upto - len(self.out), 1 << 12))

    def _feed(self) -> bytes:
        # no more than the member, where its length is known
        n = 1 << 14 if self.length is None else min(1 << 14, self.start + self.length - self.fed)
        piece = self.window.take(self.fed, n)
        if not piece:
            raise ValueError(f"the gzip member at byte {self.start} is cut off")
        self.fed += len(piece)
        return piece

    def read(self, at: int, n: int) -> bytes:
        self._inflate(at + n)
        return bytes(self.out[at : at + n])

    def end(self, length: int) -> int:
        if self.length is not None:
            return self.start + self.length
        while not self.z.eof:  # the rest is inflated and dropped
            piece = self.z.unconsumed_tail or self._feed()
            self.z.decompress(piece, 1 << 16)
        return self.fed - len(self.z.unused_data)


def _through(record, begin: int, mark: bytes = b"\r\n\r\n", most: int = 1 << 20) -> bytes:
    """What stands from ``begin`` to the end of the first ``mark``."""
    n = 512
    while True:
        data = record.read(begin, n)
        cut = data.find(mark)
        if cut >= 0:
            return data[: cut + len(mark)]
        if len(data) < n or n > most:
            raise ValueError("a header does not end")
        n *= 2


def records(window: _Window, start: int, end: int, gzipped: bool) -> Iterator[tuple[dict[str, str], Callable]]:
    """The headers of every record that begins in ``[start, end)``, and a
    function that reads from its block: ``block(at, n)``; ``n`` None: all."""
    while start < min(end, window.size):
        record = _Member(window, start) if gzipped else _Plain(window, start)
        head = _through(record, 0)
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {start}")
        headers = parse_headers(head[:-4])
        low = {k.lower(): v for k, v in headers.items()}
        size = int(low["content-length"])

        def block(at: int, n: int | None, record=record, head=head, size=size) -> bytes:
            n = size - at if n is None else min(n, size - at)
            data = record.read(len(head) + at, n)
            if len(data) < n:
                raise ValueError("a record is cut off")
            return data

        block.size = size
        yield headers, block
        start = record.end(len(head) + size + 4)


def _row(headers: dict[str, str]) -> dict:
    low = {k.lower(): v for k, v in headers.items()}
    row = {c: low.get(h.lower()) for c, h in HEADER_COLUMNS.items()}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    return row | {"page_id": _page_of(row["record_id"]), "refers_to": _page_of(row["refers_to_id"]), "headers": headers}


def _open_payload(row: dict, block: Callable) -> int:
    """Sets ``payload_bytes``; returns where the payload begins in the block."""
    if row["record_type"] not in HTTP_TYPES or "application/http" not in (row["content_type"] or ""):
        row["payload_bytes"] = block.size
        return 0
    if not block.size:
        row["payload_bytes"] = 0
        return 0

    class Block:
        read = staticmethod(block)

    head = _through(Block, 0)
    row["payload_bytes"] = block.size - len(head)
    if row["record_type"] == "revisit":  # the payload is elsewhere, its length is stated here
        stated = {k.lower(): v for k, v in parse_headers(head[:-4]).items()}.get("content-length")
        row["payload_bytes"] = int(stated) if stated else None
    return len(head)


# --- predicates on header columns


def _predicate(f: ds.Filter) -> tuple[str, Callable] | None:
    """(column, test of its value) of a filter that headers can decide. A
    comparison with NULL is not true, as in SQL."""
    if isinstance(f, ds.Not):
        inner = _predicate(f.child)
        if inner is None or isinstance(f.child, (ds.Not, ds.EqualNullSafe, ds.IsNull, ds.IsNotNull)):
            return None
        name, test = inner
        return name, lambda v: v is not None and not test(v)
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in PUSHED:
        return None
    value = getattr(f, "value", None)
    tests = {
        ds.EqualTo: lambda v: v is not None and v == value,
        ds.EqualNullSafe: lambda v: v == value,
        ds.GreaterThan: lambda v: v is not None and v.encode() > value.encode(),
        ds.GreaterThanOrEqual: lambda v: v is not None and v.encode() >= value.encode(),
        ds.LessThan: lambda v: v is not None and v.encode() < value.encode(),
        ds.LessThanOrEqual: lambda v: v is not None and v.encode() <= value.encode(),
        ds.In: lambda v: v is not None and v in value,
        ds.IsNull: lambda v: v is None,
        ds.IsNotNull: lambda v: v is not None,
        ds.StringStartsWith: lambda v: v is not None and v.startswith(value),
        ds.StringEndsWith: lambda v: v is not None and v.endswith(value),
        ds.StringContains: lambda v: v is not None and value in v,
    }
    test = tests.get(type(f))
    # a list that itself holds NULL is left to Spark, where it may decide NOT IN
    if test is None or (isinstance(f, ds.In) and None in value):
        return None
    return f.attribute[0], test


# --- the data source


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@dataclass
class Ranges(ds.InputPartition):
    """What one task reads: ranges of files at record borders."""

    held: list[tuple[str, int, int]] = field(default_factory=list)


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.path, self.names = options["path"], schema.names
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", SPLIT_BYTES))
        self.tests: list[tuple[str, Callable]] = []
        self.arrow = pa.schema([(f.name, _ARROW[f.name]) for f in schema.fields])

    def partitions(self) -> list[Ranges]:
        fs, root = _filesystem(self.path)
        out, held = [], 0
        for name, start, end in _planned(fs, root):
            if not out or (held and held + end - start > self.partition_bytes):
                out.append(Ranges([]))
                held = 0
            out[-1].held.append((name, start, end))
            held += end - start
        return out or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        wants_size = "payload_bytes" in self.names or self.verify
        rows, held = [], 0
        for name, start, end in partition.held:
            with fs.open_input_file(name) as file:
                for headers, block in records(_Window(file), start, end, name.endswith(".gz")):
                    row = _row(headers)
                    if not all(test(row[c]) for c, test in self.tests):
                        continue
                    begin = _open_payload(row, block) if wants_size or "payload" in self.names else 0
                    row["payload"] = None
                    if row["record_type"] != "revisit" and ("payload" in self.names or self.verify):
                        row["payload"] = block(begin, None)
                        self._checked(row, name)
                    if "payload" not in self.names:
                        row["payload"] = None
                    rows.append([row[c] for c in self.names])
                    held += len(row["payload"] or b"") + 200
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield self._batch(rows)
                        rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _checked(self, row: dict, name: str) -> None:
        if self.verify and row["payload_digest"]:
            if base32_digest(hashlib.sha1(row["payload"]).digest()) != row["payload_digest"]:
                raise ValueError(f"{name}: the payload of {row['record_id']} has another digest")

    def _batch(self, rows: list[list]) -> pa.RecordBatch:
        cells = [pa.array([r[k] for r in rows], t) for k, t in enumerate(self.arrow.types)]
        return pa.RecordBatch.from_arrays(cells, schema=self.arrow)


class PushingReader(WarcReader):
    """A reader that takes over Spark's filters on header columns."""

    def pushFilters(self, filters: list[ds.Filter]):
        for f in filters:
            test = _predicate(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)


_ARROW = {f.name: pa.string() for f in SCHEMA.fields} | {
    "payload_bytes": pa.int64(),
    "payload": pa.binary(),
    "headers": pa.map_(pa.string(), pa.string()),
}


def _planned(fs: pafs.FileSystem, root: str) -> Iterator[tuple[str, int, int]]:
    """Ranges of the files that the manifests list; without manifests, all
    archives of the folder (or the one file), whole."""
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        yield root, 0, info.size
        return
    found = sorted(fs.get_file_info(pafs.FileSelector(root, recursive=True)), key=lambda x: x.path)
    manifests = [x.path for x in found if x.base_name.startswith(MANIFEST)]
    if not manifests:
        for x in found:
            if x.path.endswith((".warc", ".warc.gz")):
                yield x.path, 0, x.size
        return
    for m in manifests:
        with fs.open_input_stream(m) as file:
            for line in file.read().decode().splitlines():
                listed = json.loads(line)
                borders = [*listed["borders"], listed["bytes"]]
                for a, b in zip(borders, borders[1:]):
                    yield f"{root}/{listed['name']}", a, b


@dataclass
class Written(ds.WriterCommitMessage):
    """The files of one task, for the manifest."""

    files: list[dict]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.gzipped = options.get("compression", "gzip").lower() == "gzip"
        self.date = options.get("date") or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        missing = {"record_type", "record_id", "target_uri", "payload", "payload_digest"} - set(schema.names)
        if missing:
            raise ValueError(f"a record needs the columns {sorted(missing)}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        files, out, now = [], None, None
        try:
            for rb in iterator:
                for row in rb.to_pylist():
                    if out is None:
                        now = {"name": f"{uuid.uuid4().hex}.warc" + ".gz" * self.gzipped, "bytes": 0, "borders": [0]}
                        out = fs.open_output_stream(f"{root}/{now['name']}", compression=None)
                    data = encode_record(row, self.date)
                    data = gzip_member(data) if self.gzipped else data
                    if now["bytes"] - now["borders"][-1] >= SPLIT_BYTES:
                        now["borders"].append(now["bytes"])
                    out.write(data)
                    now["bytes"] += len(data)
                    if now["bytes"] >= FILE_BYTES:
                        out.close()
                        out = files.append(now)
        finally:
            if out is not None:
                out.close()
                files.append(now)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        old = [x.path for x in fs.get_file_info(pafs.FileSelector(root)) if x.base_name.startswith(MANIFEST)]
        lines = [json.dumps(x) + "\n" for m in messages if m for x in m.files]
        with fs.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.jsonl") as out:
            out.write("".join(lines).encode())
        for path in old if self.overwrite else []:
            fs.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        """What was written stays unlisted, so nothing reads it."""


class WarcSource(ds.DataSource):
    """``spark.read.format("warc")``; options ``verify`` (payloads are held
    against their digests), ``partitionBytes``, and ``pushdown``: the reader
    takes over Spark's filters on header columns. Spark 4.1 keeps the filters
    that were pushed last for all uses of one loaded frame, so a frame loaded
    with ``pushdown`` is for one filter; ``read_archives`` sees to that.
    ``df.write.format("warc")``;
    options ``compression`` (``gzip`` or ``none``), ``date``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        unknown = set(schema.names) - set(SCHEMA.names)
        if unknown:
            raise ValueError(f"a record has no columns {sorted(unknown)}")
        pushing = self.options.get("pushdown", "false").lower() == "true"
        return PushingReader(schema, self.options) if pushing else WarcReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session, with filters pushed down."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archives(
    spark: SparkSession, path: str, condition: Column | None = None, payload: bool = True, verify: bool = False
) -> DataFrame:
    """The records under ``path`` that meet ``condition``.

    What the condition asks of header columns is decided on the headers, and
    payloads of other records are not decoded. Without ``payload`` there is no
    such column and no payload is decoded at all, unless ``verify`` holds
    those of the records asked for against their digests.
    """
    register(spark)
    fields = [f for f in SCHEMA.fields if payload or f.name != "payload"]
    reader = spark.read.format("warc").schema(T.StructType(fields)).option("verify", str(verify).lower())
    if condition is None:
        return reader.load(path)
    # Filters of the caller's stay above the count, so every use of the frame
    # pushes the same ones
    found = reader.option("pushdown", "true").load(path).where(condition)
    return found.observe(f"warc_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("records"))


def page_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0
) -> DataFrame:
    """A record per page, equal payloads of ``min_bytes`` or more once."""
    body = F.coalesce(col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        col(page_id).alias("id"),
        col(url).cast("string").alias("target_uri"),
        body.alias("payload"),
        F.sha1(body).alias("sha1"),
        F.monotonically_increasing_id().alias("salt"),
    )
    once = rows.where(F.length("payload") >= min_bytes).groupBy("sha1").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    once = stage(once, "warc-digests")
    total = once.agg(F.sum("n")).first()[0] or 0
    met = counted_join(rows, once.where("n > 1"), ["sha1"], "n", total, F.col("salt"))
    revisit = F.col("n").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    urn = F.udf(_page_urn, "string", useArrow=True)
    base32 = F.udf(lambda sha1: base32_digest(bytes.fromhex(sha1)), "string", useArrow=True)
    return met.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("id").cast("string")).alias("record_id"),
        "target_uri",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.length("payload").cast("long").alias("payload_bytes"),
        base32("sha1").alias("payload_digest"),
        F.when(revisit, urn(F.col("top").cast("string"))).alias("refers_to_id"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    compression: str = "gzip",
) -> None:
    """Write ``pages`` as archives under ``path``, added to what is there."""
    register(pages.sparkSession)
    found = page_records(pages, page_id, url, payload, min_bytes)
    found.write.format("warc").option("compression", compression).mode("append").save(path)
