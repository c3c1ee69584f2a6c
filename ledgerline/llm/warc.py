"""WARC archives as a Spark data source, for reading and writing.

``spark.read.format("warc").load(folder)`` plans one partition per file, or per group of small files. A record's
headers are parsed first; the predicates that Spark pushes down (record type, address, ids, sizes, digest) are tested on
them, and a record that fails one, or whose payload is not asked for, is passed over without decoding: its gzip
member is skipped by the length that the member itself states, or else inflated and thrown away.

``df.write.format("warc").mode("append").save(folder)`` writes one archive per task, each record a gzip member of its own.
A task that runs twice writes two files; only those that the commit lists in a manifest are read.

Nulls and odd rows: a null payload is written as empty; a null address or date leaves its header out and is read as null;
rows with an unknown record type are refused; equal rows give equal records; an empty table gives a folder with an
empty manifest, which reads as no rows; line breaks in header values are percent-encoded. Columns other than those of
``WRITE_SCHEMA`` are not taken.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

READ_SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_bytes bigint, content_type string, headers map<string,string>, payload binary, "
    "file string, position bigint"
)
#: What ``write`` takes: digest as lower-case hex of the whole payload, bytes of the whole payload.
WRITE_SCHEMA = "record_id string, record_type string, target_uri string, warc_date string, refers_to string, payload_digest string, payload_bytes bigint, content_type string, payload binary"
RECORD_TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
#: Fixed value: the profile of a revisit whose payload equals that of an earlier record.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest-"
_CHUNK = 1 << 16


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


# --- one record ---------------------------------------------------------------------------------------------


def _header_value(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def encode_record(row: dict) -> bytes:
    """A record as it stands in an uncompressed archive."""
    kind = row["record_type"]
    if kind not in RECORD_TYPES:
        raise ValueError(f"unknown record type: {kind!r}")
    payload = row["payload"] or b""
    http = kind in ("response", "revisit")
    if http:
        size = len(payload) if row["payload_bytes"] is None else row["payload_bytes"]
        lines = ["HTTP/1.1 200 OK", f"Content-Type: {_header_value(row['content_type'] or 'text/html')}", f"Content-Length: {size}"]
        block = ("\r\n".join(lines) + "\r\n\r\n").encode() + (b"" if kind == "revisit" else payload)
    else:
        block = payload
    digest = row["payload_digest"]
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["warc_date"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Payload-Digest", digest and "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Profile", REVISIT_PROFILE if kind == "revisit" else None),
        ("Content-Type", "application/http; msgtype=response" if http else row["content_type"]),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {_header_value(value)}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """``data`` as one gzip member whose extra field "sl" states the lengths of the member and of the data."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_headers(block: bytes) -> dict[str, str]:
    """Header lines after the first one, names in lower case; a line that begins with a blank goes on."""
    out: dict[str, str] = {}
    name = ""
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _digest_hex(value: str | None) -> str | None:
    """A SHA-1 digest header as lower-case hex; other kinds as they are."""
    if not value or not value.lower().startswith("sha1:"):
        return value
    text = value[5:]
    if len(text) == 40:
        return text.lower()
    return base64.b32decode(text.upper()).hex() if len(text) == 32 else value


# --- streams of records -----------------------------------------------------------------------------------------


class _Plain:
    """The bytes of one record of an uncompressed archive."""

    def __init__(self, source, position: int, ahead: bytes):
        self.source, self.position, self.ahead = source, position, ahead

    def read(self, n: int) -> bytes:
        out, self.ahead = self.ahead[:n], self.ahead[n:]
        return out if len(out) == n else out + self.source.read(n - len(out))


class _Member:
    """The bytes of one gzip member, inflated only as far as they are read."""

    def __init__(self, source, ahead: bytes):
        self.source, self.inflate, self.raw, self.ready = source, zlib.decompressobj(31), ahead, b""

    def read(self, n: int) -> bytes:
        while len(self.ready) < n and not self.inflate.eof:
            self.raw = self.raw or self.source.read(_CHUNK)
            if not self.raw:
                raise EOFError("an archive ends inside a record")
            self.ready += self.inflate.decompress(self.raw, max(_CHUNK, n - len(self.ready)))
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        out, self.ready = self.ready[:n], self.ready[n:]
        return out

    def finish(self) -> bytes:
        """Inflate what is left, and give back what was read beyond the member."""
        while not self.inflate.eof:
            self.ready = b""
            self.read(_CHUNK)
        return self.raw


def _read_head(stream) -> tuple[bytes, bytes]:
    """Bytes up to the empty line that ends the headers, and what was read beyond."""
    data = b""
    while (end := data.find(b"\r\n\r\n")) < 0:
        more = stream.read(4096)
        if not more:
            return data, b""
        data += more
    return data[: end + 2], data[end + 4 :]


@dataclass
class Record:
    position: int
    headers: dict[str, str]
    #: First bytes of the block (all of it, if it was asked for).
    block: bytes


def _gzip_records(source, wanted, payload) -> Iterator[Record]:
    ahead = b""
    while True:
        position = source.tell() - len(ahead)
        ahead += source.read(32 - len(ahead)) if len(ahead) < 32 else b""
        if len(ahead) < 18:
            return
        length = None
        if ahead[3] & 4 and ahead[12:14] == b"sl" and len(ahead) >= 24:
            length = struct.unpack("<I", ahead[16:20])[0] or None
        member = _Member(source, ahead)
        head, rest = _read_head(member)
        headers = parse_headers(head)
        if wanted(headers):
            # Only a payload that is asked for is inflated; else the first bytes, which hold the inner headers.
            size = int(headers.get("content-length", 0))
            need = max(0, (size if payload else min(size, 2048)) - len(rest))
            yield Record(position, headers, (rest + member.read(need))[:size])
        if length:
            ahead = b""
            source.seek(position + length)
        else:
            ahead = member.finish()


def _plain_records(source, wanted, payload) -> Iterator[Record]:
    position = 0
    while True:
        source.seek(position)
        head, rest = _read_head(stream := _Plain(source, position, b""))
        if not head.strip():
            return
        headers = parse_headers(head)
        size = int(headers.get("content-length", 0))
        if wanted(headers):
            need = max(0, (size if payload else min(size, 2048)) - len(rest))
            yield Record(position, headers, (rest + stream.read(need))[:size])
        position += len(head) + 2 + size + 4


def records(source, wanted=lambda headers: True, payload: bool = True) -> Iterator[Record]:
    """The records of an open archive whose headers are wanted."""
    magic = source.read(2)
    source.seek(0)
    return (_gzip_records if magic == b"\x1f\x8b" else _plain_records)(source, wanted, payload)


def row_of(record: Record, file: str, payload: bool) -> dict:
    """A record as a row of ``READ_SCHEMA``."""
    h = record.headers
    kind, block = h.get("warc-type"), record.block
    size: int | None = int(h.get("content-length", 0))
    content = h.get("content-type")
    body = block
    if kind in ("response", "revisit") and "application/http" in (content or ""):
        inner, _, body = block.partition(b"\r\n\r\n")
        http = parse_headers(inner + b"\r\n")
        content = http.get("content-type")
        stated = http.get("content-length", "")
        size = int(stated) if stated.isdigit() else size - len(inner) - 4
    keep = payload and kind != "revisit"
    return {
        "record_id": h.get("warc-record-id"),
        "record_type": kind,
        "target_uri": h.get("warc-target-uri"),
        "warc_date": h.get("warc-date"),
        "refers_to": h.get("warc-refers-to"),
        "payload_digest": _digest_hex(h.get("warc-payload-digest")),
        "payload_bytes": size,
        "content_type": content,
        "headers": list(h.items()),
        "payload": body if keep else None,
        "file": file,
        "position": record.position,
    }


# --- the data source ---------------------------------------------------------------------------------------------

#: Columns whose value the record headers alone decide, and the header that holds each.
_HEADER_OF = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
_TESTS = {
    EqualTo: lambda v, f: v is not None and v == f.value,
    EqualNullSafe: lambda v, f: v == f.value,
    In: lambda v, f: v is not None and v in f.value,
    IsNull: lambda v, f: v is None,
    IsNotNull: lambda v, f: v is not None,
    GreaterThan: lambda v, f: v is not None and v > f.value,
    GreaterThanOrEqual: lambda v, f: v is not None and v >= f.value,
    LessThan: lambda v, f: v is not None and v < f.value,
    LessThanOrEqual: lambda v, f: v is not None and v <= f.value,
    StringStartsWith: lambda v, f: v is not None and v.startswith(f.value),
    StringEndsWith: lambda v, f: v is not None and v.endswith(f.value),
    StringContains: lambda v, f: v is not None and f.value in v,
}


def header_test(filters: list[Filter]):
    """Whether the headers of a record pass all pushed predicates."""

    def wanted(headers: dict[str, str]) -> bool:
        for f in filters:
            value = headers.get(_HEADER_OF[f.attribute[0]])
            if f.attribute[0] == "payload_digest":
                value = _digest_hex(value)
            if not _TESTS[type(f)](value, f):
                return False
        return True

    return wanted


@dataclass
class Archives(InputPartition):
    files: list[str]


class WarcReader(DataSourceReader):
    """Options: ``payload`` (default true) reads payloads; ``groupBytes`` is how many bytes of small files make a partition."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.group_bytes = int(options.get("groupbytes", options.get("groupBytes", 64 << 20)))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in _HEADER_OF:
                self.filters.append(f)
            else:
                yield f

    def _files(self) -> list[tuple[str, int]]:
        fs, path = _file_system(self.path)
        listed = fs.get_file_info(pafs.FileSelector(path, recursive=False)) if fs.get_file_info(path).type == pafs.FileType.Directory else [fs.get_file_info(path)]
        sizes = {i.base_name: i.size for i in listed if i.type == pafs.FileType.File}
        manifests = [n for n in sizes if n.startswith(MANIFEST)]
        if manifests:
            names = []
            for name in manifests:
                with fs.open_input_stream(f"{path}/{name}") as stream:
                    names += json.loads(stream.read())
        else:
            names = [n for n in sizes if n.endswith((".warc", ".warc.gz"))]
        base = path if len(listed) != 1 or listed[0].path != path else path.rpartition("/")[0]
        return sorted((f"{base}/{n}", sizes[n]) for n in names)

    def partitions(self) -> list[InputPartition]:
        groups: list[list[str]] = []
        room = 0
        for name, size in self._files():
            if not groups or size > room:
                groups.append([])
                room = self.group_bytes
            groups[-1].append(name)
            room -= size
        return [Archives(g) for g in groups] or [Archives([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = _file_system(self.path)
        wanted = header_test(self.filters)
        rows: list[dict] = []
        held = 0
        for file in partition.files:
            with fs.open_input_file(file) as source:
                for record in records(source, wanted, self.payload):
                    rows.append(row_of(record, file, self.payload))
                    held += len(record.block)
                    if held > (4 << 20) or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_SCHEMA)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_SCHEMA)


_ARROW_SCHEMA = pa.schema(
    [
        *[(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "warc_date", "refers_to", "payload_digest")],
        ("payload_bytes", pa.int64()),
        ("content_type", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
        ("file", pa.string()),
        ("position", pa.int64()),
    ]
)


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.level = int(options.get("level", 6))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, path = _file_system(self.path)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        stream = None
        for batch in iterator:
            for at in range(0, batch.num_rows, 64):
                if stream is None:
                    fs.create_dir(path, recursive=True)
                    stream = fs.open_output_stream(f"{path}/{name}", compression=None)
                for row in batch.slice(at, 64).to_pylist():
                    stream.write(gzip_member(encode_record(row), self.level))
        if stream is None:
            return Written(None)
        stream.close()
        return Written(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """The only driver step: the names of the files that count, one per task."""
        fs, path = _file_system(self.path)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{MANIFEST}{uuid.uuid4().hex}.json") as stream:
            stream.write(json.dumps([m.name for m in messages if m is not None and m.name]).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, path = _file_system(self.path)
        for m in messages:
            if m is not None and m.name:
                fs.delete_file(f"{path}/{m.name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let its readers see predicates."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_warc(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records below a folder, lazily; filters on header columns reach the parser."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


def write_warc(rows: DataFrame, folder: str) -> None:
    """Write rows that have the columns of ``WRITE_SCHEMA`` as archives below a folder."""
    register(rows.sparkSession)
    names = [part.split()[0] for part in WRITE_SCHEMA.split(", ")]
    rows.select(*names).write.format("warc").mode("append").save(folder)


# --- pages -----------------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, key: str, payload: str, least_bytes: int = 1000) -> DataFrame:
    """Payload, digest, size and record type of every row, and the key that a revisit refers to.

    Of equal payloads of at least ``least_bytes`` bytes the row with the largest key is the response; rows that
    share that key are all responses. The groups are found on digests; payloads move once, by key, so a payload
    that a third of the rows share does not meet in one task.
    """
    content = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.lit(b""))
    rows = pages.withColumn("payload", content).withColumns(
        {"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("bigint")}
    )
    marks = rows.filter(F.col("payload_bytes") >= least_bytes).select(F.col(key).alias("__k"), F.col("payload_digest").alias("__d"))
    newest = marks.groupBy("__d").agg(F.max("__k").alias("__newest"), F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    later = marks.join(newest.select(F.col("__d").alias("__d2"), "__newest"), F.col("__d") == F.col("__d2"))
    later = later.filter(~F.col("__k").eqNullSafe(F.col("__newest"))).select("__k", "__d", "__newest").distinct()
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("payload_digest") == F.col("__d"))
    found = rows.join(later, same, "left")
    kind = F.when(F.col("__d").isNull(), "response").otherwise("revisit")
    return found.withColumns({"record_type": kind, "refers_to_key": F.col("__newest")}).drop("__k", "__d", "__newest")


def page_records(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows of ``WRITE_SCHEMA`` for a table of pages; a record id is ``<urn:page:KEY>``."""
    rows = with_revisits(pages.select(key, url, html), key, html)

    def identity(c: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    return rows.select(
        identity(key).alias("record_id"),
        "record_type",
        F.col(url).alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.when(F.col("record_type") == "revisit", identity("refers_to_key")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"),
    )


def page_key(column: str):
    """The key in a record id of ``page_records``."""
    return F.expr(f"try_cast(substring({column}, 11, length({column}) - 11) AS bigint)")
