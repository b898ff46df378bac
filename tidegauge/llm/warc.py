"""WARC archives as a Spark data source.

Writing: each task writes files of bounded size with names of their own; each write has a manifest, which
lists the files of the tasks that succeeded, so a task that is tried again leaves nothing behind that
readers see. Appending adds a manifest; overwriting takes the place of those before.

Reading: each file is a partition. Filters on record_type, page_id and the other header columns are
pushed down: a record's header is parsed first, and the block of a record that no filter lets through,
or whose payload is not in the schema, is skipped by its length without being read. A single file, or a
folder without manifests, is read as it is: every file that ends in .warc or .warc.gz, whose records may be
gzip members of their own. Other programs' records have no page id, and their payload's length is known
once it is read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidegauge.session import Scratch

FILE_BYTES = 64 << 20  # a file is closed once it is this long
SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary"
)
MANIFEST = "_files-"  # and a number, and .json
ENDINGS = (".warc", ".warc.gz")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text)


def record(page_id, url, payload: bytes, refers_to, date: str, number: int = 0) -> bytes:
    """A response, or a revisit without payload if it refers to another page's response."""
    revisit = refers_to is not None
    own = digest(payload)
    name = lambda page: uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page}:{own}:{number}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name(page_id)}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{own}"),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("WARC-Refers-To", f"<urn:uuid:{name(refers_to)}>" if revisit else None),
        ("X-Page-Id", page_id),
        ("X-Refers-To-Page-Id", refers_to),
        ("X-Payload-Length", len(payload)),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def read_header(stream) -> dict[str, str] | None:
    """Fields of the next record, names in lower case; None at the end of the file."""
    while (line := stream.readline()) in (b"\r\n", b"\n"):
        pass  # some writers leave more empty lines between records
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record where one should start: {line[:40]!r}")
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        key, _, value = line.decode("utf-8", "surrogatepass").partition(":")
        fields[key.strip().lower()] = value.strip()
    return fields


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def header_columns(fields: dict[str, str]) -> dict:
    return {
        "page_id": _number(fields.get("x-page-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "refers_to": _number(fields.get("x-refers-to-page-id")),
        "payload_bytes": _number(fields.get("x-payload-length")),
        "payload_digest": (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
    }


_TESTS = {
    EqualTo: lambda v, w: v is not None and v == w,
    In: lambda v, w: v is not None and v in w,
    GreaterThan: lambda v, w: v is not None and v > w,
    GreaterThanOrEqual: lambda v, w: v is not None and v >= w,
    LessThan: lambda v, w: v is not None and v < w,
    LessThanOrEqual: lambda v, w: v is not None and v <= w,
    IsNotNull: lambda v, w: v is not None,
    IsNull: lambda v, w: v is None,
}


def _listed(system, base: str) -> tuple[list[str], list[str]]:
    """Names of the manifests in a folder, and of its archives, whoever wrote them."""
    infos = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
    names = sorted(i.base_name for i in infos if i.type == fs.FileType.File)
    manifests = [n for n in names if n.startswith(MANIFEST) and n.endswith(".json")]
    return manifests, [n for n in names if n.endswith(ENDINGS)]


def _opened(raw, path: str):
    """The bytes of an archive; gzip members, of which each record may be one, are read as one stream."""
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 18), mode="rb")
    return io.BufferedReader(raw, 1 << 18)


def _payload(block: bytes, kind: str) -> bytes:
    """The block without its HTTP head, if it has one."""
    if not kind.startswith("application/http"):
        return block
    head, gap, body = block.partition(b"\r\n\r\n")
    return body if gap and head.startswith((b"HTTP/", b"GET ", b"POST ", b"HEAD ", b"PUT ")) else block


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.columns, self.path = schema.names, options["path"]
        self.schema = schema
        self.tests: list[tuple[type, str, object]] = []

    def pushFilters(self, filters) -> Iterator:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in _TESTS and name in self.columns and name != "payload":
                self.tests.append((type(f), name, getattr(f, "value", None)))
            else:
                yield f  # Spark applies it

    def partitions(self) -> list[_File]:
        system, base = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(base).type == fs.FileType.File:
            return [_File(self.path)]
        manifests, files = _listed(system, base)
        if manifests:
            files = []
            for name in manifests:
                with system.open_input_stream(f"{base}/{name}") as stream:
                    files += json.loads(stream.read())
        return [_File(f"{self.path.rstrip('/')}/{name}") for name in sorted(files)]

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are no files
            return
        system, path = fs.FileSystem.from_uri(partition.path)
        fields = [f for f in pa.schema(_ARROW) if f.name in self.columns]
        schema = pa.schema([next(f for f in fields if f.name == n) for n in self.columns])
        whole = "payload" in self.columns
        rows, size = [], 0
        with system.open_input_file(path) as raw, _opened(raw, path) as stream:
            while (head := read_header(stream)) is not None:
                row = header_columns(head)
                length = int(head["content-length"])
                wanted = all(_TESTS[kind](row[name], value) for kind, name, value in self.tests)
                # Only what was written here tells the payload's length without the payload.
                needed = whole or ("payload_bytes" in self.columns and row["payload_bytes"] is None)
                if wanted and needed and row["record_type"] != "revisit":
                    row["payload"] = payload = _payload(stream.read(length), head.get("content-type") or "")
                    known = row["payload_digest"]
                    if row["page_id"] is not None and known is not None and known != digest(payload):
                        raise ValueError(f"payload of page {row['page_id']} does not match its digest")
                    row["payload_bytes"] = len(payload)
                    stream.seek(4, 1)
                else:
                    stream.seek(length + 4, 1)
                if wanted:
                    rows.append(row)
                    size += len(row.get("payload") or b"") + 200
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


_ARROW = [
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
]


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of page_id, url, payload, refers_to."""

    def __init__(self, options, overwrite: bool):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.overwrite = overwrite

    def write(self, batches) -> _Written:
        system, base = fs.FileSystem.from_uri(self.path)
        system.create_dir(base, recursive=True)
        names, stream, size = [], None, 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, payload, refers_to in zip(*columns):
                if stream is None:
                    names.append(f"pages-{uuid.uuid4().hex}.warc")
                    stream, size = system.open_output_stream(f"{base}/{names[-1]}"), 0
                data = record(page_id, url, payload or b"", refers_to, self.date)
                stream.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    stream.close()
                    stream = None
        if stream is not None:
            stream.close()
        return _Written(names)

    def commit(self, messages) -> None:
        system, base = fs.FileSystem.from_uri(self.path)
        system.create_dir(base, recursive=True)
        own = {n for m in messages if m for n in m.names}
        before, files = _listed(system, base)
        name = f"{MANIFEST}{uuid.uuid4().hex}.json"
        # Written under a name that readers skip and moved, so that they see a whole list or none.
        with system.open_output_stream(f"{base}/.{name}") as stream:
            stream.write(json.dumps(sorted(own)).encode())
        system.move(f"{base}/.{name}", f"{base}/{name}")
        for old in [*before, *(f for f in files if f not in own)] if self.overwrite else []:
            system.delete_file(f"{base}/{old}")

    def abort(self, messages) -> None:
        system, base = fs.FileSystem.from_uri(self.path)
        for message in messages:
            for name in message.names if message else []:
                system.delete_file(f"{base}/{name}")


class WarcSource(DataSource):
    """``spark.read.format("warc").load(url)``; a schema without payload skips the blocks."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The records under a URL. Leave ``payload`` out of ``columns`` to skip all blocks.

    Turns on the session's filter push-down for Python data sources, which the reader needs.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(WarcSource)
    fields = dict(f.split(" ") for f in SCHEMA.split(", "))
    schema = ", ".join(f"{c} {fields[c]}" for c in columns or fields)
    return spark.read.format("warc").schema(schema).load(path)


def write_warc(
    pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    mode: str = "append",
) -> None:
    """Write a record per row, beside the records under ``path`` or, with ``mode='overwrite'``, in place of
    them. Of equal payloads of this write of ``least`` bytes or more one is a response.

    That is the one of the smallest page id; the others are revisits, which refer to it and hold no
    payload. Smaller payloads are all responses. Null html is an empty payload; a null url is left out
    of the header; a row without an id is a response of its own. Rows that repeat the smallest id are
    all responses. Further columns are not looked at; an empty table gives archives without records.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc-first")
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    # Only digests that occur twice are joined, read from a stored table: a very common payload's rows
    # can then be split over tasks.
    first = rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = scratch.table(first.filter("n > 1").select("digest", "first"), "first")
    joined = rows.join(first, "digest", "left")
    revisit = large & F.col("page_id").isNotNull() & (F.col("first") != F.col("page_id"))
    spark.dataSource.register(WarcSource)
    (
        joined.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"))
        .write.format("warc").mode(mode).option("path", path).save()
    )
