"""WARC archives as a Python data source: writing, and reading with pushed-down filters.

Archives are gzip files with one member per record.  The writer notes each member's
length in the member's header (the format's skip-length field), so a reader that does
not want a record inflates its headers alone and jumps to the next; where the field is
missing it inflates to the member's end but keeps nothing.  A reading task takes whole
files, packed to about equal size; the writer ends a file at a size bound to keep tasks
even.  Files go to names of their own and move into place on commit, so the attempts of
lost tasks leave nothing behind.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull,
    StringStartsWith, WriterCommitMessage,
)

from nightgrid.llm.common import new_path, table

#: A file is closed beyond this size; a reading task takes one file, or small ones up to this sum.
FILE_BYTES, TASK_BYTES = 128 << 20, 8 << 20
#: Payload bytes and records that a reading task holds.
BATCH_BYTES, BATCH_RECORDS = 8 << 20, 2_000
READ_BYTES = 1 << 20

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "payload_length bigint, content_type string, payload binary, digest_ok boolean, file string"
)
HEADER_OF = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type",
}
_ID = "urn:x-record:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _filesystem(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


# --- Writing -------------------------------------------------------------------------


def _member(record: bytes) -> bytes:
    """A gzip member whose header has the lengths of the member and of its content."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = 10 + 2 + 12 + len(body) + 8
    known = size < 1 << 32 and len(record) < 1 << 32
    lengths = (size if known else 0).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")
    extra = b"sl" + (8).to_bytes(2, "little") + lengths
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + len(extra).to_bytes(2, "little") + extra
    tail = zlib.crc32(record).to_bytes(4, "little") + (len(record) & 0xFFFFFFFF).to_bytes(4, "little")
    return head + body + tail


def record_bytes(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _uri(url: str | None) -> str | None:
    """A url fit for a header line: controls and blanks are percent-encoded."""
    return None if url is None else _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)


def _id(value: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if value is None else f"<{_ID}{_uri(value)}>"


def page_record(row: dict, date: str) -> bytes:
    """A response with its payload, or a revisit that refers to one."""
    payload, refers = row["payload"] or b"", row["refers_to"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _id(row["record_id"])),
        ("WARC-Date", date), ("WARC-Target-URI", _uri(row["target_uri"])), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers is not None:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", _id(refers))]
        return record_bytes(fields, block)
    return record_bytes(fields, block + payload)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.date = options["path"].rstrip("/"), options.get("date") or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.limit = int(options.get("fileBytes") or FILE_BYTES)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, store, out, size = [], None, None, 0
        try:
            for batch in iterator:
                # A few rows at a time, so that payloads are not all copied at once.
                for row in (r for k in range(0, len(batch), 64) for r in batch.slice(k, 64).to_pylist()):
                    if out is None:
                        store, root = _filesystem(self.path)
                        store.create_dir(posixpath.join(root, "_unfinished"), recursive=True)
                        files.append(f"pages-{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(posixpath.join(root, "_unfinished", files[-1]), compression=None), 0
                        info = record_bytes(
                            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _id(None)), ("WARC-Date", self.date),
                             ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n",
                        )
                        out.write(_member(info))
                    data = _member(page_record(row, self.date))
                    out.write(data)
                    size += len(data)
                    if size > self.limit:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _filesystem(self.path)
        store.create_dir(root, recursive=True)
        for message in messages:
            for name in message.files if message else []:
                store.move(posixpath.join(root, "_unfinished", name), posixpath.join(root, name))

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _filesystem(self.path)
        for message in messages:
            for name in message.files if message else []:
                store.delete_file(posixpath.join(root, "_unfinished", name))


# --- Reading -------------------------------------------------------------------------


class _Source:
    """A buffered file that can look ahead and skip."""

    def __init__(self, file):
        self.file, self.held, self.at = file, b"", 0
        self.size = file.size()

    def fill(self, n: int) -> bytes:
        """At least ``n`` bytes ahead, fewer only at the end of the file."""
        if len(self.held) < n:
            more = self.file.read_at(min(max(READ_BYTES, n - len(self.held)), self.size - self.at - len(self.held)), self.at + len(self.held))
            self.held += more
        return self.held

    def skip(self, n: int) -> None:
        self.held, self.at = self.held[n:] if n < len(self.held) else b"", self.at + n


def _parse(head: bytes) -> tuple[str, dict[str, str]]:
    lines = re.sub(r"\r?\n[ \t]+", " ", head.decode("utf-8", "replace")).splitlines()
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return lines[0] if lines else "", fields


class _Inflate:
    """The content of one gzip member, by pieces."""

    def __init__(self, source: _Source):
        self.source = source
        self.engine = zlib.decompressobj(31)
        self.data = b""
        head = source.fill(24)
        self.end = None
        if head[3] & 4 and head[12:14] == b"sl" and int.from_bytes(head[16:20], "little"):
            self.end = source.at + int.from_bytes(head[16:20], "little")

    def more(self, limit: int = 1 << 16) -> bool:
        if self.engine.eof:
            return False
        pending = self.engine.unconsumed_tail
        if not pending:
            pending = self.source.fill(1)
            if not pending:
                raise ValueError("the archive ends inside a record")
            self.source.skip(len(pending))
        self.data += self.engine.decompress(pending, limit)
        return True

    def head(self) -> bytes:
        while b"\r\n\r\n" not in self.data and self.more(1 << 11):
            pass
        head, _, self.data = self.data.partition(b"\r\n\r\n")
        return head

    def whole(self) -> bytes:
        parts = [self.data]
        while not self.engine.eof:
            self.data = b""
            self.more(1 << 22)
            parts.append(self.data)
        return b"".join(parts)

    def leave(self) -> None:
        """Go to the next member, without inflating where the length is known."""
        if self.engine.eof:
            back = len(self.engine.unused_data)
        elif self.end is not None:
            consumed = self.source.at
            if self.end >= consumed:
                return self.source.skip(self.end - consumed)
            back = consumed - self.end
            lost = self.engine.unconsumed_tail
            self.source.held, self.source.at = lost[len(lost) - back :] + self.source.held, self.end
            return None
        else:
            while self.more(1 << 22):
                self.data = b""
            back = len(self.engine.unused_data)
        self.source.held, self.source.at = self.engine.unused_data + self.source.held, self.source.at - back
        return None


class _Plain:
    """A record of an archive that is not compressed."""

    def __init__(self, source: _Source):
        self.source, self.left = source, 0

    def head(self) -> bytes:
        n = READ_BYTES
        while b"\r\n\r\n" not in self.source.fill(n) and self.source.at + len(self.source.held) < self.source.size:
            n = len(self.source.held) + READ_BYTES
        head, _, _ = self.source.held.partition(b"\r\n\r\n")
        self.source.skip(len(head) + 4)
        self.left = int(_parse(head)[1].get("content-length") or 0)
        return head

    def whole(self) -> bytes:
        data = self.source.fill(self.left)[: self.left]
        self.source.skip(len(data))
        self.left = 0
        return data

    def leave(self) -> None:
        self.source.skip(self.left)
        while self.source.fill(2)[:2] == b"\r\n":
            self.source.skip(2)


def _bare_id(value: str | None) -> str | None:
    if value is None:
        return None
    value = value.strip("<>")
    return value[len(_ID) :] if value.startswith(_ID) else value


def _value(column: str, fields: dict[str, str]) -> str | None:
    value = fields.get(HEADER_OF[column])
    if column in ("record_id", "refers_to"):
        return _bare_id(value)
    if column == "payload_digest" and value:
        return value.partition(":")[2] or value
    return value


def _holds(test: Filter, value: str | None) -> bool:
    if value is None:
        return False
    if isinstance(test, EqualTo):
        return value == test.value
    if isinstance(test, In):
        return value in test.value
    return value.startswith(test.value) if isinstance(test, StringStartsWith) else True


def read_records(store, path: str, filters: list[Filter], payload: bool) -> Iterator[dict]:
    """The records that pass ``filters``, headers first; payloads only where wanted."""
    with store.open_input_file(path) as file:
        source = _Source(file)
        while start := source.fill(24):
            record = (_Inflate if start[:2] == b"\x1f\x8b" else _Plain)(source)
            version, fields = _parse(record.head())
            if not version.startswith("WARC/"):
                raise ValueError(f"{path}: no WARC record at byte {source.at}")
            row = {column: _value(column, fields) for column in HEADER_OF} | {"file": path}
            if all(_holds(f, row[f.attribute[0]]) for f in filters):
                yield row | _content(record, fields, payload)
            record.leave()


def _content(record: _Inflate | _Plain, fields: dict[str, str], payload: bool) -> dict:
    length = int(fields.get("content-length") or 0)
    http = fields.get("content-type", "").startswith("application/http")
    row = {"payload": None, "payload_length": None if http else length, "digest_ok": None}
    if not payload and not http:
        return row
    if http and not payload:
        row["payload_length"] = _http_length(record)
        return row
    block = record.whole()[:length]
    body = block
    if http:
        head, _, body = block.partition(b"\r\n\r\n")
        row["payload_length"] = int(_parse(head)[1].get("content-length") or len(body))
    if fields.get("warc-type") != "revisit":
        kind, _, digest = fields.get("warc-payload-digest", "").partition(":")
        row |= {"payload": body, "payload_length": len(body)}
        row["digest_ok"] = sha1_base32(body) == digest if kind == "sha1" else None
    return row


def _http_length(record: _Inflate | _Plain) -> int | None:
    """The length in the HTTP headers, which stand before the payload."""
    if isinstance(record, _Plain):
        head = record.source.fill(min(record.left, 1 << 16))[: record.left]
    else:
        while b"\r\n\r\n" not in record.data and len(record.data) < 1 << 16 and record.more(1 << 12):
            pass
        head = record.data
    found = _parse(head.partition(b"\r\n\r\n")[0])[1].get("content-length")
    return int(found) if found else None


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.columns = options["path"], schema.names
        self.payload = options.get("payload", "true").lower() == "true"
        self.limit = int(options.get("partitionBytes") or TASK_BYTES)
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for test in filters:
            value = getattr(test, "value", "")
            text = all(isinstance(v, str) for v in ([value] if isinstance(value, str) or not hasattr(value, "__iter__") else value))
            if isinstance(test, (EqualTo, In, IsNotNull, StringStartsWith)) and test.attribute[0] in HEADER_OF and text:
                self.filters.append(test)
            else:
                yield test

    def partitions(self) -> list[Files]:
        """Files largest first, each to a task with room for it."""
        from pyarrow import fs

        store, root = _filesystem(self.path)
        info = store.get_file_info(root)
        found = [info] if info.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        files = sorted(
            ((f.size or 0, f.path) for f in found
             if f.is_file and re.search(r"\.warc(\.gz)?$", f.path) and "/_" not in f.path[len(root) :]),
            reverse=True,
        )
        tasks: list[Files] = []
        room = 0
        for size, path in files:
            if not tasks or size > room:
                tasks.append(Files([]))
                room = self.limit
            tasks[-1].paths.append(path)
            room -= size
        return tasks or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([
            (c, pa.int64() if c == "payload_length" else pa.binary() if c == "payload" else pa.bool_() if c == "digest_ok" else pa.string())
            for c in self.columns
        ])
        store, _ = _filesystem(self.path)
        rows, held = [], 0
        for path in partition.paths:
            for row in read_records(store, path, self.filters, self.payload):
                rows.append(row)
                held += len(row["payload"] or b"")
                if len(rows) >= BATCH_RECORDS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist([{c: r[c] for c in self.columns} for r in rows], kinds)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([{c: r[c] for c in self.columns} for r in rows], kinds)


class WarcSource(DataSource):
    """``format("warc")``.  Options: path; reading: payload (true), partitionBytes; writing: date, fileBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known, with filters handed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive_pages(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0
) -> None:
    """Write a record per page below ``path``; equal payloads are stored once.

    Of pages with equal payloads of ``least_bytes`` or more, that with the largest key is
    the response and the others revisit it; rows with that same key are responses too.
    A null page text is an empty payload.  A row with a null key is a response under a
    random id and nothing refers to it; a null url leaves its header out.
    """
    register(pages.sparkSession)
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    # Only groups of several pages come back; both aggregates combine before they are shuffled.
    repeated = rows.where(F.col("size") >= least_bytes).groupBy("digest", "size").agg(
        F.max("key").alias("newest"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    chosen = rows.join(repeated, ["digest", "size"], "left").select(
        F.col("key").cast("string").alias("record_id"), "target_uri", "payload",
        F.when(F.col("newest") != F.col("key"), F.col("newest").cast("string")).alias("refers_to"),
    )
    chosen.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``; without ``payload`` only headers are inflated."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive_pages(pages, path)
    records = read_archives(spark, path).where(F.col("record_type").isin("response", "revisit"))
    sound = F.when(F.coalesce("digest_ok", F.lit(True)), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest in "), "file"))
    )
    return records.select(
        F.col("record_id").try_cast("long").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        sound.alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS newest,
         array_to_string(list_transform(string_split(sha1(h), ''), lambda c:
           substr('0000000100100011010001010110011110001001101010111100110111101111',
                  4 * (strpos('0123456789abcdef', c) - 1) + 1, 4)), '') AS bits
  FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         list_sum(list_transform(range(5), lambda b: substr(bits, 5 * i + b + 1, 1)::INT * (16 >> b)))::INT + 1, 1)), '')
         AS payload_digest,
       CASE WHEN newest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN newest <> page_id THEN newest END AS refers_to
FROM d
"""
