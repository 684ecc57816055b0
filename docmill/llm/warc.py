"""WARC archives as a Spark data source, read and written.

Each record is a gzip member of its own (or plain bytes in .warc files). The
writer notes a member's length in its gzip header, so that the reader can pass
over a member after its WARC header. Paths are local (file:) or whatever
pyarrow's file systems open, and must be shared by driver and executors.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from ..shipping import ship
from .workspace import Workspace, bounded, hot_join

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, payload_bytes long, "
    "refers_to string, headers map<string,string>, payload binary, file string, offset long"
)
#: A task reads files of about this size together, and begins a new archive after it.
PART_BYTES = 128 << 20
LEAST_REVISIT = 1000
_HEAD = 1 << 16
_BATCH_ROWS, _BATCH_BYTES = 1000, 16 << 20


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _line(value: str) -> str:
    """A header value on one line of ASCII: other bytes, spaces and % are percent-encoded."""
    return "".join(chr(b) if 33 <= b < 127 and b != 37 else f"%{b:02X}" for b in value.encode("utf-8", "replace"))


def _unline(value: str) -> str:
    out, raw, i = bytearray(), value.encode("utf-8", "replace"), 0
    while i < len(raw):
        if raw[i] == 37 and i + 2 < len(raw) + 0 and all(c in b"0123456789abcdefABCDEF" for c in raw[i + 1 : i + 3]) and len(raw[i + 1 : i + 3]) == 2:
            out.append(int(raw[i + 1 : i + 3], 16))
            i += 3
        else:
            out.append(raw[i])
            i += 1
    return out.decode("utf-8", "replace")


def member(record: bytes) -> bytes:
    """A gzip member; its extra field DM holds the member's whole length."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = squeeze.compress(record) + squeeze.flush()
    length = 10 + 2 + 12 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHQ", 12, b"DM", 8, length) + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def encode_record(row: dict) -> bytes:
    """One record. A response's block is an HTTP response with the payload, a revisit's only its HTTP header."""
    payload = bytes(row["payload"] or b"")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + (payload if row["record_type"] == "response" else b"")
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Date: {row.get('date') or '1970-01-01T00:00:00Z'}",
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if row.get("target_uri") is not None:
        lines.append(f"WARC-Target-URI: {_line(row['target_uri'])}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Refers-To: <{row['refers_to']}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes archives under names of its own; a manifest lists those of tasks that were committed."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size > PART_BYTES:
                    if out:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    size += out.write(member(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n" % str(uuid.uuid4()).encode()))
                size += out.write(member(encode_record(row)))
        if out:
            out.close()
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        name = f"{root}/_manifest-{uuid.uuid4().hex}"
        with fs.open_output_stream(name + ".tmp") as out:
            out.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())
        fs.move(name + ".tmp", name + ".json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _fs(self.path)
        for m in messages:
            for f in m.files if m else ():
                fs.delete_file(f"{root}/{f}")


class _Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class _Member:
    """The content of the gzip member at a place of a stream, as much as is asked for; its first bytes were read already."""

    def __init__(self, stream, at: int, first: bytes):
        self.stream, self.at = stream, at
        self.inflater, self.rest, self.data = zlib.decompressobj(31), first, bytearray()

    def more(self, most: int = 1 << 20) -> bool:
        if self.inflater.eof:
            return False
        self.rest = self.rest or self.stream.read(_HEAD)
        if not self.rest:
            raise ValueError(f"the record at {self.at} is cut off")
        self.data += self.inflater.decompress(self.rest, most)
        self.rest = self.inflater.unconsumed_tail
        return True

    def head(self) -> bytes | None:
        """The next record's header, or None at the member's end."""
        while True:
            begin = len(self.data) - len(self.data.lstrip(b"\r\n"))
            end = self.data.find(b"\r\n\r\n", begin)
            if end >= 0:
                out = bytes(self.data[begin:end])
                del self.data[: end + 4]
                return out
            if not self.more(_HEAD):
                if self.data.strip():
                    raise ValueError(f"the record at {self.at} is cut off")
                return None

    def take(self, size: int, keep: bool) -> bytes | None:
        """The next size bytes, or nothing but the way past them."""
        parts = []
        while True:
            got = self.data[:size]
            size -= len(got)
            if keep:
                parts.append(bytes(got))
            del self.data[: len(got)]
            if not size:
                return b"".join(parts) if keep else None
            if not self.more():
                raise ValueError(f"the record at {self.at} is cut off")

    def end(self) -> int:
        """Where the next member begins."""
        while self.more():
            self.data.clear()
        return self.stream.tell() - len(self.inflater.unused_data)


def parse_headers(head: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            found[last] = value.strip()
    return found


def records(stream, gzipped: bool, wanted) -> Iterator[tuple[int, dict[str, str], bytes | None]]:
    """(offset, headers, block) of each record that ``wanted(headers)`` accepts; it returns (keep, with block).

    Headers are parsed first; a block that isn't wanted is passed over: by a
    seek in plain files and where a gzip member tells its length, else by
    inflating without keeping. A gzip member may have any number of records;
    all of them have its offset.
    """
    at = 0
    while True:
        stream.seek(at)
        data = stream.read(_HEAD)
        if not data:
            return
        if gzipped:
            length = None
            if len(data) >= 24 and data[3] & 4 and data[12:14] == b"DM":
                length = struct.unpack("<Q", data[16:24])[0]
            member_ = _Member(stream, at, data)
            passed = False
            while (head := member_.head()) is not None:
                headers = parse_headers(head)
                keep, whole = wanted(headers)
                if not (keep and whole) and length:  # a member of the own writer has one record
                    if keep:
                        yield at, headers, None
                    passed = True
                    break
                block = member_.take(int(headers.get("content-length", 0)), keep and whole)
                if keep:
                    yield at, headers, block
            at = at + length if passed else member_.end()
            continue
        while b"\r\n\r\n" not in data:
            more = stream.read(_HEAD)
            if not more:
                if data.strip():
                    raise ValueError(f"the record at {at} is cut off")
                return
            data += more
        head, _, block = data.partition(b"\r\n\r\n")
        headers = parse_headers(head.lstrip(b"\r\n"))
        keep, whole = wanted(headers)
        size = int(headers.get("content-length", 0))
        begin = at + len(head) + 4
        end = begin + size + 4
        if keep and whole and len(block) < size:
            block += stream.read(size - len(block))
        if keep:
            yield at, headers, block[: int(headers.get("content-length", 0))] if whole else None
        if end <= at:
            return
        at = end


_COLUMNS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to"}


def _field(headers: dict[str, str], column: str) -> str | None:
    value = headers.get(_COLUMNS[column])
    if value is None:
        return None
    return _unline(value) if column == "target_uri" else value.strip("<>") if column in ("record_id", "refers_to") else value


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.types = {t.strip() for t in options.get("payload", "response,revisit").split(",")} - {"", "none"}
        self.allowed: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and IN on columns that come straight from a header are tested before a block is touched; the rest stays with Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, EqualNullSafe, In)) and len(f.attribute) == 1 and f.attribute[0] in _COLUMNS:
                values = set(f.value) if isinstance(f, In) else {f.value}
                known = self.allowed.get(f.attribute[0])
                self.allowed[f.attribute[0]] = values if known is None else known & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = _fs(self.path)
        infos = fs.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True))
        sizes = {i.base_name: i.size for i in infos if i.type == pafs.FileType.File and i.base_name.endswith((".warc", ".warc.gz"))}
        manifests = [i for i in infos if i.base_name.startswith("_manifest-") and i.base_name.endswith(".json")]
        if manifests:
            listed: set[str] = set()
            for m in manifests:
                with fs.open_input_stream(m.path) as s:
                    listed |= set(json.loads(s.read()))
            sizes = {k: v for k, v in sizes.items() if k in listed}
        parts: list[InputPartition] = []
        files, total = [], 0
        for name in sorted(sizes):
            if files and total + sizes[name] > PART_BYTES // 8:
                parts.append(_Files(files))
                files, total = [], 0
            files.append(name)
            total += sizes[name]
        return [*parts, _Files(files)] if files else parts

    def _wanted(self, headers: dict[str, str]) -> tuple[bool, bool]:
        keep = all(_field(headers, c) in values for c, values in self.allowed.items())
        return keep, headers.get("warc-type") in self.types

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(self.path)
        schema = _arrow_schema()
        rows, size = [], 0
        for name in partition.files if partition else ():
            with fs.open_input_file(f"{root}/{name}") as stream:
                for offset, headers, block in records(stream, name.endswith(".gz"), self._wanted):
                    rows.append(_row(name, offset, headers, block))
                    size += len(block or b"")
                    if len(rows) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def _arrow_schema() -> pa.Schema:
    text = pa.string()
    return pa.schema([
        ("record_id", text), ("record_type", text), ("target_uri", text), ("date", text), ("payload_digest", text), ("payload_bytes", pa.int64()),
        ("refers_to", text), ("headers", pa.map_(text, text)), ("payload", pa.binary()), ("file", text), ("offset", pa.int64()),
    ])


def _row(name: str, offset: int, headers: dict[str, str], block: bytes | None) -> dict:
    digest = headers.get("warc-payload-digest", "")
    if digest.startswith("sha1:") and len(digest) == 37:
        digest = base64.b32decode(digest[5:]).hex()
    payload, size = None, None
    if block is not None:
        payload = block
        if headers.get("content-type", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(parse_headers(http).get("content-length", len(payload)))
        else:
            size = len(payload)
        if headers.get("warc-type") == "revisit":
            payload = None  # its block is only the HTTP header, which tells the length
    return {c: _field(headers, c) for c in _COLUMNS} | {
        "payload_digest": digest or None, "payload_bytes": size, "headers": list(headers.items()), "payload": payload, "file": name, "offset": offset,
    }


class WarcDataSource(DataSource):
    """spark.read.format("warc"): option payload lists the record types whose blocks are decoded ("response,revisit" by default, "none" for none); others have no payload and no payload_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives can only be appended")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_archives(spark: SparkSession, path: str, payload: str = "response,revisit") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def write_archives(records_: DataFrame, path: str) -> None:
    """Append records (record_id, record_type, target_uri, payload, payload_bytes, payload_digest, refers_to) to the archives at path."""
    register(records_.sparkSession)
    records_.write.format("warc").mode("append").save(path)


def to_records(pages: DataFrame, least: int = LEAST_REVISIT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A record per row of pages: its HTML in UTF-8 as payload, null being empty.

    Of rows with equal payloads of ``least`` bytes or more, that with the
    largest id is a response and the others are revisits that refer to it, with
    no payload of their own. Rows that repeat that id are responses too. Null
    ids rank below others; null URLs have no target. Other columns are ignored.
    """
    work = Workspace(pages.sparkSession, "warc-records")
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("target_uri"), html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha1(html).alias("payload_digest"), F.xxhash64(html).alias("check"),
    )
    key = ["payload_digest", "payload_bytes", "check"]
    shared = rows.where(F.col("payload_bytes") >= least).groupBy(*key).agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = work.save(shared, "shared")
    small = bounded(shared)
    if small is shared:
        told = hot_join(rows, shared, key, "n", rows.count(), "left")
    else:
        told = rows.join(small, key, "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    name = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return told.select(
        name(F.col("id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(again, F.lit(None)).otherwise(F.encode("html", "UTF-8")).cast("binary").alias("payload"), "payload_bytes", "payload_digest", F.when(again, name(F.col("first"))).alias("refers_to"),
    )


def page_of(column: str) -> Column:
    return F.expr(f"try_cast(substring({column}, 12) AS bigint)")
