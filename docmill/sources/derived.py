"""Files that are derived from a page of a source, kept under the source's hash and the page.

``spark.write.format("derived_files")`` takes rows (source_hash, page, name, content). A
file lies at derived/<hash>/page-<page>/<name>; it is written beside that place
and moved there whole. Each task also writes a list of its files, and a commit names the
lists of the tasks that were committed, so what a failed task has left is never
told, and the driver handles a name per task, not per file. A file that is written again takes the
old one's place; the last commit counts.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.window import Window

from ..shipping import ship

SCHEMA = "source_hash string, page int, name string, key string, length long, sha256 string, committed long, content binary"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, which driver and executors share, and the path in it."""
    if path.startswith(("/", "file:")):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def key_of(source_hash: str, page: int, name: str) -> str:
    """Where a file lies below the root; names of other folders are refused."""
    for part in (source_hash, name):
        if not part or part in (".", "..") or "/" in part or "\\" in part or part.startswith("_"):
            raise ValueError(f"{part!r} can't be a file's or a source's name")
    return f"derived/{source_hash}/page-{page:03d}/{name}"


@dataclass
class _Listed(WriterCommitMessage):
    part: str | None


class DerivedWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = file_system(self.path)
        part, out = f"_lists/{uuid.uuid4().hex}.json", None
        for batch in iterator:
            for row in batch.to_pylist():
                content, key = bytes(row["content"] or b""), key_of(row["source_hash"], row["page"], row["name"])
                folder = f"{root}/{key.rpartition('/')[0]}"
                fs.create_dir(folder, recursive=True)
                beside = f"{folder}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(beside, compression=None) as f:
                    f.write(content)
                fs.move(beside, f"{root}/{key}")
                if out is None:
                    fs.create_dir(f"{root}/_lists", recursive=True)
                    out = fs.open_output_stream(f"{root}/{part}", compression=None)
                told = {k: row[k] for k in ("source_hash", "page", "name")} | {"key": key, "length": len(content), "sha256": hashlib.sha256(content).hexdigest()}
                out.write(json.dumps(told).encode() + b"\n")
        if out:
            out.close()
        return _Listed(part if out else None)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/_commits", recursive=True)
        name = f"{root}/_commits/{time.time_ns():020d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(name, compression=None) as out:
            out.write(json.dumps(sorted(m.part for m in messages if m and m.part)).encode())
        fs.move(name, name + ".json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = file_system(self.path)
        for m in messages:
            if m and m.part:
                fs.delete_file(f"{root}/{m.part}")


class _Part(InputPartition):
    def __init__(self, committed: int, name: str):
        self.committed, self.name = committed, name


class DerivedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.content = options["path"], options.get("content", "false").lower() == "true"
        self.allowed: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Sources, pages and names are tested on the lists; no other file is opened."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in ("source_hash", "page", "name"):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.allowed[f.attribute[0]] = self.allowed.get(f.attribute[0], values) & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = file_system(self.path)
        found: list[InputPartition] = []
        for i in fs.get_file_info(pafs.FileSelector(f"{root}/_commits", allow_not_found=True)):
            if i.base_name.endswith(".json"):
                with fs.open_input_stream(i.path) as s:
                    found += [_Part(int(i.base_name[:20]), p) for p in json.loads(s.read())]
        return found

    def read(self, partition: _Part) -> Iterator[tuple]:
        if partition is None:
            return
        fs, root = file_system(self.path)
        with fs.open_input_stream(f"{root}/{partition.name}") as s:
            rows = [json.loads(x) for x in s.read().splitlines()]
        for r in rows:
            if all(r[c] in values for c, values in self.allowed.items()):
                content = None
                if self.content:
                    with fs.open_input_stream(f"{root}/{r['key']}") as s:
                        content = s.read()
                yield (r["source_hash"], r["page"], r["name"], r["key"], r["length"], r["sha256"], partition.committed, content)


class DerivedFiles(DataSource):
    """spark.read and spark.write, format("derived_files"); reading with option content=true opens the files."""

    @classmethod
    def name(cls) -> str:
        return "derived_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return DerivedReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("derived files can only be appended")
        return DerivedWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DerivedFiles)


def write_derived(rows: DataFrame, path: str) -> None:
    """Write rows (source_hash, page, name, content); null content is an empty file. Two rows of one key in one write leave either's content, so there shouldn't be any."""
    register(rows.sparkSession)
    rows.select("source_hash", F.col("page").cast("int").alias("page"), "name", F.col("content").cast("binary").alias("content")).write.format("derived_files").mode("append").save(path)


def derived_files(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Every committed file once, as its last commit tells."""
    register(spark)
    every = spark.read.format("derived_files").option("content", str(content).lower()).load(path)
    # By what filters are on, so that they pass the window.
    last = Window.partitionBy("source_hash", "page", "name").orderBy(F.desc("committed"), "sha256")
    return every.withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")
