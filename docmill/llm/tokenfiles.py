"""Token ids of documents in files of their own format, written and read by Spark.

A file holds the ids of many documents in a row, cut into blocks of
``idcoder.BLOCK`` ids. Each block is coded by itself and has a CRC-32 of its ids
(little-endian, 32 bits each), so a reader can begin at any block, and a block
that doesn't decode to what was written is refused. After the blocks come the documents'
ids and lengths and the blocks' sizes and checksums, with a checksum of their own.

A write is a new folder or an append to one. Tasks write files under names of
their own, and a manifest that the driver writes last lists the files of the
tasks that were committed, in the order of the partitions, with their numbers
of ids; other files are not read. Paths are those of ``warc``: local, or what pyarrow
opens, and shared by driver and executors.
"""

from __future__ import annotations

import json
import os
import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from ..shipping import ship
from . import idcoder
from .warc import _fs
from .workspace import small_batches

SCHEMA = "doc_id long, start long, n_tokens long, ids binary, file string"
MAGIC = b"DMIDS01\n"
#: A file is ended after so many ids or documents, whichever comes first.
FILE_IDS, FILE_DOCS = 32 << 20, 1 << 20
_HEAD, _TAIL = struct.Struct("<8sQ"), struct.Struct("<QI8s")
_BATCH_BYTES = 8 << 20


class FileWriter:
    """Ids of one document after the other into a stream; holds one group of blocks."""

    def __init__(self, stream, vocab: int):
        self.stream, self.vocab, self.group = stream, vocab, idcoder.LANES * idcoder.BLOCK
        self.waiting: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.sizes: list[int] = []
        self.sums: list[int] = []
        stream.write(_HEAD.pack(MAGIC, vocab))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >= self.vocab:
            raise ValueError(f"document {doc_id} has an id that isn't below {self.vocab}")
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        for at in range(0, len(ids), self.group):
            self.waiting.append(ids[at : at + self.group])
            self.held += len(self.waiting[-1])
            if self.held >= self.group:
                self._flush(self.group)

    def _flush(self, n: int) -> None:
        every = np.concatenate(self.waiting)
        now, rest = every[:n], every[n:]
        self.waiting, self.held = [rest], len(rest)
        blocks = [now[i : i + idcoder.BLOCK] for i in range(0, len(now), idcoder.BLOCK)]
        # The last block of a file is filled up with its last id; its length says where it ends.
        width = len(blocks[0])
        table = np.stack([np.pad(b, (0, width - len(b)), "edge") for b in blocks])
        for block, code in zip(blocks, idcoder.encode(table, self.vocab)):
            self.stream.write(code)
            self.sizes.append(len(code))
            self.sums.append(zlib.crc32(block.astype("<u4").tobytes()))

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        parts = [
            np.array([len(self.doc_ids), len(self.sizes)], "<i8"), np.array([d or 0 for d in self.doc_ids], "<i8"), np.array([d is None for d in self.doc_ids], np.uint8),
            np.array(self.lengths, "<i8"), np.array(self.sizes, "<u4"), np.array(self.sums, "<u4"),
        ]
        index = zlib.compress(b"".join(p.tobytes() for p in parts))
        self.stream.write(index + _TAIL.pack(len(index), zlib.crc32(index), MAGIC))
        self.stream.close()


class FileIndex:
    """What a file says of itself at its end."""

    def __init__(self, stream, name: str):
        size = stream.size()
        if size < _HEAD.size + _TAIL.size:
            raise ValueError(f"{name} is cut off")
        length, check, magic = _TAIL.unpack(stream.read_at(_TAIL.size, size - _TAIL.size))
        head, self.vocab = _HEAD.unpack(stream.read_at(_HEAD.size, 0))
        index = stream.read_at(length, size - _TAIL.size - length) if magic == head == MAGIC and length < size else b""
        if zlib.crc32(index) != check or not index:
            raise ValueError(f"{name} is no file of token ids, or is damaged")
        raw = zlib.decompress(index)
        n_docs, n_blocks = np.frombuffer(raw, "<i8", 2).tolist()
        at = 16
        found = []
        for kind, n in (("<i8", n_docs), (np.uint8, n_docs), ("<i8", n_docs), ("<u4", n_blocks), ("<u4", n_blocks)):
            found.append(np.frombuffer(raw, kind, n, at))
            at += found[-1].nbytes
        self.doc_ids, self.null, self.lengths, sizes, self.sums = found
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.offsets = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))]) + _HEAD.size


def documents(stream, name: str, wanted=None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids before it in the file, its ids) of the documents that ``wanted(doc_ids, null)`` marks; only their blocks are decoded."""
    index = FileIndex(stream, name)
    chosen = np.flatnonzero(wanted(index.doc_ids, index.null)) if wanted else np.arange(len(index.doc_ids))
    size, n_ids, n_blocks = idcoder.BLOCK, int(index.starts[-1]), len(index.sums)
    first, last = index.starts[chosen] // size, (index.starts[chosen] + index.lengths[chosen] - 1) // size
    some = index.lengths[chosen] > 0
    change = np.bincount(first[some], minlength=n_blocks + 1) - np.bincount(last[some] + 1, minlength=n_blocks + 1)
    needed = np.flatnonzero(np.cumsum(change)[:n_blocks] > 0)
    group = idcoder.LANES
    have: dict[int, np.ndarray] = {}
    at = 0
    for lo in range(0, max(len(needed), 1), group):
        own = needed[lo : lo + group]
        codes: list[bytes] = []
        for run in np.split(own, np.flatnonzero(np.diff(own) > 1) + 1) if len(own) else ():
            a = index.offsets[run[0]]
            data = stream.read_at(int(index.offsets[run[-1] + 1] - a), int(a))
            codes += [data[index.offsets[b] - a : index.offsets[b + 1] - a] for b in run]
        for b, ids in zip(own.tolist(), idcoder.decode(codes, [min(size, n_ids - b * size) for b in own.tolist()], index.vocab)):
            if zlib.crc32(ids.tobytes()) != index.sums[b]:
                raise ValueError(f"block {b} of {name} is damaged")
            have[b] = ids
        done = int(own[-1]) if lo + group < len(needed) else n_blocks
        while at < len(chosen) and (not some[at] or last[at] <= done):
            k = chosen[at]
            parts = [have[b] for b in range(first[at], last[at] + 1)] if some[at] else []
            ids = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            off = int(index.starts[k] - first[at] * size)
            yield None if index.null[k] else int(index.doc_ids[k]), int(index.starts[k]), ids[off : off + int(index.lengths[k])]
            at += 1
        if at < len(chosen):
            have = {b: ids for b, ids in have.items() if b >= first[at]}


@dataclass
class _Written(WriterCommitMessage):
    partition: int
    files: list[dict]


class TokenWriter(DataSourceArrowWriter):
    def __init__(self, path: str, vocab: int):
        self.path, self.vocab = path, vocab

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        files: list[dict] = []
        out = None

        def end() -> None:
            if out:
                out.close()
                files[-1] |= {"ids": out.n_ids, "docs": len(out.lengths)}

        for batch in iterator:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                if out is None or out.n_ids >= FILE_IDS or len(out.lengths) >= FILE_DOCS:
                    end()
                    files.append({"file": f"part-{uuid.uuid4().hex}.ids"})
                    out = FileWriter(fs.open_output_stream(f"{root}/{files[-1]['file']}", compression=None), self.vocab)
                out.add(doc_id, np.frombuffer(ids.as_buffer() or b"", "<u4"))
        end()
        return _Written(TaskContext.get().partitionId(), files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _fs(self.path)
        fs.create_dir(root, recursive=True)
        name = f"{root}/_manifest-{time.time_ns():020d}-{uuid.uuid4().hex}"
        listed = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
        with fs.open_output_stream(name + ".tmp") as out:
            out.write(json.dumps(listed).encode())
        fs.move(name + ".tmp", name + ".json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _fs(self.path)
        for m in messages:
            for f in m.files if m else ():
                fs.delete_file(f"{root}/{f['file']}")


class _File(InputPartition):
    def __init__(self, name: str, start: int):
        self.name, self.start = name, start


_TESTS = {
    EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal,
    In: lambda ids, values: np.isin(ids, [v for v in values if v is not None]),
}


class TokenReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.ids = options["path"], options.get("ids", "true").lower() == "true"
        self.tests: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of doc_id with values are made on a file's index; blocks of other documents aren't decoded."""
        for f in filters:
            if type(f) in _TESTS and f.attribute == ("doc_id",):
                self.tests.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = _fs(self.path)
        infos = fs.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True))
        parts: list[InputPartition] = []
        start = 0
        for m in sorted(i.path for i in infos if i.base_name.startswith("_manifest-") and i.base_name.endswith(".json")):
            with fs.open_input_stream(m) as s:
                for f in json.loads(s.read()):
                    parts.append(_File(f["file"], start))
                    start += f["ids"]
        return parts

    def _wanted(self, ids: np.ndarray, null: np.ndarray) -> np.ndarray:
        keep = np.ones(len(ids), bool)
        for kind, value in self.tests:
            keep &= _TESTS[kind](ids, value) & (null == 0)
        return keep

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        fs, root = _fs(self.path)
        rows, size = [], 0
        with fs.open_input_file(f"{root}/{partition.name}") as stream:
            if self.ids:
                found = documents(stream, partition.name, self._wanted)
            else:
                index = FileIndex(stream, partition.name)
                found = ((None if index.null[k] else int(index.doc_ids[k]), int(index.starts[k]), int(index.lengths[k])) for k in np.flatnonzero(self._wanted(index.doc_ids, index.null)))
            for doc_id, at, ids in found:
                raw = ids.astype("<u4").tobytes() if self.ids else None
                rows.append((doc_id, partition.start + at, len(ids) if self.ids else ids, raw, partition.name))
                size += 64 + len(raw or b"")
                if size >= _BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "start", "n_tokens", "ids", "file"])


class TokenDataSource(DataSource):
    """spark.read.format("token_ids"): a row per document; option ids=false reads the indexes only. Writing needs option vocab, above every id."""

    @classmethod
    def name(cls) -> str:
        return "token_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return TokenReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("files of token ids can only be appended")
        return TokenWriter(self.options["path"], int(self.options["vocab"]))


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TokenDataSource)


def read_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (32 bits each, little-endian; null without ids) and file."""
    register(spark)
    return spark.read.format("token_ids").option("ids", str(ids).lower()).load(path)


def write_files(rows: DataFrame, path: str, vocab: int) -> None:
    """Append rows (doc_id, ids as 32-bit little-endian integers) in the order of their partitions and in each partition."""
    register(rows.sparkSession)
    rows.select("doc_id", "ids").write.format("token_ids").option("vocab", vocab).mode("append").save(path)


class _Words:
    """Ids of words that were met before; when there are too many, all are forgotten before the next text.

    New words of a text go to the tokenizer in one call, with a special token
    between them, so each is taken for itself; a word that holds this token goes alone.
    """

    MOST, LONGEST = 1 << 19, 64

    def __init__(self, tokenizer):
        self.tokenizer, self.known = tokenizer, {"": b""}
        marks = [(i, t) for i, t in tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.mark_id, self.mark = (marks[-1][0], marks[-1][1].content) if marks else (-1, "")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _new(self, words: list[str]) -> None:
        alone = [w for w in words if not self.mark or self.mark in w]
        words = [w for w in words if self.mark not in w] if self.mark else []
        self.known.update((w, self._ids(w).tobytes()) for w in alone)
        if words:
            ids = self._ids(self.mark + self.mark.join(words) + self.mark)
            cuts = (4 * np.flatnonzero(ids == self.mark_id)).tolist()
            raw = ids.tobytes()
            self.known.update(zip(words, [raw[i + 4 : j] for i, j in zip(cuts, cuts[1:])]))

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        if len(self.known) > self.MOST:
            self.known = {"": b""}
        rare = list(set(words).difference(self.known))
        if rare:
            self._new(rare)
        out = b"".join(map(self.known.__getitem__, words))
        for w in rare:
            if len(w) > self.LONGEST:
                del self.known[w]
        return out


#: Of this worker process, by the tokenizer's text: tasks that come later find the words of those before.
_words: dict[str, _Words] = {}


def _words_of(model: str) -> _Words:
    from tokenizers import Tokenizer

    if model not in _words:
        _words.clear()
        _words[model] = _Words(Tokenizer.from_str(model))
    return _words[model]


def tokenized(docs: DataFrame, tokenizer: str, end: int | None = 1, drops_space: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary, 32 bits each) of every whole text, and after them ``end``; rows keep their order and partition.

    ``tokenizer`` is a file of the tokenizers library on the driver; its text is
    sent to the tasks. With ``drops_space`` the tokenizer must drop spaces and
    line ends and join nothing across them; then words that return are looked up. Null texts are empty: they
    have the end id only.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    with open(tokenizer, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())  # some MB, whatever the input
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        words = _words_of(model.value)
        for batch in batches:
            # One text after the other: their ids take more room than they do.
            texts = (t.as_py() or "" for t in batch.column(1))
            made = [(words.encode(t) if drops_space else words._ids(t).tobytes()) + tail for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encode, "doc_id long, ids binary")


def vocabulary(tokenizer: str) -> int:
    """One more than the largest id that the tokenizer can give."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()) + 1


def write_documents(docs: DataFrame, path: str, tokenizer: str, end: int | None = 1, drops_space: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Every row of docs into files at path, in ascending order of id (a whole number); null ids come first, rows of one id in the order of a hash of their text, then by text.

    Texts are shuffled once, by range of id and hash; a task codes a group of
    blocks at a time, however many or long its texts are. Other columns are ignored.
    """
    vocab = max(vocabulary(tokenizer), (end or 0) + 1)
    order = ["__id", F.xxhash64("__text"), "__text"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # said, else few partitions are made of much work
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)
    write_files(tokenized(rows, tokenizer, end, drops_space, "__id", "__text"), path, vocab)
