"""Files as rows: recursive discovery, identities, ZIP archives and uploads."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAGIC = b"%PDF-"


def source_identity(relative: Column, digest: Column, scope: Column | None = None) -> Column:
    """scope:path#digest, without a scope path#digest."""
    own = F.concat(relative, F.lit("#"), digest)
    return own if scope is None else F.coalesce(F.concat(scope, F.lit(":"), own), own)


def _described(files: DataFrame, root: str) -> DataFrame:
    prefix = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    relative = F.substring_index(F.col("path"), prefix, -1)
    out = files.withColumn("relative_path", relative).where(~F.col("relative_path").rlike(r"(^|/)\."))
    digest = F.sha2("content", 256)
    return out.select(
        "relative_path", F.element_at(F.split("relative_path", "/"), -1).alias("file_name"), "length", F.col("modificationTime").alias("modified"),
        digest.alias("file_hash"), source_identity(F.col("relative_path"), digest).alias("identity"),
    )


def discovered(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """Files under root that match, without those in dot directories: path, name, size, time, SHA-256 and identity."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return _described(files, root)


def watched(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """The same as a stream: each file once, as it appears."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return _described(files, root)


MEMBER_SCHEMA = "archive string, name string, length long, file_hash string, content binary, problem string"


def _safe(name: str) -> bool:
    path = PurePosixPath(name.replace("\\", "/"))
    return not path.is_absolute() and ".." not in path.parts and ":" not in path.parts[0] if path.parts else False


def _members(data: bytes, most: int) -> Iterator[tuple[str | None, bytes | None, str | None]]:
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile:
        yield None, None, "not a zip"
        return
    infos = [i for i in archive.infolist() if not i.is_dir() and i.filename.lower().endswith(".pdf")]
    seen: set[str] = set()
    for info in infos:
        if not _safe(info.filename):
            yield info.filename, None, "unsafe path"
        elif info.filename in seen:
            yield info.filename, None, "duplicate path"
        elif info.external_attr >> 28 == 0xA:
            yield info.filename, None, "symlink"
        elif info.flag_bits & 1:
            yield info.filename, None, "encrypted"
        elif info.file_size > most:
            yield info.filename, None, "too large"
        else:
            try:
                body = archive.read(info)
            except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError) as e:
                yield info.filename, None, f"damaged: {e}"[:200]
                seen.add(info.filename)
                continue
            problem = "bad magic" if not body.startswith(MAGIC) else "size differs" if len(body) != info.file_size else None
            yield info.filename, None if problem else body, problem
        seen.add(info.filename)
    if not infos:
        yield None, None, "no pdf"


def archive_members(archives: DataFrame, most: int = 512 << 20) -> DataFrame:
    """PDFs in ZIP archives (columns path and content), and what is wrong with those that are refused."""
    import hashlib

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                for n, b, p in _members(content, most):
                    row = (path, n, None if b is None else len(b), None if b is None else hashlib.sha256(b).hexdigest(), b, p)
                    yield pd.DataFrame([row], columns=[c.split()[0] for c in MEMBER_SCHEMA.split(", ")])

    return archives.select("path", "content").mapInPandas(run, MEMBER_SCHEMA)


def not_ingested(objects: DataFrame, ledger: DataFrame) -> DataFrame:
    """Objects (bucket, key, etag) that the ledger doesn't have."""
    return objects.join(ledger.select("bucket", "key", "etag"), ["bucket", "key", "etag"], "left_anti")


def checked_uploads(files: DataFrame, most_file: int, most_batch: int) -> DataFrame:
    """files (batch, name, length, head) with the first problem of each; a batch with any problem is refused as a whole.

    head holds the first bytes of the content.
    """
    from ..functions.text import nfkc

    name = nfkc(F.col("name"))
    unsafe = name.rlike(r"^/|^[A-Za-z]:|(^|[/\\])\.\.([/\\]|$)") | (F.trim(name) == "")
    total = F.sum("length").over(Window.partitionBy("batch"))
    problem = (
        F.when(F.coalesce(unsafe, F.lit(True)), "unsafe name").when(F.col("length") > most_file, "file too large")
        .when(~F.coalesce(F.substring("head", 1, 5) == F.lit(MAGIC), F.lit(False)), "not a pdf").when(total > most_batch, "batch too large")
    )
    marked = files.withColumn("name", name).withColumn("problem", problem)
    return marked.withColumn("accepted", F.count("problem").over(Window.partitionBy("batch")) == 0)


def active_states(states: DataFrame) -> DataFrame:
    """States (state_code, state_name, is_active) of a catalogue with a code like S24 or U05, and its number; only "N" makes one inactive."""
    kept = states.where(F.col("state_code").rlike(r"^[SU]\d{2}$") & ~F.coalesce(F.upper(F.trim("is_active")) == "N", F.lit(False)))
    return kept.select(F.col("state_code").alias("state_cd"), "state_name", F.substring("state_code", 2, 2).alias("code"))


CATALOGUE_KEYS = ("source_filename", "state_code", "ac_code", "booth_code", "roll_revision", "section_number", "section_name_hi", "source_url")


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Complete rows of a JSON catalogue, a list or an object with a list of sections; codes without leading zeros and in upper case."""
    fields = ",".join(f"{k}:string" for k in (*CATALOGUE_KEYS, "source_sha256"))
    text = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", f"array<struct<{fields}>>")
    nested = F.from_json("value", f"struct<sections:array<struct<{fields}>>>")["sections"]
    rows = text.select(F.explode(F.when(F.ltrim("value").startswith("["), listed).otherwise(nested)).alias("r")).select("r.*")
    for k in CATALOGUE_KEYS:
        rows = rows.where(F.trim(F.coalesce(k, F.lit(""))) != "")
    code = lambda c: F.regexp_replace(F.upper(F.trim(c)), r"^0+(?=.)", "")
    return rows.withColumns({k: code(F.col(k)) for k in ("state_code", "ac_code", "booth_code", "section_number")})
