"""Exact dedup with a persistent digest index.

The index is a table of (digest, keep_id), bucketed and sorted by digest. New
rows are grouped by the SHA-256 of their text, anti-joined with the index by
sort-merge on the digest, and what is new is appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import Workspace, bounded, hot_join

#: Buckets of a new index: so many at least, and one for so many digests (some 80 MB).
LEAST_BUCKETS, BUCKET_ROWS = 64, 2_000_000


class DigestIndex:
    """Digests seen so far, at ``path``, in ``buckets`` buckets sorted by digest.

    The same path can be opened by later sessions; the bucket count is part of
    the folder's name, so that a folder always has one layout. Every append adds
    a file to each bucket; rebuilt gives an index with one file each again, and
    with more buckets where there are more digests.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = LEAST_BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.location = f"{path.rstrip('/')}/digests-{buckets}"
        self.table = "docmill_digests_" + hashlib.sha1(self.location.encode()).hexdigest()[:16]
        where = self.location.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{where}'"
        )

    def forget(self) -> None:
        """Take the name out of this session's catalog; the digests stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, new: DataFrame) -> None:
        """Add rows (digest, keep_id); one file per bucket and append."""
        new.select("digest", "keep_id").repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)

    def rebuilt(self, path: str) -> DigestIndex:
        """A new index at path with the same digests, compacted, and buckets for their number; this one stays as it is."""
        new = DigestIndex(self.spark, path, buckets_for(self.read().count()))
        if new.read().limit(1).count():
            raise ValueError(f"{path} has an index already")
        new.append(self.read())
        return new


def buckets_for(digests: int) -> int:
    return max(LEAST_BUCKETS, -(-digests // BUCKET_ROWS))


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows with identical texts form a group, null counting as the empty text; no
    text is changed first. keep_id is the index's id where it has the digest,
    else the group's largest id, which is appended to the index. group_size
    counts this call's rows. Repeated rows with one id all carry kept = true if
    that id stays. A null id ranks below every other and stays only in a group
    that has no other. An empty table gives an empty result. Other columns are
    ignored. Without an index, a new one in the shared folder is used.

    Digests are pre-aggregated before the shuffle. What is handed back to the
    rows of large groups is broadcast (see hot_join), so a group with a third of
    all rows isn't one task's work.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "exact")
    own = index is None
    rows = work.save(docs.select(F.col(id_col).cast("long").alias("doc_id"), digest_of(F.col(text_col)).alias("digest")), "rows")
    groups = work.save(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    index = index or DigestIndex(spark, work.path("index"), buckets_for(groups.count()))
    held = index.read().select("digest", F.col("keep_id").alias("held_id"), F.lit(True).alias("held"))
    # Written before the append: afterwards the index also has this call's rows.
    known = work.save(groups.join(held.hint("merge"), "digest"), "known")
    index.append(groups.join(index.read().hint("merge"), "digest", "left_anti"))
    if own:
        index.forget()
    shared = groups.where("group_size > 1").join(known.select("digest"), "digest", "left_anti").select("digest", "keep_id", "group_size")
    told = shared.unionByName(known.select("digest", F.col("held_id").alias("keep_id"), "group_size")).withColumn("told", F.lit(True))
    told = work.save(told, "told")
    keep = F.when(F.col("told"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return hot_join(rows, told, ["digest"], "group_size", rows.count(), "left").select(
        F.col("doc_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; of repeated rows of one id and text, one stays."""
    work = Workspace(docs.sparkSession, "exact-rows")
    verdict = work.save(exact_dedup(docs, index, id_col, text_col), "verdict")
    gone = verdict.where("NOT kept").select(F.col(id_col).alias("__id"), F.unhex("text_sha256").alias("__hash")).distinct()
    gone = bounded(work.save(gone, "gone"))
    rows = docs.withColumn("__digest", digest_of(F.col(text_col)))
    out = rows.join(gone, rows[id_col].cast("long").eqNullSafe(gone["__id"]) & (rows["__digest"] == gone["__hash"]), "left_anti")
    if verdict.where("kept").groupBy(id_col, "text_sha256").count().where("count > 1").limit(1).count():
        out = out.dropDuplicates([id_col, "__digest"])
    return out.drop("__digest")
