"""Choosing documents that look like a target set: importance weights of hashed n-grams, and a seeded draw.

One pass over a document's words keeps the zlib CRC-32 states of its last n
starts. Each next word extends every state by a space and the word, and the
states that it makes are the hashes of all runs that end there, so a run of n
words costs as much as its last word. Their buckets are written once; counts
of all documents, and then weights, are made from the buckets alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shipping import ship
from .workspace import Workspace, small_batches

#: A-Z become a-z; bytes below 0x80 that are neither digits nor letters part words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def run_hashes(words: list[bytes], n: int) -> Iterator[int]:
    """CRC-32 of every run of 1 to n words, joined by a space, in the order of their last words."""
    ring: list[int] = []  # states of runs that ended at the word before, the latest start first
    for word in words:
        spaced = b" " + word
        ring = [crc32(word), *[crc32(spaced, s) for s in ring[: n - 1]]]
        yield from ring


def features(docs: DataFrame, n: int = 1, buckets: int = 10_000, id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and buckets (binary: one little-endian integer for each run of 1 to n words) of every whole text.

    Integers have 16 bits for up to 65,536 buckets and else 32. Null and empty texts have none.
    """
    if n < 1 or not 1 <= buckets <= 1 << 32:
        raise ValueError("n must be 1 or more, and buckets from 1 to 2**32")
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, counts, made = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                hashes = np.fromiter(map(crc32, words) if n == 1 else run_hashes(words, n), np.uint32)
                sizes.append(len(words))
                counts.append(len(hashes))
                made.append((hashes % np.uint64(buckets)).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(made, pa.binary())], ["doc_id", "n_words", "n_features", "buckets"])

    own = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    return docs.select(own.alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(scan, "doc_id long, n_words long, n_features long, buckets binary")


def bucket_counts(found: DataFrame, buckets: int) -> DataFrame:
    """bucket and n, over all rows; each task sends its own counts once."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                held += np.bincount(np.frombuffer(raw.as_buffer(), kind), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], ["bucket", "n"])

    return found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """bucket and gain: floor(1000 * ln) of the ratio of its smoothed shares of the target's and the source's features, for every bucket."""
    every = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"])
    totals = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    whole = [F.col(c).cast("double") for c in ("t", "all_s", "s", "all_t")]
    ratio = (whole[0] + 1) * (whole[1] + buckets) / ((whole[2] + 1) * (whole[3] + buckets))
    return both.crossJoin(F.broadcast(totals)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """found with weight, the floored mean of its features' gains (0 without features), in place of its buckets."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    shared = found.sparkSession.sparkContext.broadcast(gain)  # as long as there are buckets, whatever the input

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for raw in batch.column(3):
                own = np.frombuffer(raw.as_buffer(), kind)
                made.append(int(shared.value[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return found.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int | str, doc_id: Column) -> Column:
    """floor(1000 * Gumbel) of a document, from the first 32 bits of SHA-256 of "seed:doc_id"; a null id hashes as an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int | str = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of docs; rank is null for rows that aren't drawn.

    Of the N rows with ``least_words`` words or more, floor(percent * N / 100)
    with the highest scores are drawn, ties to the smaller id (a null id comes
    first). Rows that repeat an id count one by one. An empty table gives an
    empty result; without target texts, all documents are weighed against even
    shares. Ids must be whole numbers; other columns are ignored.

    Scores are whole numbers in a narrow range (a few ten thousand values
    however many documents there are), so places come from the counts of
    scores, and rows are numbered only among those of their score.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "resample")
    found = work.save(features(docs, n, buckets, id_col, text_col), "features")
    wanted = features(target, n, buckets, None, target_col)
    table = work.save(gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets), buckets), "gains")
    gain = np.zeros(buckets, np.int64)
    for r in table.toLocalIterator():  # one row per bucket
        gain[r.bucket] = r.gain
    scored = work.save(weighted(found, gain).withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))), "scores")
    work.drop("features")

    fit = F.col("n_words") >= least_words
    drawn = F.floor(percent * F.sum("__n").over(Window.partitionBy()) / 100)
    above = F.sum("__n").over(Window.orderBy(F.desc("score"))) - F.col("__n")
    places = scored.where(fit).groupBy("score").agg(F.count("*").alias("__n")).select("score", drawn.alias("__k"), above.alias("__above")).where("__above < __k")
    marked = scored.join(F.broadcast(work.save(places, "places")), "score", "left")
    place = F.col("__above") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "weight", "n_features"))
    inside = fit & F.col("__k").isNotNull()
    first = marked.where(inside).withColumn("rank", place).withColumn("rank", F.when(F.col("rank") <= F.col("__k"), F.col("rank")))
    rest = marked.where(~inside).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).select(*scored.columns, "rank")
