"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

Signature: SYMBOLS MinHash values of B_BITS bits each, cut into CHUNKS chunks; for
similarities below 0.85 there are more chunks of the same width (chunks_for).
Two signatures with at most CHUNKS * (ERRORS + 1) - 1 differing symbols agree,
in at least one chunk, in all but ERRORS symbols (pigeonhole). Every choice of
ERRORS positions of every chunk is enumerated; the other symbols of the chunk
make the join key. So all pairs under that distance (8 of 18) meet under some
key. A pair of Jaccard similarity 0.85 is missed with probability 1e-4.

Pairs that share a key are never listed. Keys link their documents to their
smallest one; the parts that such links connect are brought together with their
whole texts, and there each pair that isn't already connected is confirmed on
the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .graph import connected_components
from .workspace import Workspace, bounded, hot_join, small_batches

SYMBOLS, B_BITS, CHUNKS, ERRORS = 18, 16, 3, 2
#: Symbols of 8 bits, compared before two full sets are; LANES_LEAST must agree at most, and as many that a pair of the wanted similarity fails about twice in 10 ** 6.
LANES, LANES_LEAST = 64, 40
#: Chances at which a pair that is just similar enough may share no key, and be passed over by the lanes.
KEY_MISS, LANE_MISS = 1.1e-4, 2.5e-6
#: Documents and characters that one task compares at most; larger parts are cut into blocks.
BLOCK_DOCS, BLOCK_CHARS = 1024, 8 << 20

SIGNATURE_SCHEMA = "doc_id long, n_shingles long, chars long, s1 long, s2 long, sig binary"


def chunks_for(percent: int) -> int:
    """Chunks of a signature, CHUNKS at least, with which a pair of that similarity shares no key with a chance of KEY_MISS at most."""
    wide, p = SYMBOLS // CHUNKS, percent / 100
    fails = sum(comb(wide, k) * (1 - p) ** k * p ** (wide - k) for k in range(ERRORS + 1, wide + 1))
    chunks = CHUNKS
    while fails**chunks > KEY_MISS and chunks < 64:
        chunks += 1
    return chunks


def lanes_least(percent: int) -> int:
    """Lanes that must agree, LANES_LEAST at most, so that a pair of that similarity is passed over with a chance of LANE_MISS at most."""
    p = percent / 100 + (1 - percent / 100) / 256
    below, k = 0.0, 0
    while k < LANES_LEAST:
        below += comb(LANES, k) * p**k * (1 - p) ** (LANES - k)
        if below > LANE_MISS:
            break
        k += 1
    return k


def _signatures(n: int, symbols: int = SYMBOLS):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = tk.encode(batch["text"])
            for a, b in tk.slices(raw, 1 << 20):
                values, at = tk.shingle_sets(raw[a:b], n)
                size = np.diff(at)
                sig = (tk.min_hashes(values, at, symbols) & np.uint64((1 << B_BITS) - 1)).astype(np.uint16)
                s1, s2 = (np.zeros(b - a, dtype=np.uint64) for _ in range(2))
                full = np.flatnonzero(size)
                if len(full):
                    s1[full] = np.add.reduceat(values, at[:-1][full])
                    s2[full] = np.add.reduceat(tk.mix(values ^ np.uint64(0x5BD1E995)), at[:-1][full])
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[a:b].to_numpy(), "n_shingles": size, "chars": [len(r) for r in raw[a:b]],
                    "s1": s1.view(np.int64), "s2": s2.view(np.int64), "sig": [x.tobytes() for x in sig],
                })

    return run


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    """For each row of symbols, the keys of all chunks and error positions."""
    wide = SYMBOLS // CHUNKS
    out, tag = [], 0
    for c in range(sig.shape[1] // wide):
        for kept in combinations(range(wide), wide - ERRORS):
            tag += 1
            key = np.full(len(sig), tag, dtype=np.uint64)
            for k in kept:
                key = tk.mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, c * wide + k])
            out.append(key)
    return np.stack(out, axis=1)


def _buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            sig = np.frombuffer(b"".join(batch["sig"]), dtype=np.uint16).reshape(len(batch), -1).astype(np.uint64)
            keys = bucket_keys(sig)
            yield pd.DataFrame({"key": keys.ravel().view(np.int64), "rep": np.repeat(batch["rep"].to_numpy(), keys.shape[1])})


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def link_within(raw: list[bytes], known: np.ndarray, percent: int, n: int, across: np.ndarray | None = None) -> list[int]:
    """For each text, the smallest index that links of these texts connect it with.

    known has a label per text; texts with equal labels count as connected. With
    across (0 or 1 per text) pairs of texts that both have 0 aren't compared.
    """
    parent = list(range(len(raw)))
    first: dict[int, int] = {}
    for i, label in enumerate(known.tolist()):
        parent[i] = first.setdefault(label, i)
    parts = [tk.shingle_sets(raw[a:b], n) for a, b in tk.slices(raw)]
    sets = [v[o[i] : o[i + 1]] for v, o in parts for i in range(len(o) - 1)]
    lanes = np.concatenate([tk.min_hashes(v, o, LANES, seed=2).astype(np.uint8) for v, o in parts]) if parts else np.zeros((0, LANES), np.uint8)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    lanes, ranked, least = lanes[order], sizes[order], lanes_least(percent)
    for x in range(len(order)):
        i = int(order[x])
        if not sizes[i]:
            continue
        hi = int(np.searchsorted(ranked, sizes[i] * 100 // percent, side="right"))  # larger sets can't reach the similarity
        if hi <= x + 1:
            continue
        alike = (lanes[x + 1 : hi] == lanes[x]).sum(axis=1)
        near = np.flatnonzero(alike >= least)
        for y in near[np.argsort(-alike[near], kind="stable")].tolist():
            j = int(order[x + 1 + y])
            if across is not None and not (across[i] or across[j]):
                continue
            a, b = _find(parent, i), _find(parent, j)
            if a != b:
                both = _shared(sets[i], sets[j])
                if 100 * both >= percent * (int(sizes[i]) + int(sizes[j]) - both):
                    parent[max(a, b)] = min(a, b)
    return [_find(parent, i) for i in range(len(raw))]


def _compare(percent: int, n: int, across: bool = False):
    """Rows of one task: links (a, b) that connect what its texts connect, one fewer than texts at most."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for _, part in rows.groupby("part", sort=False):
            part = part.drop_duplicates("rep").sort_values("rep")
            if len(part) > 1:
                ids = part["rep"].tolist()
                tops = link_within(tk.encode(part["text"]), part["known"].to_numpy(), percent, n, part["side"].to_numpy() if across else None)
                found += [(ids[t], i) for t, i in zip(tops, ids) if ids[t] != i]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return run


def near_dedup(docs: DataFrame, percent: int = 85, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. A document's set
    holds its distinct n-word shingles; with fewer words, the whole sequence as
    one. Documents with 100 * shared >= percent * united are linked, and
    component_id is the smallest id that links reach. Null, empty and blank
    texts have the empty set and are linked with nothing. Repeated rows of an
    id must have one text; they give repeated rows. Rows with a null id are
    left out, because a component is named by an id. An empty table gives an
    empty result; other columns are ignored.

    Equal sets are one class from the start, so copies never meet in a task.
    Classes are cut into tasks of at most BLOCK_DOCS texts; in a part with more
    blocks, all are first compared with one block, and after that only pairs
    outside the part's largest connected group.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "minhash")
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    sigs = work.save(texts.mapInPandas(_signatures(n, SYMBOLS // CHUNKS * chunks_for(percent)), SIGNATURE_SCHEMA), "signatures")

    full = sigs.where("n_shingles > 0")
    classes = work.save(full.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min("chars").alias("chars"), F.first("sig").alias("sig")), "classes")

    keys = work.save(classes.select("rep", "sig").mapInPandas(_buckets, "key long, rep long"), "keys")
    leaders = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = keys.join(leaders, "key").where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    candidates = work.save(connected_components(stars, work, "candidates"), "candidate-parts")
    work.drop("keys")

    sized = candidates.join(classes.select(F.col("rep").alias("node"), "chars"), "node")
    parts = sized.groupBy("component").agg(F.count("*").alias("docs"), F.sum("chars").alias("total"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_CHARS)).cast("int")
    parts = work.save(parts.select("component", "docs", blocks.alias("blocks"), "total"), "parts")
    small, large = parts.where("blocks = 1"), parts.where("blocks > 1")

    # Parts that fit are packed into tasks of some megabytes.
    total = small.agg(F.sum("total")).first()[0] or 0
    bins = max(1, min(100_000, -(-total // (BLOCK_CHARS // 8))))
    member = work.save(candidates.join(parts, "component").select(F.col("node").alias("rep"), F.col("component").alias("part"), "blocks"), "members")
    ids = bounded(member.select(F.col("rep").alias("doc_id")))
    wanted = work.save(texts.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    placed = wanted.withColumnRenamed("doc_id", "rep").join(member, "rep").withColumn("known", F.col("rep"))
    packed = placed.where("blocks = 1").withColumn("bin", F.pmod(F.xxhash64("part"), F.lit(bins)))
    fields = ["rep", "part", "known", "text"]
    found = work.save(packed.groupBy("bin").applyInPandas(_without_bin(_compare(percent, n)), "a long, b long"), "found")

    if large.limit(1).count():
        found = _large_parts(placed.where("blocks > 1"), fields, found, work, percent, n)
    work.drop("texts")
    linked = connected_components(found, work, "links")
    labels = linked.select(F.col("node").alias("rep"), F.col("component").alias("top"))

    # Every class gets its label; only classes that have copies or links are handed back to rows.
    named = classes.join(labels, "rep", "left").withColumn("top", F.coalesce("top", "rep")).where("copies > 1 OR top <> rep")
    named = work.save(named.select("s1", "s2", "n_shingles", "copies", "top"), "named")
    rows = sigs.select("doc_id", "n_shingles", "s1", "s2")
    top = F.coalesce("top", "doc_id")
    return hot_join(rows, named, ["s1", "s2", "n_shingles"], "copies", rows.count(), "left").select(F.col("doc_id").alias(id_col), "n_shingles", top.alias("component_id"), (top == F.col("doc_id")).alias("kept"))


def _without_bin(run):
    return lambda rows: run(rows.assign(side=0))


def _large_parts(placed: DataFrame, fields: list[str], found: DataFrame, work: Workspace, percent: int, n: int) -> DataFrame:
    """Links of parts of several blocks: all blocks against block 0, then what lies outside the largest group."""
    placed = placed.withColumn("block", F.pmod(F.xxhash64(F.lit(7), F.col("rep")), F.col("blocks")).cast("int"))
    to_all = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = placed.withColumn("task", F.explode(to_all)).withColumn("side", F.lit(1))
    one = work.save(first.groupBy("part", "task").applyInPandas(_compare(percent, n), "a long, b long"), "first-links")
    top = connected_components(one, work, "first").select(F.col("node").alias("rep"), F.col("component").alias("top"))
    now = placed.join(top, "rep", "left").withColumn("top", F.coalesce("top", "rep"))
    counted = now.groupBy("part", "top").agg(F.count("*").alias("n"))
    main = counted.groupBy("part").agg(F.max_by("top", F.struct("n", -F.col("top"))).alias("main"), F.sum("n").alias("docs"), F.max("n").alias("most"))
    main = main.where("docs > most").select("part", "main", F.ceil((F.col("docs") - F.col("most")) / BLOCK_DOCS).cast("int").alias("outer"))
    now = now.join(main, "part").withColumn("side", (F.col("top") != F.col("main")).cast("int")).withColumn("known", F.col("top"))
    # Tasks (u, v): block u of the rows outside the largest group, against itself, a later such block, or a block of that group.
    u = F.pmod(F.xxhash64(F.lit(11), F.col("rep")), F.col("outer")).cast("int")
    outer = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("outer") - 1), lambda v: F.struct(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))),
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda v: F.struct(u.alias("u"), (-1 - v).alias("v"))),
    )
    inner = F.transform(F.sequence(F.lit(0), F.col("outer") - 1), lambda v: F.struct(v.alias("u"), (-1 - F.col("block")).alias("v")))
    tasks = now.withColumn("at", F.explode(F.when(F.col("side") == 1, outer).otherwise(inner)))
    two = tasks.groupBy("part", "at").applyInPandas(_compare(percent, n, across=True), "a long, b long")
    return found.union(one).union(work.save(two, "second-links"))


def drop_near_copies(docs: DataFrame, percent: int = 85, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose document stays (the smallest id of each component), with all their columns; rows with a null id stay."""
    work = Workspace(docs.sparkSession, "minhash-rows")
    gone = work.save(near_dedup(docs, percent, n, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("__id")), "gone")
    gone = bounded(gone)
    return docs.join(gone, docs[id_col].cast("long") == gone["__id"], "left_anti")
