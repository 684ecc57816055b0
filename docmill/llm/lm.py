"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

P(v | u) = a * c(u v) / c(u) + b * c(v) / N + c / (V + 1), where the weights
(a, b, c) belong to the bucket of the context's frequency c(u). They are learned
by expectation-maximisation on a held-out part of the training documents, with
counts that leave that part out. Scores use the counts of all training
documents.

Counting is exact and nothing of the corpus is held by one process. Texts are
packed into batches. A batch sends the sorted distinct n-gram hashes it needs,
each with its own count, to the task that owns their hash range; that task adds
up all batches and answers each with the totals, in the order asked. So every
n-gram crosses the network once per batch, in some five bytes, and a frequent
n-gram is no heavier than a rare one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from .workspace import Workspace, small_batches

#: Bytes of text in a batch, and n-gram hashes that one counting task holds, about.
BATCH_BYTES, GROUP_KEYS = 4 << 20, 2_000_000
#: Bits of the hashes of words and of word pairs.
KEY_BITS = (64, 56)
EM_ROUNDS = 60
END = np.uint64(0x454E44)
_STEP = 4  # cells of the statistics for EM, per factor of two

# Ids cross as text: pandas would hold whole numbers among nulls as floats.
BATCH_SCHEMA = "batch long, ids array<string>, folds array<int>, sizes array<long>, text binary, tokens long, train_tokens long, dev_tokens long"


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed; small and regular values take little."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return _squeeze(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, n = TaskContext.get().partitionId(), 0
    for frame in batches:
        raw = tk.encode(frame["text"])
        folds = frame["fold"].fillna(-1).astype(int).to_numpy()
        ids = [None if pd.isna(i) else i for i in frame["doc_id"]]
        for a, b in tk.slices(raw, BATCH_BYTES):
            count = tk.word_counts(raw[a:b]) + 1
            train, dev = folds[a:b] >= 2, folds[a:b] == 3
            yield pd.DataFrame({
                "batch": [(part << 24) + n], "ids": [ids[a:b]], "folds": [folds[a:b].tolist()], "sizes": [[len(r) for r in raw[a:b]]],
                "text": [_squeeze(b"".join(raw[a:b]))], "tokens": [int(count.sum())], "train_tokens": [int(count[train].sum())], "dev_tokens": [int(count[dev].sum())],
            })
            n += 1


def _split(text: bytes, sizes: list[int]) -> list[bytes]:
    at, data, out = 0, zstandard.ZstdDecompressor().decompress(text) if text else b"", []
    for s in sizes:
        out.append(data[at : at + s])
        at += s
    return out


class Tokens:
    """Tokens of a batch: word hashes with an end after each text; a text's first token follows an end."""

    def __init__(self, text: bytes, sizes: list[int]):
        w, at = tk.words(_split(text, sizes))
        n = np.diff(at) + 1
        self.first = np.concatenate([[0], np.cumsum(n)])  # of each text
        self.seq = np.full(1 + int(n.sum()), END, dtype=np.uint64)  # one end before all
        inner = np.ones(len(self.seq), dtype=bool)
        inner[0] = False
        inner[self.first[1:]] = False
        self.seq[inner] = w
        self.owner = np.repeat(np.arange(len(n)), n)

    def keys(self, order: int) -> np.ndarray:
        """The n-gram hash that ends at each token."""
        if order == 1:
            return self.seq[1:]
        return tk.ngram_hashes(self.seq, 2) >> np.uint64(64 - KEY_BITS[1])


def _distinct(keys: np.ndarray) -> np.ndarray:
    s = np.sort(keys)
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = s[1:] != s[:-1]
    return s[keep]


REQUEST_SCHEMA = "ngram int, part int, batch long, keys binary, train binary, dev binary"
REPLY_SCHEMA = "ngram int, part int, batch long, train binary, dev binary, known long"


def _requests(bits: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                t = Tokens(row.text, list(row.sizes))
                folds = np.asarray(row.folds)[t.owner]
                for order in (1, 2):
                    keys, at = np.unique(t.keys(order), return_inverse=True)
                    train = np.bincount(at, folds >= 2, minlength=len(keys))
                    dev = np.bincount(at, folds == 3, minlength=len(keys))
                    part = (keys >> np.uint64(KEY_BITS[order - 1] - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(keys)]])
                    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                    yield pd.DataFrame({
                        "ngram": order, "part": [int(part[a]) for a, _ in spans], "batch": row.batch,
                        "keys": [_pack(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in spans],
                        "train": [_pack(train[a:b]) for a, b in spans], "dev": [_pack(dev[a:b]) for a, b in spans],
                    })

    return run


def _totals(rows: pd.DataFrame) -> pd.DataFrame:
    """The answer to each request of one hash range, and (as batch -1) how many of its n-grams training texts have."""
    keys = [np.cumsum(_unpack(k), dtype=np.uint64) for k in rows["keys"]]
    cuts = np.cumsum([0, *map(len, keys)])
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    train = np.bincount(at, np.concatenate([_unpack(x) for x in rows["train"]]), minlength=len(distinct)).astype(np.uint64)
    dev = np.bincount(at, np.concatenate([_unpack(x) for x in rows["dev"]]), minlength=len(distinct)).astype(np.uint64)
    spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    out = pd.DataFrame({
        "ngram": rows["ngram"], "part": rows["part"], "batch": rows["batch"], "train": [_pack(train[at[a:b]]) for a, b in spans],
        "dev": [_pack(dev[at[a:b]]) for a, b in spans], "known": 0,
    })
    total = out.iloc[:1].assign(batch=-1, train=b"", dev=b"", known=int((train > 0).sum()))
    return pd.concat([out, total])


def _answers(row, order: int, which: str) -> np.ndarray:
    parts = sorted((r for r in row.replies if r["ngram"] == order), key=lambda r: r["part"])
    return np.concatenate([_unpack(r[which]) for r in parts]).astype(np.int64)


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for 0, then one bucket per factor of two."""
    return np.frexp(count.astype(float))[1].astype(np.int64)


def _cells(n: int, v: int):
    """Statistics of held-out tokens under the counts without them: cells of like estimates, with their mean."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                t = Tokens(row.text, list(row.sizes))
                pick = np.flatnonzero((np.asarray(row.folds) == 3)[t.owner])
                if not len(pick):
                    continue
                one, two = t.keys(1), t.keys(2)
                u1, u2 = _distinct(one), _distinct(two)
                c1 = _answers(row, 1, "train") - _answers(row, 1, "dev")
                c2 = _answers(row, 2, "train") - _answers(row, 2, "dev")
                if len(c1) != len(u1) or len(c2) != len(u2):
                    raise RuntimeError("the answers don't fit the batch")
                of_end = c1[np.searchsorted(u1, END)]
                here = c1[np.searchsorted(u1, one[pick])]
                before = np.where(pick > 0, c1[np.searchsorted(u1, t.seq[pick])], of_end)
                pair = c2[np.searchsorted(u2, two[pick])]
                p2 = pair / np.maximum(before, 1)
                p1 = here / max(n, 1)
                q = [np.where(p > 0, np.clip(np.floor(-_STEP * np.log2(np.maximum(p, 1e-300))), 0, 254), 255).astype(np.int64) for p in (p2, p1)]
                cell, at, count = np.unique((bucket_of(before) << 16) + (q[0] << 8) + q[1], return_inverse=True, return_counts=True)
                yield pd.DataFrame({"cell": cell, "n": count, "p2": np.bincount(at, p2), "p1": np.bincount(at, p1)})

    return run


def learn_weights(bucket: np.ndarray, n: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (bigram, unigram, uniform) for each of 65 buckets by EM; a bucket without held-out tokens takes those of all."""
    p = np.stack([p2, p1, np.full(len(p2), p0)], axis=1)

    def em(rows: np.ndarray) -> np.ndarray:
        w = np.array([0.5, 0.4, 0.1])
        if not n[rows].sum():
            return np.array([0.0, 0.0, 1.0])
        for _ in range(rounds):
            share = p[rows] * w
            share *= (n[rows] / share.sum(axis=1))[:, None]
            w = share.sum(axis=0) / n[rows].sum()
            # No estimate may be certain: texts to be scored have words that these have not.
            w = np.maximum(w, 1e-6)
            w /= w.sum()
        return w

    everything = em(np.arange(len(n)))
    weights = np.tile(everything, (65, 1))
    for b in range(65):
        rows = np.flatnonzero(bucket == b)
        if n[rows].sum() >= 50:
            weights[b] = em(rows)
    weights[0, 1:] += weights[0, 0] / 2  # an unseen context has no bigram estimate
    weights[0, 0] = 0.0
    return weights


def _score(n: int, v: int, weights: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                t = Tokens(row.text, list(row.sizes))
                u1, at1 = np.unique(t.keys(1), return_inverse=True)
                u2, at2 = np.unique(t.keys(2), return_inverse=True)
                c1, c2 = _answers(row, 1, "train"), _answers(row, 2, "train")
                if len(c1) != len(u1) or len(c2) != len(u2):
                    raise RuntimeError("the answers don't fit the batch")
                here = c1[at1]
                before = np.concatenate([[c1[np.searchsorted(u1, END)]], here[:-1]])
                w = weights[bucket_of(before)]
                p = w[:, 0] * c2[at2] / np.maximum(before, 1) + w[:, 1] * here / max(n, 1) + w[:, 2] / (v + 1)
                at = t.first[:-1]
                yield pd.DataFrame({
                    "doc_id": list(row.ids), "fold": row.folds, "n_tokens": np.diff(t.first),
                    "n_known": np.add.reduceat((here > 0).astype(np.int64), at), "base_score": np.add.reduceat(np.log10((here + 0.5) / (n + 0.5 * (v + 1))), at),
                    "score": np.add.reduceat(np.log10(p), at),
                })

    return run


SCORE_SCHEMA = "doc_id string, fold int, n_tokens long, n_known long, base_score double, score double"


def score(docs: DataFrame, fold: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    fold (over the id) is 1 for texts that nothing is learned from; of the
    others, those with 2 are the held-out part for EM. Tokens are the words
    `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, then one end. score is the
    model's log10 probability of the text. base_score adds up
    log10((c + 0.5) / (N + 0.5 * (V + 1))); n_known counts tokens with c > 0;
    train_tokens is N. Null and empty texts are one end. Rows with a null id
    are held out. Repeated rows each count; an empty table gives an empty
    result; other columns are ignored. Texts are read whole; a text is never
    cut into two batches.
    """
    work = Workspace(docs.sparkSession, "lm")
    small_batches(docs.sparkSession)
    # 0: no id, 1: held out, 2: training, 3: training whose tokens EM runs on.
    role = F.when(F.col(id_col).isNull(), 0).when(fold == 1, 1).when(fold == 2, 3).otherwise(2)
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"), role.cast("int").alias("fold"))
    batches = work.save(rows.mapInPandas(_batches, BATCH_SCHEMA), "batches")
    facts = batches.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "train_tokens", "dev_tokens")]).first()
    n = facts["train_tokens"]
    bits = max(0, (facts["tokens"] // GROUP_KEYS).bit_length())

    requests = batches.select("batch", "folds", "sizes", "text").mapInPandas(_requests(bits), REQUEST_SCHEMA)
    replies = work.save(requests.groupBy("ngram", "part").applyInPandas(_totals, REPLY_SCHEMA), "replies")
    v = replies.where("batch = -1 AND ngram = 1").agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    told = replies.where("batch >= 0").groupBy("batch").agg(F.collect_list(F.struct("ngram", "part", "train", "dev")).alias("replies"))
    joined = work.save(batches.select("batch", "ids", "folds", "sizes", "text").join(told, "batch"), "joined")
    work.drop("batches")
    work.drop("replies")

    cells = joined.select("folds", "sizes", "text", "replies").mapInPandas(_cells(n - facts["dev_tokens"], v), "cell long, n long, p2 double, p1 double")
    cells = cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "p2", "p1")]).toPandas().sort_values("cell")
    count = cells["n"].to_numpy(dtype=float)
    weights = learn_weights(cells["cell"].to_numpy(dtype=np.int64) >> 16, count, cells["p2"].to_numpy(dtype=float) / np.maximum(count, 1), cells["p1"].to_numpy(dtype=float) / np.maximum(count, 1), 1 / (v + 1))
    scored = joined.select("ids", "folds", "sizes", "text", "replies").mapInPandas(_score(n, v, weights), SCORE_SCHEMA)
    return scored.select(F.col("doc_id").cast("long").alias(id_col), F.col("fold").isin(0, 1).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
