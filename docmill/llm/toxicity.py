"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of
the words in it, a document's score the noisy-or of its sentences' scores:
1 - prod(1 - p). Only documents carry labels; the word weights follow from the
gradient of the documents' log loss, and the sentences that make a document
score high can then be located.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from . import textkernel as tk
from .workspace import Workspace, bounded, small_batches

#: The model is fitted on at most so many labelled documents and characters, those with the smallest hashed ids.
FIT_DOCS, FIT_CHARS = 6000, 24_000_000
#: Besides the words, their first so many bytes are features, for words of one stem.
HEADS = (4, 5, 6)
FIT_SLICE, SCORE_SLICE = 1 << 18, 1 << 20
LEAST_SENTENCES, LIFT, STEPS, RATE, DECAY, SPARSITY = 4, 1.5, 400, 0.1, 2e-5, 5e-6

_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".!?\n")] = True
_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = False


def sentences(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of each sentence: its words and their heads.

    Returns feature hashes (a row for each word), the sentence of each word, the
    text of each sentence, and each sentence's first byte in its text. Words are runs of letters,
    digits and bytes over 127, A-Z lower-cased; sentences end at . ! ? and line
    ends. Sentences without words don't count.
    """
    data, offsets = tk.join_bytes(raw)
    starts, ends = tk.word_runs(data, _OUTSIDE)
    # A break before a word, or the start of a text, begins a sentence.
    cuts = np.union1d(np.flatnonzero(_BREAK[data]), offsets[:-1] - 1)
    group = np.searchsorted(cuts, starts)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = group[1:] != group[:-1]
    sentence = np.cumsum(fresh) - 1
    hashes = tk.hash_runs(tk._LOWER[data], starts, ends, HEADS)
    for k in range(1, 1 + len(HEADS)):
        hashes[:, k] ^= np.uint64(k)
    begins = starts[fresh]
    owner = np.searchsorted(offsets, begins, side="right") - 1
    return hashes, sentence, owner, begins - offsets[owner]


def distinct(values: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once per sentence."""
    order = np.lexsort((values, sentence))
    values, sentence = values[order], sentence[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (sentence[1:] != sentence[:-1])
    return values[keep], sentence[keep]


def known(vocabulary: np.ndarray, hashes: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the vocabulary of the features of each sentence, once each, and their sentences."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = hashes.ravel()
    at = np.minimum(np.searchsorted(vocabulary, flat), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[at] == flat)
    return distinct(at[hit], sentence[hit // hashes.shape[1]])


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted word hashes
    weights: np.ndarray
    bias: float

    def logits(self, hashes: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        at, own = known(self.vocabulary, hashes, sentence)
        return self.bias + np.bincount(own, self.weights[at], minlength=n)


def _soft(z: np.ndarray) -> np.ndarray:
    """log(1 + exp(z)), that is -log(1 - p) for p = sigmoid(z)."""
    return np.logaddexp(0.0, z)


def fit(raw: list[bytes], labels: np.ndarray) -> Model:
    """Word weights and bias by Adam with a soft threshold.

    Words in fewer than LEAST_SENTENCES sentences or 2 toxic documents, and
    those not LIFT times as frequent in toxic documents as documents are toxic
    on average, get no weight.
    """
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(0, np.uint64), np.zeros(0), 20.0 if len(labels) and labels.min() > 0 else -20.0)
    labels = (labels > 0).astype(np.int64)
    # First what each word is found in, slice by slice; then only the words that matter are kept.
    table = np.zeros((0, 4), dtype=np.uint64)  # word, sentences, documents, toxic documents
    for a, b in tk.slices(raw, FIT_SLICE):
        hashes, sentence, owner, _ = sentences(raw[a:b])
        hashes, sentence = distinct(hashes.ravel(), np.repeat(sentence, hashes.shape[1]))
        words, at, count = np.unique(hashes, return_inverse=True, return_counts=True)
        pairs = np.unique(at * np.int64(b - a) + owner[sentence])
        own, doc = pairs // (b - a), pairs % (b - a)
        found = (words, count, np.bincount(own, minlength=len(words)), np.bincount(own, labels[a:b][doc], minlength=len(words)))
        fresh = np.stack([x.astype(np.uint64) for x in found], axis=1)
        table = np.concatenate([table, fresh])
        table = table[np.argsort(table[:, 0], kind="stable")]
        new = np.ones(len(table), dtype=bool)
        new[1:] = table[1:, 0] != table[:-1, 0]
        merged = np.add.reduceat(table[:, 1:], np.flatnonzero(new), axis=0) if len(table) else table[:, 1:]
        table = np.column_stack([table[new, 0], merged])
    _, count, seen, toxic = (table[:, k].astype(np.int64) for k in range(4))
    # Words that toxic documents don't have clearly more often than others are no evidence of a toxic sentence.
    vocabulary = table[(count >= LEAST_SENTENCES) & (toxic >= 2) & (toxic >= LIFT * seen * labels.mean()), 0]
    del table
    rows, cols, owners, base = [], [], [], 0
    for a, b in tk.slices(raw, FIT_SLICE):
        hashes, sentence, owner, _ = sentences(raw[a:b])
        at, own = known(vocabulary, hashes, sentence)
        rows.append((own + base).astype(np.int32))
        cols.append(at.astype(np.int32))
        owners.append(owner + a)
        base += len(owner)
    row, col, owner = (np.concatenate([[], *x], dtype=np.int64, casting="unsafe") for x in (rows, cols, owners))
    del rows, cols, owners
    y = labels.astype(float)
    n, v = len(owner), len(vocabulary)
    x = np.zeros(v + 1)
    x[v] = -6.0
    m1, m2 = np.zeros(v + 1), np.zeros(v + 1)
    for step in range(1, STEPS + 1):
        z = x[v] + np.bincount(row, x[col], minlength=n)
        p = 1 / (1 + np.exp(-z))
        none = np.bincount(owner, _soft(z), minlength=len(y))  # -log of the chance that no sentence is toxic
        pull = np.where(y > 0, -np.exp(-none) / np.maximum(-np.expm1(-none), 1e-9), 1.0)
        dz = p * pull[owner]
        g = np.append(np.bincount(col, dz[row], minlength=v), dz.sum()) / len(y)
        g[:v] += DECAY * x[:v]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        rate = RATE * min(1.0, 3 * (1 - step / (STEPS + 1)))
        scale = np.sqrt(m2 / (1 - 0.999**step)) + 1e-8
        x -= rate * (m1 / (1 - 0.9**step)) / scale
        x[:v] = np.sign(x[:v]) * np.maximum(np.abs(x[:v]) - rate * SPARSITY / scale[:v], 0)
    used = np.flatnonzero(np.abs(x[:v]) > 1e-3)
    return Model(vocabulary[used], x[used], float(x[v]))


def _trim() -> None:
    """Give what this process has freed back to the machine; glibc keeps it otherwise, and other C libraries have no such call."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows of docs for which ``usable`` (over the id) holds.

    Of more than FIT_DOCS documents, those with the smallest hashed ids are
    taken. Texts of over FIT_CHARS characters are none of them, and a text that
    doesn't fit in what is left of FIT_CHARS is passed over for the next. Where
    there are labelled texts and none fits, ValueError is raised. Rows with a null id, text or label don't
    count, and of an id with several labels the largest counts, of one with several
    texts the shortest (of equally long ones the smallest).
    """
    told = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    if usable is not None:
        told = told.where(usable)
    told = told.groupBy("doc_id").agg(F.max("label").alias("label"))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    sizes = own.select("doc_id", F.length("text").alias("size")).join(told, "doc_id").groupBy("doc_id", "label").agg(F.min("size").alias("size"))
    head = sizes.where(F.col("size") <= FIT_CHARS).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS).collect()
    total, chosen = 0, {}
    for r in head:
        if total + r["size"] <= FIT_CHARS:
            total += r["size"]
            chosen[r["doc_id"]] = (r["size"], r["label"])
    if not chosen:
        if sizes.limit(1).count():
            raise ValueError(f"every labelled text has over {FIT_CHARS} characters; none can be learnt from")
        return Model(np.zeros(0, np.uint64), np.zeros(0), -20.0)
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i, size) for i, (size, _) in chosen.items()], "doc_id long, size int")
    # One text per id reaches the driver, so FIT_CHARS holds however often an id repeats.
    rows = own.withColumn("size", F.length("text")).join(F.broadcast(ids), ["doc_id", "size"]).groupBy("doc_id").agg(F.min("text").alias("text"))
    # Partition by partition, and held as bytes only: a driver keeps what its process has once taken.
    raw = {r["doc_id"]: r["text"].encode("utf-8", "replace") for r in rows.toLocalIterator()}
    order = sorted(raw)
    model = fit([raw.pop(i) for i in order], np.array([chosen[i][1] for i in order]))
    _trim()
    return model


SPAN = "array<struct<start:int,end:int,score:double,text:string>>"


def _score(model, spans: bool, least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: Model = model.value
        for batch in batches:
            raw = tk.encode(batch["text"])
            for a, b in tk.slices(raw, SCORE_SLICE):
                part = raw[a:b]
                hashes, sentence, owner, begin = sentences(part)
                z = m.logits(hashes, sentence, len(owner))
                score = -np.expm1(-np.bincount(owner, _soft(z), minlength=b - a))
                out = pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].to_numpy(), "score": score, "n_sentences": np.bincount(owner, minlength=b - a)})
                if spans:
                    found: list[list[dict]] = [[] for _ in part]
                    p = 1 / (1 + np.exp(-z))
                    for k in np.flatnonzero(p >= least).tolist():
                        i = int(owner[k])
                        end = int(begin[k + 1]) if k + 1 < len(owner) and owner[k + 1] == i else len(part[i])
                        cut = part[i][int(begin[k]) : end].decode("utf-8", "replace").rstrip()
                        start = len(part[i][: int(begin[k])].decode("utf-8", "replace"))
                        found[i].append({"start": start, "end": start + len(cut), "score": float(p[k]), "text": cut})
                    out["spans"] = found
                yield out

    return run


def score(docs: DataFrame, model: Model, spans: bool = False, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, score (0 to 1), n_sentences, and with spans the sentences that score ``least`` or more.

    A span has the sentence's first and last character and its text. Null,
    empty and word-less texts have no sentence and score 0. Null ids, repeated
    rows and other columns are allowed; an empty table gives an empty result.
    Texts of any length are scored whole.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # Ids cross as text: pandas would hold whole numbers among nulls as floats.
    schema = "doc_id string, score double, n_sentences long" + (f", spans {SPAN}" if spans else "")
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(_score(sent, spans, least), schema).withColumn("doc_id", F.col("doc_id").cast("long")).withColumnRenamed("doc_id", id_col)


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that score below ``least``, with all their columns.

    A row is judged by its text, found again by a 64-bit hash; null and repeated ids make no difference.
    """
    work = Workspace(docs.sparkSession, "toxicity")
    model = learn(docs, labels, fold("doc_id") != 0, id_col, text_col)
    texts = docs.select(F.xxhash64(text_col).alias("doc_id"), F.col(text_col).alias("text"))
    gone = bounded(work.save(score(texts, model).where(F.col("score") >= least).select(F.col("doc_id").alias("__text")).distinct(), "gone"))
    return docs.join(gone, F.xxhash64(docs[text_col]) == gone["__text"], "left_anti")
