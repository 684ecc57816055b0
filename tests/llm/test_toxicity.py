import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.llm import textkernel as tk
from docmill.llm import toxicity

from .helpers import CLASH, odd_docs, prose


def corpus(n, seed=0):
    r, rows = random.Random(seed), []
    for i in range(n):
        sents = [" ".join(prose(r.random(), 8, 400)) for _ in range(r.randrange(1, 9))]
        toxic = i % 4 == 0
        if toxic:
            k = r.randrange(len(sents))
            sents[k] = sents[k] + " " + r.choice(["vileword", "Nastyish", "nastying"])
        rows.append((i, ". ".join(sents) + ".", int(toxic)))
    return rows


def test_held_out_accuracy_and_place(spark):
    rows = corpus(1200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, toxicity.fold() != 0)
    truth = {i: (t, y) for i, t, y in rows}
    got = toxicity.score(docs, model, spans=True).join(docs.select("doc_id", toxicity.fold().alias("fold")), "doc_id").where("fold = 0").collect()
    assert len(got) > 150
    right = sum((r.score >= 0.5) == bool(truth[r.doc_id][1]) for r in got)
    assert right / len(got) > 0.97
    for r in got:
        for s in r.spans:
            text = truth[r.doc_id][0]
            assert text[s.start : s.end] == s.text
            if truth[r.doc_id][1]:
                assert "vileword" in s.text or "asty" in s.text


def test_a_text_beyond_the_bound_leaves_the_others(spark, monkeypatch):
    rows = corpus(200)
    big = "x " * 100_000
    where = {i: big if i % 9 == 0 else t for i, t, _ in rows}
    monkeypatch.setattr(toxicity, "FIT_CHARS", 190_000)
    docs = spark.createDataFrame(list(where.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda raw, y: taken.append(len(raw)))
    toxicity.learn(docs, labels)
    assert taken == [sum(t is not big for t in where.values())]
    with pytest.raises(ValueError):
        toxicity.learn(docs.where(F.length("text") > 190_000), labels)


def test_noisy_or_matches_its_definition():
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), -1.0)
    hashes, sentence, owner, begin = toxicity.sentences([b"One two. Three!\nFour", b"", b"... !"])
    assert owner.tolist() == [0, 0, 0] and begin.tolist() == [0, 9, 16]
    z = model.logits(hashes, sentence, len(owner))
    p = 1 / (1 + np.exp(-z))
    assert np.allclose(-np.expm1(-np.bincount(owner, toxicity._soft(z), minlength=3)), [1 - np.prod(1 - p), 0, 0])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")):
        model = toxicity.learn(docs, labels)
        out = toxicity.score(docs, model).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
        assert {r.score for r in out if r.doc_id in (3, 4, 5, 8)} == {0.0}
    kept = toxicity.drop_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert CLASH


def test_hash_is_the_same_for_any_batch():
    raw = tk.encode(["Ab  cd\te", None, "x" * 3_000_000 + " y", "ab CD e"])
    w, at = tk.words(raw)
    alone = [tk.words([r])[0] for r in raw]
    assert all((w[at[i] : at[i + 1]] == alone[i]).all() for i in range(4))
    assert (alone[0] == alone[3]).all() and len(alone[1]) == 0 and len(alone[2]) == 2


def test_large_ids_beside_a_null_id(spark):
    ids = [2**60 + 1, 2**53 + 1, None, -(2**61) - 1]
    docs = spark.createDataFrame([(i, "a b c") for i in ids], "doc_id long, text string").coalesce(1)
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), -1.0)
    assert {r.doc_id for r in toxicity.score(docs, model).collect()} == set(ids)


def test_null_and_repeated_ids_get_the_verdict_of_their_text(spark, monkeypatch):
    word = tk.hash_runs(np.frombuffer(b"vileword", np.uint8), np.array([0]), np.array([8]), toxicity.HEADS)[:, 0]
    monkeypatch.setattr(toxicity, "learn", lambda *a: toxicity.Model(word, np.array([20.0]), -10.0))
    docs = spark.createDataFrame([(None, "a vileword b"), (None, "a b"), (1, "vileword"), (1, "fine"), (2, None)], "doc_id long, text string")
    kept = toxicity.drop_toxic(docs, docs.limit(0))
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, [(None, "a b"), (1, "fine"), (2, None)]))


def test_one_text_of_a_repeated_id(spark, monkeypatch):
    rows = [(i, f"text {i}") for i in range(20)] + [(3, "longer text of three")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda raw, y: taken.append((raw, y.tolist())))
    toxicity.learn(docs, labels)
    assert taken == [([f"text {i}".encode() for i in range(20)], [i % 2 for i in range(20)])]


def plain_sentences(text):
    """Sets of features (k, bytes) of the sentences of a text that have words."""
    out = []
    for part in re.split(rb"[.!?\n]", (text or "").encode()):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", bytes(b + 32 if 65 <= b <= 90 else b for b in part))
        if words:
            out.append({(k, w[:h]) for w in words for k, h in enumerate((None, *toxicity.HEADS))})
    return out


def plain_fit(texts, labels):
    """The fit of word weights in plain Python: features that count, then the gradient of the documents' log loss under noisy-or."""
    docs = [plain_sentences(t) for t in texts]
    share = sum(labels) / len(labels)
    every = sorted({f for d in docs for s in d for f in s})
    in_sentences = {f: sum(f in s for d in docs for s in d) for f in every}
    seen = {f: [y for d, y in zip(docs, labels) if any(f in s for s in d)] for f in every}
    vocabulary = [f for f in every if in_sentences[f] >= toxicity.LEAST_SENTENCES and sum(seen[f]) >= 2 and sum(seen[f]) >= toxicity.LIFT * len(seen[f]) * share]
    x, bias = dict.fromkeys(vocabulary, 0.0), -6.0
    m1, m2 = dict.fromkeys([*vocabulary, None], 0.0), dict.fromkeys([*vocabulary, None], 0.0)
    for step in range(1, toxicity.STEPS + 1):
        g = dict.fromkeys([*vocabulary, None], 0.0)
        for d, y in zip(docs, labels):
            p = [1 / (1 + math.exp(-bias - sum(x[f] for f in s if f in x))) for s in d]
            clean = math.prod(1 - q for q in p)
            for s, q in zip(d, p):
                # d loss / d z: q where the document is clean, and -q * clean / (1 - clean) where it is toxic.
                dz = (q if not y else -q * clean / max(1 - clean, 1e-9)) / len(labels)
                g[None] += dz
                for f in s:
                    if f in x:
                        g[f] += dz
        rate = toxicity.RATE * min(1.0, 3 * (1 - step / (toxicity.STEPS + 1)))
        for f in g:
            g[f] += toxicity.DECAY * x[f] if f is not None else 0
            m1[f], m2[f] = 0.9 * m1[f] + 0.1 * g[f], 0.999 * m2[f] + 0.001 * g[f] ** 2
            scale = math.sqrt(m2[f] / (1 - 0.999**step)) + 1e-8
            move = rate * (m1[f] / (1 - 0.9**step)) / scale
            if f is None:
                bias -= move
            else:
                w = x[f] - move
                x[f] = math.copysign(max(abs(w) - rate * toxicity.SPARSITY / scale, 0), w)
    return {f: w for f, w in x.items() if abs(w) > 1e-3}, bias


def hash_of(feature):
    k, value = feature
    h = tk.hash_runs(np.frombuffer(value, np.uint8), np.array([0]), np.array([len(value)]))[0]
    return int(h ^ np.uint64(k))


def test_weights_and_scores_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 60)
    monkeypatch.setattr(toxicity, "FIT_SLICE", 500)  # many slices
    rows = corpus(80, seed=4) + [(80, "", 0), (81, "...!", 1), (82, "Ärger über NASTYISH word. Vileword!\nVileword again", 1)]
    texts, labels = [t for _, t, _ in rows], [y for *_, y in rows]
    model = toxicity.fit(tk.encode(texts), np.array(labels))
    weights, bias = plain_fit(texts, labels)
    assert weights and math.isclose(model.bias, bias, rel_tol=1e-6)
    got = dict(zip(model.vocabulary.tolist(), model.weights.tolist()))
    want = {hash_of(f): w for f, w in weights.items()}
    assert set(got) == set(want) and all(math.isclose(got[h], want[h], rel_tol=1e-5, abs_tol=1e-7) for h in want)

    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(90, None)], "doc_id long, text string")
    scored = {r.doc_id: r for r in toxicity.score(docs, model, spans=True, least=0.3).collect()}
    for i, t, _ in [*rows, (90, None, 0)]:
        own = plain_sentences(t)
        p = [1 / (1 + math.exp(-bias - sum(weights.get(f, 0.0) for f in s))) for s in own]
        assert math.isclose(scored[i].score, 1 - math.prod(1 - q for q in p), rel_tol=1e-6, abs_tol=1e-9)
        located = [q for q in p if q >= 0.3]
        assert scored[i].n_sentences == len(own) and len(located) == len(scored[i].spans)
        assert all(math.isclose(q, s.score, rel_tol=1e-6) for q, s in zip(located, scored[i].spans))


def resident():
    with open("/proc/self/smaps_rollup") as f:
        return sum(int(x.split()[1]) for x in f if x.startswith("Pss_Anon")) / 1024


def test_the_driver_keeps_nothing_of_the_fit(spark, monkeypatch):
    pinned = []

    def fit(raw, y):
        held = [bytes([k % 256]) * 4000 for k in range(30_000)]
        pinned.append(bytes([len(y)]) * 4000)  # lies behind what is freed
        del held
        return toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), -20.0)

    monkeypatch.setattr(toxicity, "fit", fit)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    before = resident()
    toxicity.learn(docs, labels)
    assert resident() - before < 40
