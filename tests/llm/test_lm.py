import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.llm import lm

from .helpers import odd_docs, words


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def column():
    return F.crc32(F.col("doc_id").cast("string")) % 5


def model(rows):
    """Counts in plain Python, and the weights learned as the docstring says, from single tokens."""
    seqs = {i: [*words(t), "</s>"] for i, t in rows}

    def count(use):
        one, two = Counter(), Counter()
        for i, s in seqs.items():
            if use(fold(i)):
                one.update(s)
                two.update(zip(["</s>", *s[:-1]], s))
        return one, two

    return seqs, count(lambda f: f != 1), count(lambda f: f not in (1, 2))


@pytest.mark.parametrize("group", [2_000_000, 50])
def test_counts_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(lm, "GROUP_KEYS", group)
    monkeypatch.setattr(lm, "BATCH_BYTES", 3000)
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["the", "The", "of", f"w{int(r.expovariate(0.05))}"]) for _ in range(r.randrange(0, 60)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in lm.score(df, column()).collect()}
    seqs, (one, two), (one_fit, two_fit) = model(rows)
    n, v, n_fit = sum(one.values()), len(one), sum(one_fit.values())
    bucket, p2, p1 = [], [], []
    for i, s in seqs.items():
        if fold(i) == 2:
            for u, w in zip(["</s>", *s[:-1]], s):
                bucket.append(one_fit[u].bit_length())
                p2.append(two_fit[u, w] / max(one_fit[u], 1))
                p1.append(one_fit[w] / n_fit)
    weights = lm.learn_weights(np.array(bucket), np.ones(len(bucket)), np.array(p2), np.array(p1), 1 / (v + 1))
    for i, s in seqs.items():
        x = got[i]
        assert (x.n_tokens, x.n_known, x.train_tokens, x.held_out) == (len(s), sum(one[t] > 0 for t in s), n, fold(i) == 1)
        assert x.base_score == pytest.approx(sum(math.log10((one[t] + 0.5) / (n + 0.5 * (v + 1))) for t in s))
        want = 0.0
        for u, w in zip(["</s>", *s[:-1]], s):
            a, b, c = weights[one[u].bit_length()]
            want += math.log10(a * two[u, w] / max(one[u], 1) + b * one[w] / n + c / (v + 1))
        assert x.score == pytest.approx(want, rel=0.02)  # EM runs on cells of like estimates


def test_probabilities_of_a_context_sum_to_one():
    weights = lm.learn_weights(np.array([0, 1, 3] * 50), np.ones(150), np.tile([0, 0.5, 0.2], 50), np.full(150, 0.1), 0.01)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0 and (weights >= 0).all()


def test_em_climbs_to_the_best_weights():
    r = np.random.default_rng(0)
    p2, p1, n = r.random(400), r.random(400) * 0.3, np.ones(400)
    w = lm.learn_weights(np.full(400, 2), n, p2, p1, 0.001, rounds=500)[2]
    like = lambda w: np.log(w[0] * p2 + w[1] * p1 + w[2] * 0.001).sum()
    for a in np.linspace(0, 1, 21):
        for b in np.linspace(0, 1 - a, 21):
            assert like(w) >= like(np.array([a, b, 1 - a - b]) + 1e-12) - 1e-3


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = lm.score(docs, column()).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[None].held_out and by[3].n_tokens == by[4].n_tokens == by[5].n_tokens == 1 and by[6].n_tokens == 120_001
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm.score(docs.limit(0), column()).count() == 0
    alone = lm.score(spark.createDataFrame([(None, "a b")], "doc_id long, text string"), column()).collect()
    assert alone[0].train_tokens == 0 and alone[0].base_score == 0


def test_packing():
    for values in (np.zeros(0), np.array([0, 1, 255, 1 << 40]), np.arange(1000)):
        assert (lm._unpack(lm._pack(values.astype(np.uint64))) == values.astype(np.uint64)).all()


def test_large_ids_beside_a_null_id(spark):
    ids = [2**60 + 1, 2**53 + 1, None, -(2**61) - 1]
    docs = spark.createDataFrame([(i, "a b c") for i in ids], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in lm.score(docs, column()).collect()} == set(ids)
