import random

import pytest

from docmill.llm import minhash

from .helpers import components, odd_docs, prose, words


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in components(ids, links).items()}


def family(seed, copies, edits):
    r, base, out = random.Random(seed), prose(seed, 300), []
    for k in range(copies):
        w = list(base)
        for _ in range(r.randrange(edits)):
            w[r.randrange(len(w))] = f"x{seed}-{k}-{r.random()}"
        out.append(" ".join(w))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_dedup(df).collect()}
    assert got == brute(rows)


def test_against_brute_force(spark):
    texts = [t for s in range(12) for t in family(s, 12, 9)] + [" ".join(prose(1000 + i, 50)) for i in range(40)]
    texts += ["A b C", "a B c", "a b", "", None, " ", "one two three four five", "One two  three four FIVE", "one two three four five six"]
    random.Random(5).shuffle(texts)
    check(spark, [(100 + i, t) for i, t in enumerate(texts)])


@pytest.mark.parametrize("block", [3, 10])
def test_parts_of_several_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    texts = family(1, 40, 12) + family(2, 9, 6) + family(3, 30, 30)
    random.Random(6).shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_pipeline_drops_pairs_from_80_percent(spark):
    import corpus_pipeline

    rows = []
    for s in range(20):
        base = prose(s, 300, 10**6)
        edited = [f"x{s}" if k in range(20, 290, 45) else w for k, w in enumerate(base)]  # 6 words, 30 shingles
        rows += [(2 * s, " ".join(base)), (2 * s + 1, " ".join(edited))]
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 0.8 <= len(a & b) / len(a | b) < 0.85
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 40, 2))
    assert (minhash.chunks_for(85), minhash.lanes_least(85)) == (minhash.CHUNKS, minhash.LANES_LEAST)
    assert (minhash.chunks_for(80), minhash.lanes_least(80)) == (4, 35)


def test_pigeonhole():
    import numpy as np

    r = np.random.default_rng(0)
    a = r.integers(0, 1 << 16, (300, minhash.SYMBOLS)).astype(np.uint64)
    b = a.copy()
    reach = minhash.CHUNKS * (minhash.ERRORS + 1) - 1
    for row in b:
        at = r.permutation(minhash.SYMBOLS)[:reach]
        row[at] ^= np.uint64(1)
    assert (minhash.bucket_keys(a) == minhash.bucket_keys(b)).any(axis=1).all()


def test_odd_rows(spark):
    got = {}
    for r in minhash.near_dedup(odd_docs(spark)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert None not in got and len(got[6]) == 2
    assert got[2][0].component_id == 1 and not got[2][0].kept and got[1][0].kept
    assert all(got[i][0].n_shingles == 0 and got[i][0].kept for i in (3, 4, 5, 8))
    docs = odd_docs(spark)
    out = minhash.drop_near_copies(docs)
    assert out.columns == docs.columns and out.count() == docs.count() - 1
    assert minhash.near_dedup(docs.limit(0)).count() == 0
