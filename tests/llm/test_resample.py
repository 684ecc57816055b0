import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from docmill.llm import resample

from .helpers import odd_docs, prose


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, n):
    w = words(text)
    return [" ".join(w[i : i + k]) for i in range(len(w)) for k in range(1, n + 1) if i + k <= len(w)]


def brute(docs, target, n, buckets, percent, least, seed):
    crc = lambda f: zlib.crc32(f.encode()) % buckets
    own = [[crc(f) for f in runs(t, n)] for _, t in docs]
    s, t = Counter(b for x in own for b in x), Counter(crc(f) for x in target for f in runs(x, n))
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for (i, text), x in zip(docs, own):
        weight = sum(gain[b] for b in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[2], r[1]))
    for k, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = k
    return sorted((r[:5] for r in rows), key=repr)


def got(spark, docs, target, **how):
    d = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "doc_id long, text string")
    out = resample.resample(d, spark.createDataFrame([(t,) for t in target], "text string"), **how)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted(([r.doc_id, r.n_features, r.weight, r.score, r.rank] for r in out.collect()), key=repr)


@pytest.mark.parametrize("n, buckets, percent, least", [(1, 10_000, 10, 20), (2, 10_000, 50, 5), (3, 97, 100, 0), (4, 100_000, 33, 1)])
def test_against_brute_force(spark, n, buckets, percent, least):
    docs = [(i, " ".join(prose(i % 17, 5 + i % 40, 60))) for i in range(120)] + [(200, "Épée naïve, École-42 x_y\x00z 日本 語"), (201, "A B a b")]
    target = [" ".join(prose(k, 30, 40)) for k in range(5)] + [None, ""]
    assert got(spark, docs, target, n=n, buckets=buckets, percent=percent, least_words=least, seed=7) == brute(docs, target, n, buckets, percent, least, 7)


def test_states_are_the_hashes_of_runs():
    w = [b"ab", b"c", b"", b"de", b"f"]
    for n in (1, 2, 3, 6):
        want = [zlib.crc32(b" ".join(w[i - k : i + 1])) for i in range(len(w)) for k in range(n) if k <= i]
        assert list(resample.run_hashes(w, n)) == want


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for percent in (0, 40, 100):
        assert got(spark, docs, ["the lazy dog"], percent=percent, least_words=2) == brute(rows, ["the lazy dog"], 1, 10_000, percent, 2, 2024)


def test_ties_and_empty_tables(spark):
    docs = [(i, "same words here") for i in (5, 3, 3, 9)]
    out = got(spark, docs, [], percent=100, least_words=1)
    assert sorted(r[4] for r in out) == [1, 2, 3, 4] and {r[2] for r in out} == {out[0][2]}
    assert got(spark, docs, [], percent=50, least_words=1) == brute(docs, [], 1, 10_000, 50, 1, 2024)
    assert got(spark, [], ["x"]) == []


def test_bounds(spark):
    for how in ({"n": 0}, {"buckets": 0}):
        with pytest.raises(ValueError):
            got(spark, [], [], **how)
