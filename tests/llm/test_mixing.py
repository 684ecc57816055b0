import itertools

import pytest
from pyspark.sql import functions as F

from docmill.llm import mixing

from .helpers import odd_docs


def rows_of(spark, n=400, sources=7):
    rows = [(i, " ".join(["w"] * (i * 7919 % 50)), None if i % 41 == 0 else f"s{i * i % sources}" if i % 3 else "hot") for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def filled(sizes, weights, total, most):
    """Targets by raising a common level until all is shared out."""
    lo, hi = 0.0, total + 1.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(mid * w, most * s) for s, w in zip(sizes, weights)) < total:
            lo = mid
        else:
            hi = mid
    return [min(hi * w, most * s) for s, w in zip(sizes, weights)]


def test_targets_against_a_water_level():
    for sizes in ([5, 100, 30, 0, 8], [1, 1, 1], [1000, 1], [0, 0]):
        weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        got = mixing.targets(sizes, weights, 1.5 * sum(sizes), 2)
        assert got == pytest.approx(filled(sizes, weights, 1.5 * sum(sizes), 2), abs=1e-6)


@pytest.mark.parametrize("bits", [0, 3, 12])
def test_mix_against_targets(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "BUCKET_BITS", bits)
    rows, df = rows_of(spark)
    out = mixing.flat(mixing.mix(df)).join(df, "doc_id").collect()
    assert len(out) == len(rows)
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in names]
    want = filled(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(sizes), 2)
    for n, size, target in zip(names, sizes, want):
        own = [r for r in out if r.source == n]
        assert {r.source_size for r in own} == {size} and own[0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in own) - target) <= 1
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    # One document of a source at most is taken in part.
    assert all(sum(bool(r.size) and r.taken % r.size > 0 for r in out if r.source == n) <= 1 for n in names)
    again = mixing.flat(mixing.mix(df.repartition(3))).join(df, "doc_id").collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in out}
    kept = {r.doc_id: r for r in mixing.take(df.withColumn("size", F.lit("x"))).collect()}
    assert {(i, r.taken, r.size, r.source_size, r.target, r.source) for i, r in kept.items()} == {(r.doc_id, r.taken, r.size, r.source_size, r.target, r.source) for r in out if r.taken}
    other = mixing.flat(mixing.mix(df, seed=1)).collect()
    assert {(r.doc_id, r.taken) for r in other} != {(r.doc_id, r.taken) for r in out}


def brute_flow(supply, members, quota, passes):
    """Least cost of a maximum flow, by trying every way to send whole units."""
    best = None
    ways = [[c for c in itertools.product(range(passes * s + 1), repeat=len(m)) if sum(c) <= passes * s] for s, m in zip(supply, members)]
    for pick in itertools.product(*ways):
        got = [0] * len(quota)
        for own, m in zip(pick, members):
            for x, s in zip(own, m):
                got[s] += x
        if all(g <= q for g, q in zip(got, quota)):
            cost = sum(max(0, sum(own) - r * s) * 1 for own, s in zip(pick, supply) for r in range(1, passes))
            score = (-sum(got), cost)
            best = score if best is None or score < best else best
    return best


@pytest.mark.parametrize("case", [([2, 1, 2], [[0], [0, 1], [1]], [3, 4]), ([3, 2], [[0, 1], [1]], [2, 5]), ([1, 1, 1], [[0, 1], [1, 2], [0, 2]], [2, 2, 1]), ([2], [[0]], [9])])
def test_flow_against_brute_force(case):
    supply, members, quota = case
    sent = mixing.min_cost_flow(supply, members, quota, 2)
    got = [sum(x.get(s, 0) for x in sent) for s in range(len(quota))]
    assert all(g <= q for g, q in zip(got, quota)) and all(set(x) <= set(m) for x, m in zip(sent, members))
    cost = sum(max(0, sum(x.values()) - s) for x, s in zip(sent, supply))
    assert (-sum(got), cost) == brute_flow(supply, members, quota, 2)


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, m) for i, m in enumerate([["a"], ["a", "b"], ["b"], ["b", "a", "a"], None, ["c"]] * 10)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source array<string>")).collect()
    want = {}
    for r in out:
        assert r.taken == sum(s.taken for s in r.shares) <= 2 * r.size
        for s in r.shares:
            got, _ = want.get(s.source, (0, 0))
            want[s.source] = (got + s.taken, s.target)
    assert all(abs(got - target) <= 1 for got, target in want.values())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = mixing.flat(mixing.mix(docs)).collect()
    assert len(out) == docs.count() and sum(r.size for r in out if r.doc_id in (3, 4, 5, 8)) == 0
    taken = mixing.take(docs)
    assert taken.where("doc_id = 6").select("size").distinct().collect()[0][0] == 120_000
    assert set(docs.columns) <= set(taken.columns) and taken.where("taken = 0").count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [0, 12])
def test_take_gives_each_row_what_mix_does(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "BUCKET_BITS", bits)
    rows = [(1, "a b c d e", "s"), (1, "a", "s"), (2, "x y z", "s"), (2, "x y z", "s"), (None, "p q", "s"), (None, "p q r s", "s"), (3, "k l m n", "t"), (3, "k l m n", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = sorted((r.doc_id or 0, r.size, r.taken) for r in mixing.flat(mixing.mix(docs)).collect() if r.taken)
    taken = mixing.take(docs).collect()
    assert sorted((r.doc_id or 0, r.size, r.taken) for r in taken) == mixed
    assert all(r.size == len(r.text.split()) and r.taken <= 2 * r.size for r in taken)
