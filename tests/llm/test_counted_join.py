import random
from collections import Counter, defaultdict

import pytest

from docmill.llm import counted_join, workspace


def side(spark, seed, keys, n, name):
    r = random.Random(seed)
    rows = [(r.choice(keys), r.choice([None, 1, 2, 5]), r.randrange(3)) for _ in range(n)]
    rows += r.choices(rows, k=n // 2) if rows else []
    return rows, spark.createDataFrame(rows, f"key long, {name} long, {name}_more long")


KEYS = [None, 0, 0, 0, 0, 1, 2, 3, 4]


def expected(left, right, how):
    out = []
    by = defaultdict(list)
    for r in right:
        by[r[0]].append(r)
    met = set()
    for l in left:
        mates = by[l[0]] if l[0] is not None else []
        met.update(m[0] for m in mates)
        out += [(l[0], *l[1:], *m[1:]) for m in mates]
        if not mates and how in ("left", "full"):
            out.append((l[0], *l[1:], None, None))
    if how in ("right", "full"):
        out += [(r[0], None, None, *r[1:]) for r in right if r[0] is None or r[0] not in met]
    return Counter(out)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("hot_keys", [4096, 3])
def test_pairs_expand_to_the_plain_join(spark, how, hot_keys, monkeypatch):
    monkeypatch.setattr(counted_join, "HOT_KEYS", hot_keys)
    l, left = side(spark, 1, KEYS, 60, "a")
    r, right = side(spark, 2, [*KEYS, 9], 40, "b")
    pairs = counted_join.join_pairs(counted_join.counted(left, left.columns), counted_join.counted(right, right.columns), "key", how)
    rows = [tuple(x) for x in pairs.collect()]
    assert len(rows) == len({x[:-1] for x in rows})  # pairs of distinct rows, once each
    assert Counter(tuple(x) for x in counted_join.expanded(pairs).collect()) == expected(l, r, how)


@pytest.mark.parametrize("hot_keys", [4096, 3])
def test_totals_without_pairs(spark, hot_keys, monkeypatch):
    monkeypatch.setattr(counted_join, "HOT_KEYS", hot_keys)
    l, left = side(spark, 3, KEYS, 50, "m")
    r, right = side(spark, 4, [*KEYS, 7], 50, "m")
    got = counted_join.join_totals(counted_join.counted(left, ["key", "m"]), counted_join.counted(right, ["key", "m"]), "key", ["m"])
    for rows, others, out, mine in ((l, r, got[0], "left"), (r, l, got[1], "right")):
        other = "right" if mine == "left" else "left"
        copies, mates = Counter(x[:2] for x in rows), defaultdict(list)
        for x in others:
            if x[0] is not None:
                mates[x[0]].append(x[1] or 0)
        want = {
            (k, m): {"copies": n, "inner_rows": n * len(mates[k]), f"{mine}_rows": n * max(1, len(mates[k])), f"{other}_rows": n * len(mates[k]), "full_rows": n * max(1, len(mates[k])), "partner_m": n * sum(mates[k])}
            for (k, m), n in copies.items()
        }
        found = {(x.key, x.m): {c: x[c] for c in out.columns if c not in ("key", "m")} for x in out.collect()}
        assert found == want


def test_hot_keys_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(counted_join, "HOT_KEYS", 10)
    rows = spark.range(1000).selectExpr("if(id < 600, 1, id) as key", "id as v", "1L as copies")
    totals = counted_join.key_totals(rows, rows, "key")
    hot = counted_join._blocks(totals, "key", "left")
    assert [tuple(x) for x in hot.collect()] == [(1, 6)]
    sizes = [x["count"] for x in counted_join._dealt(rows, hot, "key", "b").where("key = 1").groupBy("b").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 200 and sum(sizes) == 600


def test_empty_sides_and_clashes(spark):
    _, left = side(spark, 5, KEYS, 20, "a")
    _, right = side(spark, 6, KEYS, 20, "b")
    none = right.limit(0)
    both = lambda a, b, how: counted_join.expanded(counted_join.join_pairs(counted_join.counted(a, a.columns), counted_join.counted(b, b.columns), "key", how))
    assert both(left, none, "full").count() == left.count() and both(left, none, "inner").count() == 0
    assert both(none.withColumnsRenamed({"b": "a", "b_more": "a_more"}), none, "full").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        both(left, left, "inner")
    with pytest.raises(ValueError, match="how"):
        both(left, right, "cross")


def test_many_copies_are_made_in_runs(spark):
    rows = spark.createDataFrame([(1, 10_000), (2, 0), (3, 1), (4, counted_join.RUN), (5, counted_join.RUN + 1)], "x long, copies long")
    assert {r.x: r["count"] for r in counted_join.expanded(rows).groupBy("x").count().collect()} == {1: 10_000, 3: 1, 4: counted_join.RUN, 5: counted_join.RUN + 1}
    assert workspace.HOT_KEYS == 4096
