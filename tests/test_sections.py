import random
import re
from difflib import SequenceMatcher

from docmill.operators import cards

LETTERS = "कखगघचछजटडतदनपबम"


def fold(v):
    return re.sub(r"[^ऀ-ॿ0-9]", "", (v or "").replace("ँ", ""))


def same(entry, read):
    return bool(entry and read) and (entry in read or read in entry or SequenceMatcher(None, entry, read).ratio() >= 0.82)


def plain(pages, entries):
    out = {}
    for d, p, code, name in pages:
        own = {c: n for e, c, n in entries if e == d and n and n.strip()}
        if code in own:
            out[d, p] = (code, own[code], None)
            continue
        hits = [c for c, n in own.items() if same(fold(n), fold(name))]
        out[d, p] = (hits[0], own[hits[0]], None) if len(hits) == 1 else ("", name, "not_in_the_cover_list")
    return out


def changed(r, name):
    s = list(name)
    for _ in range(r.choice([0, 1, 1, 2, 3])):
        at = r.randrange(len(s)) if s else 0
        s[at : at + r.randrange(2)] = r.choice(["", r.choice(LETTERS), r.choice(LETTERS) * 2])
    return "".join(s)


def made(seed):
    r = random.Random(seed)
    entries, pages = [], []
    for d in range(12):
        names = ["".join(r.choices(LETTERS[: r.choice([2, 4, 15])], k=r.choice([1, 2, 3, 4, 6, 9, 14, 25]))) for _ in range(8)]
        entries += [(d, str(k), n) for k, n in enumerate(names)]
        for p in range(25):
            base = r.choice(names)
            read = r.choice([changed(r, base), base[: r.randrange(1, len(base) + 1)], base + " " + r.choice(names), "".join(r.choices(LETTERS, k=7))])
            pages.append((d, p, r.choice(["9", "3", None, ""]), " - ".join([read[:2], read[2:]]) + "ँ"))
    return pages + [(0, 100, None, None), (0, 101, "x", ""), (99, 1, "1", "कख")], entries + [(0, "77", None), (0, "78", "  "), (5, "79", "abc")]


def test_the_result_of_all_pairs(spark):
    for seed in (1, 2):
        pages, entries = made(seed)
        p, e = spark.createDataFrame(pages, "d int, page int, code string, name string"), spark.createDataFrame(entries, "d int, code string, name string")
        got = {(r.d, r.page): (r.code, r.name, r.reason) for r in cards.page_sections(p, e, "d").collect()}
        assert got == plain(pages, entries)


def test_few_pairs_are_rated_and_none_is_lost(spark):
    r = random.Random(5)
    names = ["".join(r.choices(LETTERS, k=r.randrange(1, 30))) for _ in range(150)]
    reads = [changed(r, r.choice(names)) for _ in range(150)]
    a = spark.createDataFrame([(1, x) for x in reads], "d int, read string")
    b = spark.createDataFrame([(1, x) for x in names], "d int, name string")
    kept = {(x.read, x.name): x.sure for x in cards.alike_names(a, b, "d").collect()}
    alike = {(x, n) for x in set(reads) for n in set(names) if same(n, x)}
    assert alike <= set(kept)
    rated = sum(not s for s in kept.values())
    assert rated < 0.02 * len(set(reads)) * len(set(names))
    assert all(s == (x in n or n in x) for (x, n), s in kept.items())
