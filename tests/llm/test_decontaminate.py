import random

import regex

from docmill.llm import decontaminate

from .helpers import odd_docs, prose

ITEM = "Tom has 12 apples and buys 7 more apples at the market. How many apples does Tom carry home after he gives 5 of them to his sister Anna?"


def run(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(d, b).collect()}


def test_literal_and_changed_questions(spark):
    filler = " ".join(prose(1, 60))
    changed = ITEM.replace("Tom", "Lisa").replace("12", "40").replace("Anna", "Maria")
    clash = ITEM.replace("Tom has", "Bert has")  # one name in two places stands for two
    loud = ITEM.replace(",", " ;").replace("more", "MORE")
    got = run(spark, [f"{filler} {ITEM} {filler}", f"{filler}\n{changed}\n{filler}", f"{filler} {clash}", filler, ITEM.lower(), None, "", loud], [ITEM, " ".join(prose(9, 30))])
    assert (0, 0) in got and got[0, 0].changed == 0 and got[0, 0].windows == got[0, 0].item_windows
    assert (1, 0) in got and got[1, 0].changed == 2  # Anna stands after the last literal word, outside all windows
    assert (3, 0) not in got and not [k for k in got if k[0] in (3, 5, 6) or k[1] == 1]
    assert (4, 0) in got and (7, 0) in got


def test_slots_must_map_one_to_one(spark):
    item = "once upon a time Kate gives Kate and Paul the red book and then Rosa takes the blue book and Anna the green one"
    fine = item.replace("Kate", "Eve")
    wrong = item.replace("Kate", "Eve", 1).replace("Kate", "Mary", 1)  # Kate was changed to two others, and no 8 literal words stand in a row
    long = "and the blue book and the green book and the small old house"
    got = run(spark, [fine, wrong, f"{wrong} {long}"], [item, f"{item} {long}"])
    assert got[0, 0].windows == got[0, 0].item_windows
    assert (1, 0) not in got and (1, 1) not in got and (2, 0) not in got
    # Windows without a slot are verbatim, whatever the slots of others are.
    assert 0 < got[2, 1].windows < got[2, 1].item_windows


def test_any_space_and_any_joint_between_words(spark):
    words = "while seven heavy boxes stand behind the old barn every farmer counts them twice before the long winter night begins again near quiet hills".split()
    item = " ".join(words)
    joints = ["\u00a0", "\u2009", "\u3000", "\u2014", "/", "-", " \u2013 ", "_", "\u2003\n", "*", "\u2028"]
    mixed = [" ".join(words[:6]) + "\u00a0" + " ".join(words[6:]), item.replace("heavy boxes", "heavy/boxes").replace("old barn", "old\u2014barn"), item.replace("heavy", "hea\u00advy").replace("old", "\u200bold")]
    got = run(spark, [j.join(words) for j in joints] + mixed, [item])
    assert set(got) == {(i, 0) for i in range(len(joints) + len(mixed))}
    assert {r.windows for r in got.values()} == {len(words) - 7}
    back = run(spark, [item], [j.join(words) for j in joints])
    assert len(back) == len(joints)


def test_apostrophes_and_numbers_stay_one_word(spark):
    item = "the farmer's 1,250 sheep don't cross the river that's 3.5 km wide unless the shepherd's dog isn't near"
    got = run(spark, [item.replace("'", "’").replace("1,250", "1250"), item.replace("'", "").replace("1,250", "7")], [item])
    assert {k: r.changed for k, r in got.items()} == {(0, 0): 0, (1, 0): 1}


def test_one_conflict_leaves_the_rest_of_a_copy(spark):
    tail = "walks slowly along the narrow river path while many small birds sing above green fields and quiet farms until evening falls"
    item = f"every single morning Kate greets Kate and Paul then {tail}"
    one = item.replace("Kate", "Eve", 1)  # of two equal names one was changed
    two = item.replace("Kate", "Eve", 1).replace("Kate", "Mary", 1)  # names contradict, but 20 words are verbatim
    same = ITEM.replace("12", "9").replace("7", "9").replace("5", "9")  # new numbers coincide
    got = run(spark, [one, two, same, ITEM], [item, ITEM, same])
    assert got[0, 0].windows == got[0, 0].item_windows and got[0, 0].changed == 1
    assert 6 <= got[1, 0].windows < got[1, 0].item_windows
    assert (2, 1) in got and (3, 2) in got  # (3, 2): the old numbers coincide


def test_copies_in_another_case(spark):
    filler = " ".join(prose(1, 60))
    names = "In March Anna Lee and Paul Roth met Rosa Klein at the Grand Hotel in Old Vienna"
    copies = [f"{filler} {c} {filler}" for item in (ITEM, names) for c in (item.upper(), item.title(), item.lower())]
    got = run(spark, [*copies, filler, "Straße der grünen Bäume"], [ITEM, names, "STRASSE DER GRÜNEN BÄUME"])
    assert set(got) == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (7, 2)}
    assert all(r.windows <= r.item_windows for r in got.values())
    assert (got[3, 1].first_word, got[3, 1].last_word) == (60, 76)


def test_units_and_numbers_are_typed(spark):
    item = "a train drives 30 km through the long valley and then 45 km along the wide river bank"
    got = run(spark, [item.replace("30 km", "99 miles").replace("45 km", "8 miles"), item.replace("30 km", "red"), item.replace("km", "miles", 1)], [item])
    assert set(got) == {(0, 0), (1, 0)}  # (1, 0): eight words from "long valley" on, with their slot
    assert got[0, 0].changed == 3


def test_short_items(spark):
    got = run(spark, ["say alpha beta gamma delta now please", "alpha beta gamma"], ["alpha beta gamma delta", "alpha beta gamma", "", None])
    assert set(got) == {(0, 0)}


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs = [" ".join(prose(i, 30)) + " " + ITEM for i in range(5)] + [" ".join(prose(8, 20_000)) + " " + ITEM.upper(), "one", "", None, "one two"]
    one = run(spark, docs, [ITEM])
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert run(spark, docs, [ITEM]) == one and len(one) == 6


def test_odd_rows(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (None, "w1 w2 w3 w4 w5 w6 w7 w8"), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (6, 3)}
    out = decontaminate.drop_leaks(docs, items)
    assert out.columns == docs.columns and out.count() == docs.count() - 4
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def test_null_and_repeated_ids_get_the_verdict_of_their_text(spark):
    docs = spark.createDataFrame([(None, ITEM), (None, "fine"), (1, ITEM), (1, "fine too"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert {r.text for r in decontaminate.drop_leaks(docs, items).collect()} == {"fine", "fine too", None}


def test_short_items_on_request(spark):
    d = spark.createDataFrame([(0, "say alpha beta gamma now"), (1, "alpha beta"), (2, "beta alpha")], "doc_id long, text string")
    b = spark.createDataFrame([(0, "alpha beta gamma"), (1, "alpha beta"), (2, "alpha")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(d, b, least=2).collect()} == {(0, 0), (0, 1), (1, 1)}


def test_suspects_lose_nothing(spark, monkeypatch):
    """The same leaks as when every document is marked, by brute force over windows of literal words."""
    import random

    r = random.Random(3)
    items = [" ".join(r.choice(["Tom", "Anna", "12", "km", "7", *prose(k, 5, 50)]) for _ in range(30)) for k in range(6)]
    docs = []
    for i in range(80):
        w = " ".join(prose(1000 + i, 30, 50)).split()
        part = items[i % 6].split()[i % 10 : i % 10 + 14]
        part = [r.choice(["Bert", "9"]) if x in ("Tom", "12") and r.random() < 0.5 else x for x in part]
        docs.append(" ".join(w[:10] + part + w[10:]))
    some = run(spark, docs, items)
    monkeypatch.setattr(decontaminate, "_suspects", lambda own, *a: a[-1].save(own.select("doc_id").distinct(), "suspects"))
    assert run(spark, docs, items) == some and len(some) > 40


def plain_words(text):
    joined = regex.sub(r"[\p{Cf}'’‘ʼ]|(?<=\p{Nd})[.,](?=\p{Nd})", "", text or "")
    return regex.sub(r"[^\p{L}\p{M}\p{N}\s\p{Z}]+", " ", joined).split()


def plain_template(text):
    """(slots before it, literal word) for each literal word."""
    out, slots = [], []
    for w in plain_words(text):
        if regex.fullmatch(r"\p{Nd}+\p{Ll}{0,4}", w):
            slots.append("n" + w)
        elif slots and slots[-1][0] == "n" and w in decontaminate.UNITS.split():
            slots.append("u" + w)
        elif regex.fullmatch(r"\p{Lu}[\p{L}\p{M}]+", w):
            slots.append("p" + w)
        else:
            out.append(([x.lower() for x in slots], w.lower()))
            slots = []
    return out


def plain_windows(words, least=4, item=False):
    n = len(words)
    size = min(n, 8) if item else 8
    return [] if n < least or size > n else [(i, size) for i in range(n - size + 1)]


def plain_leak(doc, item):
    """Whether a document has a window of the item with consistent slots, or a plain one in another case; by comparing every two windows."""
    d, t = plain_template(doc), plain_template(item)
    kind = lambda w: (w[0][1], *[(tuple(s[0] for s in slots), x) for slots, x in w[1:]])
    runs = {}
    for i, size in plain_windows(t, item=True):
        for j in range(len(d) - size + 1):
            a, b = t[i : i + size], d[j : j + size]
            if kind(a) == kind(b):
                values = [(x, y) for (sa, _), (sb, _) in zip(a[1:], b[1:]) for x, y in zip(sa, sb)]
                runs.setdefault(j - i, []).append(values)
    for found in runs.values():
        pairs = {v for values in found for v in values}
        bound = [(x, y) for x, y in pairs if x[0] == "u" or (x[0] == "p" and x != y)]
        if len(bound) == len({x for x, _ in bound}) or any(not values for values in found):
            return True
    d, t = plain_words(doc), plain_words(item)
    fold = lambda ws: [w.lower().replace("ß", "ss") for w in ws]
    return any(fold(t[i : i + size]) == fold(d[j : j + size]) and t[i : i + size] != d[j : j + size] for i, size in plain_windows(t, item=True) for j in range(len(d) - size + 1))


def test_against_every_two_windows(spark):
    r = random.Random(9)
    names, units = ["Tom", "Anna", "Ärzte", "McKay", "Bo"], ["km", "miles", "kg", "percent"]

    def prose_of(k, n):
        out = []
        while len(out) < n:
            out += r.choices([[f"v{chr(97 + r.randrange(k))}"], [r.choice(names)], [str(r.randrange(30)), r.choice(units)], [f"{r.randrange(9)},{r.randrange(100, 999)}"], ["straße"], ["don't"]], [12, 3, 2, 1, 1, 1])[0]
        return out

    items = [prose_of(12, r.choice([3, 5, 7, 9, 14, 25])) for _ in range(14)]
    joint = ["%s %s", "%s\u00a0%s", "%s — %s", "%s/%s", "%s, %s"]
    docs = []
    for _ in range(160):
        own = prose_of(12, 10)
        part = list(r.choice(items))
        how = r.random()
        if how < 0.35:  # other names, numbers and units, some of them in contradiction
            change = {x: r.choice(names + units) if r.random() < 0.5 else x for x in set(part)}
            part = [change[x] if x in names and change[x] in names or x in units and change[x] in units else x for x in part]
            part = [r.choice(names) if x in names and r.random() < 0.2 else r.choice(units) if x in units and r.random() < 0.2 else str(r.randrange(50)) if x.isdigit() else x for x in part]
        elif how < 0.5:
            part = [x.upper() if r.random() < 0.7 else x.title() for x in part]
        elif how < 0.7:
            part = part[: r.randrange(len(part) + 1)]
        text = " ".join(own[:5]) + " "
        for x in part:
            text = r.choice(joint) % (text.rstrip(" "), x)
        docs.append(text + " " + " ".join(own[5:]))
    items = [" ".join(x) for x in items]
    want = {(i, k) for i, d in enumerate(docs) for k, t in enumerate(items) if plain_leak(d, t)}
    assert set(run(spark, docs, items)) == want and 60 < len(want) < len(docs) * len(items) / 4
