import random

from pyspark.sql import functions as F

from docmill.operators import placed
from docmill.operators.windows import clustered

WORD = "page int, x0 double, y0 double, x1 double, y1 double, word string"


def frame(spark, rows):
    return spark.createDataFrame([(p, *[None if c is None else float(c) for c in at], w) for p, *at, w in rows], WORD)


def sizes(spark, *pages):
    return spark.createDataFrame([(p, 600.0, 800.0) for p in pages], "page int, page_width double, page_height double")


def card(page, x, y, k, extra=()):
    return [(page, x, y, x + 60, y + 9, f"ABC{k:07d}"), *[(page, x + dx, y + dy, x + dx + 20, y + dy + 9, w) for dx, dy, w in extra]]


def test_id_tokens(spark):
    words = ["ABC1234567", " abc1234567. ", ";AB/12/345/678901,", "ABC12345", "AB1234567", "", None, "ABC1234567X"]
    got = [r.id for r in placed.ids(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n int")).orderBy("n").collect()]
    assert got == ["ABC1234567", "ABC1234567", "AB/12/345/678901"]


def test_kinds(spark):
    rows = [w for k in range(9) for w in card(1, 30 + 190 * (k % 3), 40 + 72 * (k // 3), k)]  # in the cells of the grid
    rows += [w for k in range(9) for w in card(2, 30, 40 + 72 * k, k)]  # one column only
    rows += [w for k in range(3) for w in card(3, 30 + 190 * k, 40, k)] + [(4, 1.0, 1.0, 2.0, 2.0, "no"), (4, None, None, None, None, None)]
    got = {r.page: (r.ids, r.kind) for r in placed.layout_kinds(frame(spark, rows), ["page"], sizes(spark, 1, 2, 3, 4, 5)).collect()}
    assert got == {1: (9, "known"), 2: (9, "other"), 3: (3, "few"), 4: (0, "none"), 5: (0, "none")}


def test_boxes_follow_the_pitch(spark):
    two = [w for k in range(6) for w in card(1, 50 + 250 * (k % 2) + k, 100 + 90 * (k // 2) + k, k)]
    one = [w for k in range(4) for w in card(2, 300, 100 + 20 * k, k)]  # rows too near to be a pitch
    few = [w for k in range(3) for w in card(3, 50, 100 * k, k)]
    got = {(r.page, r.id): (r.left, r.top, r.width, r.height) for r in placed.card_boxes(frame(spark, two + one + few), ["page"], sizes(spark, 1, 2, 3)).collect()}
    assert got[1, "ABC0000000"] == (10.0, 94.0, 230.9, 82.8) and got[1, "ABC0000003"] == (263.0, 187.0, 230.9, 82.8)
    assert got[2, "ABC0000000"] == (260.0, 94.0, 288.0, 140.0) and len(got) == 10
    assert placed.card_boxes(frame(spark, few), ["page"], sizes(spark, 3), least=1).count() == 3


def brute_lines(words, boxes):
    out = {}
    for p, i, left, top, w, h in boxes:
        held = sorted([x for x in words if x[0] == p and x[1] is not None and left <= (x[1] + x[3]) / 2 <= left + w and top <= (x[2] + x[4]) / 2 <= top + h], key=lambda x: x[2])
        lines = []
        for x in held:
            if not lines or x[2] - lines[-1][0][2] > 8:
                lines.append([x])
            else:
                lines[-1].append(x)
        texts = [" ".join(x[5].strip() for x in sorted(ln, key=lambda x: (x[1], x[2], x[5].strip())) if x[5].strip()) for ln in lines]
        if any(texts):
            out[p, i, left, top] = [t for t in texts if t]
    return out


def test_lines_equal_all_pairs(spark):
    r = random.Random(4)
    words = [(r.randrange(3), x := r.uniform(0, 560), y := r.uniform(0, 780), x + r.uniform(0, 40), y + 9, r.choice(["a", " b ", "cc", " ", "d"])) for _ in range(900)]
    boxes = [(r.randrange(4), f"i{k}", float(r.randrange(500)), float(r.randrange(700)), float(r.choice([0, 30, 200, 600])), float(r.choice([20, 90, 800]))) for k in range(40)]
    words += [(0, b[2], b[3], b[2], b[3], "edge") for b in boxes[:5]] + [(0, b[2] + b[4], b[3] + b[5], b[2] + b[4], b[3] + b[5], "corner") for b in boxes[:5]]
    df = spark.createDataFrame(boxes + boxes[:3] + [(0, "bad", 0.0, 0.0, -1.0, 5.0)], "page int, id string, left double, top double, width double, height double")
    got = {(x.page, x.id, x.left, x.top): x.lines for x in placed.card_lines(frame(spark, words + [(0, None, None, None, None, None)]), df, ["page"]).collect()}
    assert got == brute_lines(words, boxes)
    plan = placed.words_in_boxes(frame(spark, words), df, ["page"])._jdf.queryExecution().executedPlan().toString()
    assert "__cx" in plan.split("Join")[1].split("\n")[0]  # cells, and not the page alone, are joined on


def test_lines_are_shuffled_by_page_only(spark):
    words = frame(spark, card(1, 50, 100, 1, [(5, 20, "a"), (9, 2, "b")]) + [(None, 1.0, 1.0, 2.0, 2.0, "no page")])
    boxes = spark.createDataFrame([(1, "i", 0, 90, 300, 100), (1, "j", 40, 0, 300, 400), (None, "k", 0, 0, 9, 9)], "page int, id string, left int, top int, width int, height int")
    lines = placed.card_lines(words, boxes, ["page"])
    shuffles = [x for x in lines._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    # One for equal boxes, and one for words and boxes; cells, and words with their boxes, aren't shuffled.
    assert sum("REPARTITION_BY_COL" in x for x in shuffles) == 1 and len(shuffles) == 2 and not any("__cx" in x for x in shuffles)
    assert sorted(map(tuple, lines.collect())) == [(1, i, left, top, ["ABC0000001 b", "a"]) for i, left, top in (("i", 0, 90), ("j", 40, 0))]


def test_clusters_of_rows(spark):
    r = random.Random(2)
    df = spark.createDataFrame([(r.randrange(5), r.uniform(0, 300)) for _ in range(300)] + [(1, None)], "g int, v double")
    got = placed.with_cluster(df, ["g"], "v", 20.0, "c").groupBy("g", "c").agg(F.min("v").alias("first"), F.max("v").alias("last"), F.count("v").cast("int").alias("size")).where("c IS NOT NULL")
    want = clustered(df, ["g"], "v", 20.0).withColumnRenamed("cluster", "c")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("g", "c", "first", "last", "size").collect()))


def test_template(spark):
    cards = spark.createDataFrame([("a", 1, 10.0, 200.0, 80.0), ("a", 2, 30.0, 210.0, 80.0), ("a", 3, 300.0, 220.0, 90.0), ("b", 1, 5.0, 100.5, 50.0)], "layout string, card int, x double, width double, height double")
    labels = spark.createDataFrame([("a", 1, "age", 5.0, 40.0), ("a", 2, "age", 7.0, 41.0), ("a", 3, "name", 1.0, 1.0)], "layout string, card int, label string, dx double, dy double")
    got = {r.layout: r for r in placed.compiled_template(cards, ["layout"], labels).collect()}
    assert got["a"].identity == "c2_w210_h80_age" and [tuple(x) for x in got["a"].labels] == [("age", 7.0, 41.0)] and got["a"].cards == 3
    assert got["b"].identity == "c1_w100.5_h50" and got["b"].labels == []
