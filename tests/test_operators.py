import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docmill.operators import aggregates, attempts, browse, dedup, header_fill, joins, layout, normalize, progress, quality, windows
from docmill.plans.fixtures import ENVELOPES


def test_attempts(spark):
    tries = [("A", 1, 1, "completed"), ("A", 2, 2, "failed"), ("A", 3, 3, "processing"), ("B", 4, 1, "failed"), ("B", 5, 2, "processing"), ("C", 6, 1, "completed"), ("D", 7, 1, "completed"), ("D", 8, 2, "completed"), ("E", 9, 1, "completed"), ("E", 10, 2, "completed"), ("F", 11, 1, "partial"), ("F", 12, 2, "failed")]
    recs = [(i,) for i in (1, 1, 2, 3, 4, 5, 8, 9, 11, 12)]
    a = spark.createDataFrame(tries, "doc string, id int, number int, status string")
    r = spark.createDataFrame(recs, "session int")
    got = attempts.authoritative_attempt(a, r, "doc", "id", "session", F.col("status").isin("completed", "partial"), [F.col("number").desc()])
    assert {x.doc: x.id for x in got.collect()} == {"A": 1, "B": 5, "D": 8, "E": 9, "F": 11}


def test_natural_key_exempts_nulls(spark):
    rows = spark.createDataFrame([("s", 1, 1, 9), ("s", 1, 1, 8), ("s", None, 1, 7), ("s", None, 1, 6)], "s string, page int, row int, id int")
    assert sorted(r.id for r in dedup.by_natural_key(rows, ["s", "page", "row"], [F.col("id")]).collect()) == [6, 7, 8]


def test_spans_and_points(spark):
    points = spark.createDataFrame([(i, float(i)) for i in range(50)], "p int, x double")
    spans = spark.createDataFrame([(1, 3.0, 7.0), (2, 7.0, 7.0), (3, 0.5, 40.2)], "s int, a double, b double")
    got = {(r.p, r.s) for r in joins.points_in_spans(points, spans, "x", "a", "b", 4.0).collect()}
    assert got == {(p, s) for p in range(50) for s, a, b in ((1, 3, 7), (2, 7, 7), (3, 0.5, 40.2)) if a <= p <= b}


def test_clusters_measure_from_their_first(spark):
    rows = spark.createDataFrame([("p", v) for v in (0.0, 10.0, 18.0, 19.0, 30.0, 40.0)], "p string, y double")
    assert [(r.first, r.last, r.size) for r in windows.clustered(rows, ["p"], "y", 18.0).orderBy("cluster").collect()] == [(0, 18, 3), (19, 30, 2), (40, 40, 1)]


def test_serials(spark):
    rows = [("a", 1, 5), ("a", 2, 6), ("a", 3, None), ("a", 4, 7), ("b", 1, 5), ("b", 2, 5), ("c", 1, 9), ("d", 1, 3), ("d", 2, 0), ("d", 3, 2)]
    df = spark.createDataFrame(rows, "page string, card int, serial int")
    got = {r.page: (r.usable, r.rising) for r in windows.rises(df, ["page"], "serial", [F.col("card")]).collect()}
    assert got == {"a": (3, True), "b": (2, False), "c": (1, None), "d": (2, False)}


def test_header_fill(spark):
    rows = [("A", 1, "7", None), ("A", 2, None, None), ("B", 1, "7", None), ("B", 2, "8", None), ("B", 3, None, None), ("C", 1, None, None), ("D", 1, None, None)]
    df = spark.createDataFrame(rows, "doc string, page int, code string, name string")
    other = spark.createDataFrame([("A", "1", "2"), ("B", "1", "2"), ("C", "9", "2"), ("D", None, "4")], "doc string, cover string, file string")
    got = {r.doc: (r.code, r.origin) for r in header_fill.document_code(df, "doc", "code", other, ["cover", "file"]).collect()}
    assert got == {"A": ("7", "records"), "B": (None, None), "C": ("9", "cover"), "D": ("4", "file")}


def test_section_fill(spark):
    rows = [("A", 1, 5, "x"), ("A", 2, None, None), ("A", 3, 5, "x"), ("B", 1, 5, "x"), ("B", 2, None, None), ("B", 3, 6, "y"), ("C", 1, 5, "x"), ("C", 2, None, None), ("D", 1, None, None), ("E", 1, 5, "x"), ("E", 2, None, None), ("E", 3, 9, "परिवर्धन सूची"), ("F", 1, None, None)]
    df = spark.createDataFrame(rows, "doc string, page int, code int, name string")
    cover = spark.createDataFrame([("D", 4), ("F", 1), ("F", 2)], "doc string, section int")
    out = header_fill.filled_sections(df, "doc", "page", "code", "name", "परिवर्धन", cover)
    got = {(r.doc, r.page): (r.code, r.origin) for r in out.collect()}
    assert got["A", 2] == (5, "neighbours") and got["B", 2] == (None, None) and got["C", 2] == (5, "only_code")
    assert got["D", 1] == (4, "cover") and got["E", 2] == (5, "only_code") and got["F", 1] == (None, None) and got["A", 1] == (5, None)


def test_unique_and_contained(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, k string")
    cat = spark.createDataFrame([("x", 10), ("y", 20), ("y", 21)], "k string, v int")
    assert {r.id: r.v for r in joins.unique_lookup(rows, cat, ["k"], ["v"]).collect()} == {1: 10, 2: None, 3: None}
    texts = spark.createDataFrame([("in Goa",), ("Goa and Assam",), ("none",), (None,)], "t string")
    names = spark.createDataFrame([("Goa",), ("Assam",)], "n string")
    assert [r.n for r in joins.containing_one(texts, "t", names, "n").collect()] == ["Goa", None, None, None]


def test_medians_votes_and_rates(spark):
    df = spark.createDataFrame([("a", v) for v in (4, 1, 3, 2)] + [("b", 5)], "g string, v int")
    assert {r.g: r.m for r in df.groupBy("g").agg(aggregates.upper_median("v").alias("m")).collect()} == {"a": 3, "b": 5}
    votes = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x"), ("d", "x"), ("d", "x"), ("d", "y"), ("d", "y")], "g string, v string")
    assert {r.g: r.v for r in aggregates.majority(votes, ["g"], "v").collect()} == {"a": "x", "b": None, "c": None, "d": None}
    df = spark.createDataFrame([(10.0, 2), (20.0, 0)], "s double, w int")
    assert df.agg(aggregates.weighted_rate(F.col("s"), F.col("w")).alias("r")).first().r == 15.0
    assert df.where("w = 0").agg(aggregates.weighted_rate(F.col("s"), F.col("w")).alias("r")).first().r is None


def test_units_and_states(spark):
    docs = spark.createDataFrame([("a", 2), ("b", 3), ("c", 23), ("d", 0)], "d string, n int")
    got = [(r.d, r.unit_number, r.page_from, r.page_to) for r in progress.units(docs, "d", "n").orderBy("d", "unit_number").collect()]
    assert got == [("a", 1, 1, 2), ("b", 1, 3, 3), ("c", 1, 3, 12), ("c", 2, 13, 22), ("c", 3, 23, 23)]
    t = lambda s: datetime(2024, 1, 1, 1, s // 60, s % 60)
    spans = spark.createDataFrame([("x", t(0), t(360)), ("x", t(120), t(600)), ("y", t(60), t(0)), ("z", None, t(0))], "s string, a timestamp, b timestamp")
    assert {r.s: r.ms for r in spans.groupBy("s").agg(progress.active_ms(F.col("a"), F.col("b")).alias("ms")).collect()} == {"x": 840_000, "y": None, "z": None}


def test_quality(spark):
    df = spark.createDataFrame([(1, 1, None, "x", ["age_absent"], True), (1, 2, "5", "x", None, True), (1, 3, "5", " ", None, True), (1, 4, "5", "x", None, False)], "page int, row int, age string, name string, reasons array<string>, valid boolean")
    got = {r.row: (r.missing, r.reasons) for r in quality.incomplete(df, ["page", "row"], ["age", "name"], F.col("reasons"), F.col("valid")).collect()}
    assert got == {1: ("age", "age_absent"), 3: ("name", ""), 4: ("", "")}
    second = spark.createDataFrame([(1, 1, "9"), (1, 2, "8")], "page int, row int, age string")
    out = {r.row: r.age for r in quality.filled(df, second, ["page", "row"], ["age"]).collect()}
    assert out == {1: "9", 2: "5", 3: "5", 4: "5"}


def test_browse(spark):
    df = spark.createDataFrame([(i, f"n{i}", f"h{i}") for i in range(250)], "id int, name_en string, name_hi string")
    table = browse.Table(("id", "gone", "name_hi", "name_en"), ("name_en",))
    assert browse.projected(df, table).columns == ["id", "name_hi", "name_en"]
    assert browse.projected(df, table, "hi").columns == ["id", "name_hi"]
    last = browse.page(df, [F.col("id")], 3).collect()
    assert len(last) == 50 and last[0].pages == 3 and not last[0].has_more
    assert browse.page(df.limit(0), [F.col("id")], 1).collect() == []
    assert df.where(browse.age_filter(F.col("id"), "20-30")).count() == 11 and df.where(browse.age_filter(F.col("id"), "x")).count() == 250


def test_normalised_record(spark):
    rows = spark.createDataFrame([("d", "s", "u", ENVELOPES["ok"])], "document_id string, session_id string, unit_id string, payload string")
    got = {(r.page_number, r.source_row_number): r for r in normalize.normalised_records(rows, "payload").collect()}
    one = got[3, 1]
    assert one.gender_en == "Male" and one.relation_name == "पिता" and one.relationship_type == "father" and one.ward_code == "Not on this roll" and one.roll_format == "assembly" and one.serial_mark == "Not printed"
    three = got[4, 1]
    assert three.is_deleted and three.ward_code == "12" and three.sno == 7 and three.confidence is None
    import hashlib

    assert one.source_record_hash == hashlib.sha256(b"s:3:1").hexdigest()
    assert normalize.normalised_metadata(rows, "payload").count() == 1


def test_layout(spark):
    grid = [("g", x, y) for x in (40.0, 230.0, 420.0) for y in (60.0, 150.0, 240.0)]
    words = spark.createDataFrame(grid + [("c", 40.0, y) for y in (10.0, 100.0)] + [("s", 5.0, 5.0)] + [("w", 40.0, 60.0), ("w", 300.0, 400.0)], "page string, x double, y double")
    assert {r.page: r.kind for r in layout.layouts(words, ["page"]).collect()} == {"g": "grid", "c": "column", "s": "single", "w": "sparse"}
    size = {r.page: (r.width, r.height) for r in layout.card_sizes(words, ["page"]).collect()}
    assert size["g"] == (pytest.approx(190 * 0.92), pytest.approx(81.0))
    boxes = spark.createDataFrame([("g", 1, 0.0, 0.0, 100.0, 100.0), ("g", 2, 100.0, 0.0, 200.0, 100.0)], "page string, card int, left double, top double, right double, bottom double")
    w = spark.createDataFrame([("g", "a", 10.0, 10.0, 20.0, 20.0), ("g", "b", 95.0, 0.0, 105.0, 10.0), ("g", "c", 300.0, 0.0, 310.0, 10.0)], "page string, text string, x0 double, y0 double, x1 double, y1 double")
    assert {r.text: r.card for r in layout.words_in_boxes(w, boxes, ["page"]).collect()} == {"a": 1, "b": 2}
    labels = spark.createDataFrame([("L", "name", 1, 2.0, 3.0), ("L", "name", 2, 4.0, 5.0), ("L", "rare", 1, 0.0, 0.0)], "layout string, label string, card int, dx double, dy double")
    cards = spark.createDataFrame([("L", i) for i in (1, 2, 3)], "layout string, card int")
    assert [(r.label, r.dx, r.dy) for r in layout.compiled_template(labels, "layout", cards).collect()] == [("name", 4.0, 5.0)]


def test_live_counter_and_chunks(spark):
    rows = [(5, 3, 12, False, 4.0, 9), (13, 3, 12, False, 4.0, 9), (5, 3, 12, True, 4.0, 9), (5, 3, 12, False, 40.0, 9), (None, 3, 12, False, 1.0, 9)]
    df = spark.createDataFrame(rows, "p int, a int, b int, done boolean, idle double, cards int")
    got = df.select(progress.live_cards(F.col("p"), F.col("a"), F.col("b"), F.col("done"), F.col("idle"), F.col("cards")).alias("n"))
    assert [r.n for r in got.collect()] == [9, 0, 0, 0, 0]
    tree = spark.createDataFrame([("S1", {"D1": {"A1": list(range(23))}, "D2": {"A2": [1]}})], "state string, tree map<string,map<string,array<int>>>")
    flat = progress.leaves(tree, "tree", ["district", "ac", "part"])
    assert flat.columns == ["state", "district", "ac", "part"] and flat.count() == 24
    chunks = progress.chunked(flat, ["ac"], [F.col("part")]).groupBy("ac", "chunk").count().collect()
    assert {(r.ac, r.chunk): r["count"] for r in chunks} == {("A1", 1): 10, ("A1", 2): 10, ("A1", 3): 3, ("A2", 1): 1}


def test_places_in_shares_and_clusters_across_groups(spark):
    r = random.Random(5)
    rows = [(i, r.choice([None, 1.5, 2.0, float(r.randrange(100))])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v double")
    want = [i for i, _ in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[0]))]
    assert [x.id for x in windows.numbered(df, "v", "id", parts=7).orderBy("position").collect()] == want
    assert windows.numbered(df.limit(0), "v", "id").count() == 0

    points = [(r.choice(["a", None, "b"]), r.choice([None, float("nan"), float(r.randrange(200))])) for _ in range(400)]
    want = []
    for g in {g for g, _ in points}:
        of = sorted(v for h, v in points if h == g and v is not None and v == v)
        found = []
        for v in of:
            if not found or v - found[-1][0] > 9:
                found.append([v, v, 0])
            found[-1][1:] = v, found[-1][2] + 1
        want += [(g, i, *c) for i, c in enumerate(found)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # groups go on in the next batch
    try:
        got = windows.clustered(spark.createDataFrame(points, "g string, v double"), ["g"], "v", 9).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
