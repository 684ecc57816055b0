import hashlib

import pytest
from pyspark.sql import functions as F

from docmill.functions import display, geo, names, scoring, text, transliterate


def values(spark, column, rows, schema="v string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(column.alias("x")).collect()]




def test_cleaning(spark):
    assert values(spark, text.blank_to_null(F.col("v")), [" a ", " ", "", None, " b\t"]) == ["a", None, None, None, "b"]
    assert values(spark, text.lenient_int(F.col("v")), [" 45 ", "4S", "12.0", "०१२", "0", "-3", None, "99999999999"]) == [45, None, None, 12, 0, -3, None, None]
    got = values(spark, text.strict_int(F.col("v")), ["5", "", None, "true", "x"])
    assert [(g.value, g.bad) for g in got] == [(5, False), (None, False), (None, False), (None, True), (None, True)]
    assert values(spark, text.cut(F.col("v")), ["a  b\n c", "x" * 81, None]) == ["a b c", "x" * 80 + "…", None]
    assert values(spark, text.squash(F.col("v")), ["Meera", "Raajj", "Poonam"]) == ["mira", "raj", "punam"]
    assert values(spark, text.safe_file_name(F.col("v")), ["a/b:c.pdf", "CON.txt", " . ", "ok.pdf"]) == ["a_b_c.pdf", "_CON.txt", "file", "ok.pdf"]
    assert values(spark, text.label_matches(F.col("v"), F.lit("12")), ["12 North", "123", "12"]) == [True, False, True]
    assert values(spark, text.label_matches(F.col("v"), F.lit("north-east")), ["North East", "north"]) == [True, False]


def test_unicode(spark):
    assert values(spark, text.nfkc(F.col("v")), ["ﬁ", None]) == ["fi", None]
    assert values(spark, text.nfc(F.col("v")), ["é"]) == ["é"]
    assert values(spark, text.skeleton(F.col("v")), ["कुमार", "क़िला abc", None]) == ["कमर", "कल", None]
    assert values(spark, text.order_marks(F.col("v")), ["ạ́"]) == ["ạ́"]
    assert values(spark, text.has_devanagari(F.col("v")), ["राम", "Ram", None]) == [True, False, False]
    assert values(spark, text.ratio(F.col("v"), F.lit("abcd")), ["abcd", "abxd", None]) == [1.0, 0.75, None]
    assert values(spark, text.distance_within(F.col("v"), F.lit("kitten"), 2), ["kitten", "sitten", "sitting"]) == [0, 1, None]


def test_search_keeps_wildcards(spark):
    assert values(spark, text.search([F.col("v")], " a%c "), ["xabbC", "ca", None]) == [True, False, False]
    assert values(spark, text.search([F.col("v")], "  "), ["x", None]) == [True, True]


def test_names(spark):
    got = values(spark, names.parts(F.col("v")), ["A", "A B", " A  B C D ", "", None])
    assert [tuple(g) for g in got] == [("A", None, None), ("A", None, "B"), ("A", "B C", "D"), (None, None, None), (None, None, None)]
    assert tuple(values(spark, names.parts(F.col("v"), only_words=True), ["A - B"])[0]) == ("A", None, "B")
    assert values(spark, names.join(F.col("v"), F.lit(" "), F.lit("Z")), ["A", None]) == ["A Z", "Z"]
    assert values(spark, names.cell(F.col("v")), ["", "x"]) == ["—", "x"]
    assert values(spark, names.gender_bucket(F.col("v")), ["तृतीय लिंग", "महिला", "पुरुष", "Female", "male", "?"]) == ["third", "female", "male", "female", "male", None]
    assert values(spark, names.gender_english(F.col("v")), ["पुरुष", "कुछ"]) == ["Male", None]
    assert values(spark, names.relation_key(F.col("v")), ["पिता", "Husband", "कुछ"]) == ["father", "husband", None]
    assert values(spark, names.relation_printed(F.col("v")), ["father", "aunt", None]) == ["पिता", None, None]
    fixes = F.create_map(F.lit("रम"), F.lit("राम"), F.lit("राम लल"), F.lit("राम लाल"))
    assert values(spark, names.corrected(F.col("v"), fixes), ["रम लल", "रम", "श्याम"]) == ["राम लाल", "राम", "श्याम"]


@pytest.mark.parametrize(("hindi", "latin"), [
    ("कल्पना", "Kalpana"), ("रेखा", "Rekha"), ("सुधा", "Sudha"), ("सरस्वती", "Sarasvati"), ("अर्चना", "Archana"), ("रोहित", "Rohit"), ("अमित", "Amit"), ("कुमार", "Kumar"),
    ("रविन्द्र", "Ravindra"), ("चन्द्र", "Chandra"), ("सुनीता", "Sunita"), ("सिंह", "Singh"), ("शंकर", "Shankar"), ("चंद", "Chand"), ("ज्ञान", "Gyan"), ("सक्सेना", "Saxena"), ("कुछ", "Kuchh"),
    ("64", "64"), ("AWX5108170", "AWX5108170"), ("Ramesh", "Ramesh"), ("", None), ("  ", None), (None, None), ("गली न0 8", "Gali Na0 8"),
])
def test_transliteration(hindi, latin):
    assert transliterate.transliterated(hindi) == latin


def test_transliteration_in_a_query(spark):
    rows = ["राम कुमार", "Plain", None, " "]
    assert values(spark, transliterate.transliterate(F.col("v")), rows) == ["Ram Kumar", "Plain", None, None]
    want = hashlib.sha256("a␟␟b".encode()).hexdigest()
    assert values(spark, transliterate.source_hash(F.col("v"), F.lit(None).cast("string"), F.lit("b")), ["a"]) == [want]


def test_confidence(spark):
    rows = [(None, None), (80.0, None), (80.0, {"a": "0.6"}), (None, {"a": "0", "b": "0"}), (None, {"a": "1", "b": "x", "c": "NaN"}), (float("nan"), {"a": "0.5"}), (250.0, {}), (None, {"a": "inf"})]
    df = spark.createDataFrame(rows, "w double, f map<string,string>")
    got = [(r.c.confidence, r.c.coverage) for r in df.select(scoring.confidence(F.col("w"), F.col("f")).alias("c")).collect()]
    want = [(None, None), (0.8, None), (0.7, 1.0), (0.0, 0.0), (1 / 3, 1 / 3), (0.5, 1.0), (1.0, None), (0.0, 0.0)]
    assert [tuple(None if x is None else round(x, 9) for x in g) for g in got] == [tuple(None if x is None else round(x, 9) for x in w) for w in want]


def test_stored_confidence(spark):
    got = values(spark, scoring.stored_confidence(F.col("v")), ["0.5", "", "high", "true", "NaN", "Infinity", "2.5", "-0.1", None])
    bad, out = "confidence not a number", "confidence outside 0–1"
    assert [(g.value, g.error) for g in got] == [(0.5, None), (None, bad), (None, bad), (None, bad), (None, bad), (None, bad), (1.0, out), (0.0, out), (None, None)]


def test_identity_and_votes(spark):
    assert values(spark, scoring.repaired_id(F.col("v")), ["ABC12S45", "up/79/389/0654035", "UP793890654035", "AB", "HR-1234567", "UP\\79\\389\\0654035"]) == ["ABC12545", "UP/79/389/0654035", "UP/79/389/0654035", "AB", "HR1234567", "UP/79/389/0654035"]
    df = spark.createDataFrame([(["a", "b", "c", "d", "E", "1", None, "2"],), (["a", "1"],)], "r array<string>")
    assert [r[0] for r in df.select(scoring.vote(F.col("r"))).collect()] == [True, False]
    df = spark.createDataFrame([(["5", None, " ", "5"],), (["5", "6"],), ([],)], "r array<string>")
    assert [r[0] for r in df.select(scoring.agreed(F.col("r"))).collect()] == ["5", None, None]
    df = spark.createDataFrame([("1", "2"), ("12", "13"), ("12", "1"), ("123", "145"), ("7", "7")], "a string, b string")
    assert [r[0] for r in df.select(scoring.same_number(F.col("a"), F.col("b"))).collect()] == [False, True, True, False, True]
    df = spark.createDataFrame([(["x"],), (None,)], "r array<string>")
    assert [r[0] for r in df.select(scoring.flagged(F.col("r"), (F.lit(True), "x"), (F.lit(True), "y"), (F.lit(False), "z"))).collect()] == [["x", "y"], ["x", "y"]]
    assert values(spark, scoring.age_flag(F.col("v")), ["17", "18", "x", None]) == ["age_out_of_range", None, "age_absent", "age_absent"]


def test_words_for_times_and_sizes(spark):
    ms = F.col("v").cast("long")
    assert values(spark, display.duration(ms), ["125000", "59999", "60000", "3720000", "0", None]) == ["2 min 5 sec", "59 sec", "1 min", "1 hr 2 min", None, None]
    assert values(spark, display.remaining(ms), ["59", "150", "90", "3600", "3720", "-1", None]) == ["less than a minute left", "about 2 min left", "about 2 min left", "about 1 hr left", "about 1 hr 2 min left", None, None]
    assert values(spark, display.file_size(ms), ["500", "4781968", "1024", "0"]) == ["500 bytes", "4.6 MB", "1.0 KB", None]
    assert values(spark, display.local_time(F.col("v").cast("timestamp")), ["2024-01-14 18:30:00"]) == ["15 Jan 2024, 00:00:00 IST"]
    assert [str(x) for x in values(spark, display.local_midnight(F.col("v").cast("date")), ["2024-01-15"])] == ["2024-01-14 18:30:00"]
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:00:00.5"), ("2024-01-01 00:00:00", "2024-01-01 00:02:05"), ("2024-01-02 00:00:00", "2024-01-01 00:00:00")], "a string, b string")
    a, b = (F.col(c).cast("timestamp") for c in "ab")
    assert [r[0] for r in df.select(display.between(a, b)).collect()] == ["under a second", "2 min 5 sec", None]
    assert [r[0] for r in df.select(display.ago(a, F.lit("2024-01-03 00:00:00").cast("timestamp"))).collect()] == ["2 days ago", "2 days ago", "1 day ago"]


def test_cells(spark):
    assert values(spark, display.masked("epic_number", F.col("v")), ["ABC1234567", "ABC12", "AB", "", None]) == ["ABC1…67", "AB…2", "****", "—", "—"]
    assert values(spark, display.masked("note", F.col("v")), ["x" * 101, "short"]) == ["x" * 97 + "…", "short"]
    assert values(spark, display.cell("house_number_hi", F.col("v")), ["-", "12", None]) == ["Not provided in roll", "12", ""]
    assert values(spark, display.bool_word("is_deleted", F.col("v").cast("boolean")), ["true", "false", None]) == ["Deleted", "On the roll", ""]
    assert values(spark, display.backoff(F.col("v").cast("int"), 30), ["1", "3"]) == [30.0, 120.0]


def test_page_lists(spark):
    assert display.page_list("2, 4-6,5") == [2, 4, 5, 6]
    for bad in ("0", "6-4", "x", "1-"):
        with pytest.raises(ValueError):
            display.page_list(bad)
    assert values(spark, display.pages(F.col("v")), ["2, 4-6,5", "6-4", "x", "3"]) == [[2, 4, 5, 6], None, None, [3]]


def test_geography(spark):
    pts = [(float(x), float(y)) for x in (0, 10, 20) for y in (0, 10)]
    rows = [("good", x, y, 3 * x + y + 5, -x + 2 * y - 1) for x, y in pts] + [("few", x, y, x, y) for x, y in pts[:3]] + [("bad", x, y, x + (500 if x + y == 0 else 0), y) for x, y in pts] + [("line", float(i), float(i), float(i), float(i)) for i in range(5)]
    got = {r.k: r for r in geo.affine_fit(spark.createDataFrame(rows, "k string, x double, y double, east double, north double"), "k").collect()}
    assert got["good"].accepted and round(got["good"].a, 6) == 3 and round(got["good"].f, 6) == -1
    assert not got["few"].accepted and not got["bad"].accepted and not got["line"].accepted
    assert tuple(values(spark, geo.printed_coordinates(F.col("v")), ["Lat: 28.61391 Long: 77.20902"])[0]) == (28.61391, 77.20902)
    assert values(spark, geo.printed_coordinates(F.col("v")), ["Lat 28.61 Lon 77.2", "lat 98.12345 lon 1.12345"]) == [None, None]


def test_houses(spark):
    from docmill.functions import houses

    v = F.col("v")
    assert values(spark, houses.cleaned(v), ["हाऊस 5", "नं इ", "12, 13"]) == ["हाउस 5", "नं 1", "12 13"]
    assert values(spark, houses.is_noise(v), ["1(1+578182", "23(डी)", "124", "KHASRA #4", None]) == [True, False, False, False, False]
    df = spark.createDataFrame([(["132/10", "132 / 10", "x/9 1"],), (["/044", "/044"],), (["132/10", "133/10"],), (["इ 1/8", "इ 1/8"],), ([],)], "r array<string>")
    assert [r[0] for r in df.select(houses.slash_number(F.col("r"))).collect()] == ["132/10", "1/044", None, None, None]
    rows = [("124 KHASRA NUMBER", "124 khasra number"), ("KHASRA 4 AB", "KHASRA 4"), ("KHOLI", "KHOL"), ("1 24 KHASRA", "124 KHASRA"), ("UTTAR PRADESH", "UTTAR PRADESH"), ("", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(houses.agreed_line(F.col("a"), F.col("b"))).collect()] == ["124 KHASRA NUMBER", "KHASRA 4", None, "124 KHASRA", None, None]
    assert values(spark, houses.latin(v), ["इ-897", "47-ई-7", "12"]) == ["E-897", "47-E-7", "12"]
    assert values(spark, display.state_word(v), ["retry", "odd_one", None]) == ["Retrying", "odd one", None]
