from pyspark.sql import functions as F

from docmill.functions import guards
from docmill.operators import cards, locations


def test_card_lines(spark):
    rows = [
        (3, 0, "ABC1234567", ["नाम : राम लाल", "पिता का नाम: श्याम", "मकान संख्या : 12/3 आयु : ४५ लिंग : पुरुष", "नाम : दूसरा"]),
        (3, 1, "ABC1234568", ["Name: Kate Ann Bell", "Husband's Name : Paul", "House No. : 7", "Age : 200 Gender : Female", "Serial No. 9"]),
        (3, 2, "", []),
    ]
    df = spark.createDataFrame(rows, "page_number int, card_index int, id_card_no string, lines array<string>")
    a, b, c = cards.card_records(df.withColumn("lines", cards.normal_lines(F.col("lines")))).orderBy("card_index").collect()
    assert (a.voter_first_name, a.voter_sur_name, a.voter_father_first_name, a.relation_name, a.house_no, a.age, a.gender, a.confidence) == ("राम", "लाल", "श्याम", "पिता", "12/3", "45", "पुरुष", 0.8)
    assert (b.voter_first_name, b.voter_middle_name, b.voter_sur_name, b.voter_husband_first_name, b.house_no, b.age, b.gender, b.voter_sr_no) == ("Kate", "Ann", "Bell", "Paul", "7", "", "महिला", "9")
    assert (c.voter_first_name, c.confidence, c.relation_name) == ("", 0.6, None)
    n = spark.createDataFrame([(9, None, "Ram", None, "Lal", "पिता", "Shyam", "5", "x", 4, "30", 0.5)], "page_number int, card_index int, voter_first_name string, voter_middle_name string, voter_sur_name string, relation_name string, voter_father_first_name string, house_no string, id_card_no string, n int, age string, confidence double")
    n = n.withColumns({f"voter_{k}_first_name": F.lit(None).cast("string") for k in ("husband", "mother", "other")}).withColumns({"gender": F.lit("पुरुष"), "a": F.lit(3), "b": F.lit(7)})
    got = cards.adapted(n, "a", "b").first()
    assert (got.page_number, got.row_number, got.name, got.relative_name, got.relationship_type, got.age) == (7, 4, "Ram Lal", "Shyam", "father", 30)


def test_cover(spark):
    text = "विधानसभा क्षेत्र : 53 - लोनी (सामान्य)\nभाग संख्या : 107\nपुनरीक्षण का वर्ष : 2026\nअर्हता तिथि : 01-01-2026 प्रकाशन की तिथि : 10 / 01 / 2026\nजिला : गाजियाबाद पिन कोड : 2 201102\nमतदान स्थल की संख्या : 12 - राजकीय विद्यालय\nकुल पृष्ठ : 29\nथाना :\nतहसील : लोनी"
    r = spark.createDataFrame([(text,)], "t string").select(cards.cover_facts(F.col("t")).alias("c")).first().c
    assert (r.ac_code, r.ac_name, r.ac_reservation, r.part_number, r.revision_year) == ("53", "लोनी", "सामान्य", 107, 2026)
    assert (r.qualifying_date, r.publication_date, r.district, r.pin_code, r.total_pages) == ("01-01-2026", "10/01/2026", "गाजियाबाद", "201102", 29)
    assert (r.polling_station_number, r.polling_station_name, r.police_station, r.tehsil) == ("12", "राजकीय विद्यालय", None, "लोनी")


def test_page_sections(spark):
    entries = spark.createDataFrame([("d", "1", "लोनी देहात"), ("d", "2", "राम नगर"), ("e", "1", "राम नगर एक"), ("e", "2", "राम नगर दो")], "doc string, code string, name string")
    pages = spark.createDataFrame([("d", 3, "2", "x"), ("d", 4, "41", "लोनी देहात"), ("d", 5, "9", "कुछ"), ("e", 3, "", "राम नगर"), ("f", 1, "1", "y")], "doc string, page int, code string, name string")
    got = {(r.doc, r.page): (r.code, r.name, r.reason) for r in cards.page_sections(pages, entries, "doc").collect()}
    assert got["d", 3] == ("2", "राम नगर", None) and got["d", 4] == ("1", "लोनी देहात", None)
    assert got["d", 5] == ("", "कुछ", "not_in_the_cover_list") and got["e", 3][2] and got["f", 1][2]


def test_locations(spark):
    df = spark.createDataFrame([("Google Map",), ("Nazri naksha",), ("मतदान केन्द्र",), ("other",)], "h string")
    assert [r[0] for r in df.select(locations.category(F.col("h"))).collect()] == ["google_location_map", "nazri_map", "polling_station_photo", "visual_image"]
    df = spark.createDataFrame([("Govt. Pri. Sch. Loni",), ("राम",), (None,)], "n string")
    got = [r[0] for r in df.select(locations.variants(F.col("n"))).collect()]
    assert got == [["Govt. Pri. Sch. Loni", "Government Primary School Loni"], ["राम", "Ram"], []]
    assert spark.range(1).select(locations.search_text(F.lit("A"), F.lit(" a "), F.lit(None).cast("string"), F.lit("India"))).first()[0] == "A, India"
    rows = [("Loni School, Ghaziabad, Uttar Pradesh, India", "in", "Government School Loni"), ("Ghaziabad, Uttar Pradesh, India", "in", "Government School Loni"), ("Loni, France", "fr", "Loni")]
    df = spark.createDataFrame(rows, "f string, c string, s string")
    got = [tuple(r[0]) for r in df.select(locations.fit(F.col("f"), F.col("c"), F.array(F.lit("Uttar Pradesh")), F.lit("Ghaziabad"), F.col("s"))).collect()]
    assert got == [(4, True), (3, False), (1, False)]


def test_guards(spark):
    rows = [("राम", "Ram"), ("राम", ""), ("राम", "राm"), ("राम", "Kr ̣"), ("x", "limit of the limit of the limit of the limit"), ("x", "bhikkum....."), ("आकाश", "The sky"), ("अ", "x y" * 9), ("गली 8", "Gali"), ("", "Gali 8")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(guards.reasons(F.col("a"), F.col("b"))).collect()]
    assert got[0] == [] and got[1] == ["empty"] and "devanagari residue" in got[2] and "orphan combining marks" in got[3] and "degenerate repetition" in got[4]
    assert "degenerate repetition" in got[5] and got[6] == ["meaning drift"] and "runaway length" in got[7] and got[8] == ["digits lost"] and got[9] == []
