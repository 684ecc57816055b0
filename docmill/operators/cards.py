"""Printed cards and covers: labelled text to fields, and readers' records to the wire contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.text import fold_digits, lenient_int, nfc, ratio, strip

# Labels as they are printed or read, the more specific ones before those that they contain.
CARD_LABELS = {
    "father": r"father'?s?\s+name|पिता(\s*का\s*नाम)?", "husband": r"husband'?s?\s+name|पति(\s*का\s*नाम)?", "mother": r"mother'?s?\s+name|माता(\s*का\s*नाम)?",
    "other": r"अन्य(\s*का\s*नाम)?", "house": r"मकान(\s*संख्या)?|\bhouse(\s*(no\.?|number))?", "age": r"आयु|\bage\b", "gender": r"लिंग|\b(gender|sex)\b",
    "serial": r"क्रमांक|क्रम\s*संख्या|\bserial(\s*no\.?)?|\bs\.?\s*no\.?", "name": r"नाम|\bname\b",
}
# What is printed on covers before each value.
COVER_WORDS = {
    "revision_year": ["पुनरीक्षण का वर्ष"], "qualifying_date": ["अर्हता तिथि", "अहर्ता तिथि", "अर्हता दिनांक"], "revision_type": ["पुनरीक्षण का प्रकार"],
    "publication_date": ["प्रकाशन की तिथि"], "village": ["मुख्य कस्बा अथवा ग्राम", "कस्बा अथवा ग्राम"], "ward": ["वार्ड संख्या", "वार्ड", "बार्ड"], "post_office": ["डाकघर"],
    "police_station": ["थाना"], "panchayat": ["पंचायत"], "block": ["ब्लॉक"], "tehsil": ["तहसील"], "district": ["जिला"], "pin_code": ["पिन कोड"],
}
#: Vowel signs that are read for each other.
ALIKE = ("िी", "ॉा")


def _label_pattern(words: list[str]) -> str:
    """Any of the labels, with any spaces between words and either of two like vowel signs."""
    sign = {c: f"[{pair}]" for pair in ALIKE for c in pair}
    return "|".join("".join(r"\s*" if c == " " else sign.get(c, c) for c in label) for label in words)


COVER_LABELS = {kind: _label_pattern(words) for kind, words in COVER_WORDS.items()}
TOTALS = ("start_serial", "end_serial", "male", "female", "third_gender", "total")
_OPEN, _CLOSE = "\u0001", "\u0002"


def _let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _labelled(text: Column, labels: dict[str, str]) -> Column:
    """The text with each label as OPEN kind CLOSE; where labels overlap, the one that is listed first counts."""
    out = F.translate(text, _OPEN + _CLOSE, "  ")
    for kind, pattern in labels.items():
        out = F.regexp_replace(out, f"(?i)(?<!{_OPEN})(?:{pattern})(?![a-z_]*{_CLOSE})", f"{_OPEN}{kind}{_CLOSE}")
    return out


def _value(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^[\s:：.\-+|]+", ""), r"[\s.;:|\-]+$", "")


def _fields(marked: Column) -> Column:
    """Map from kind to the first value that isn't blank."""
    pieces = F.filter(F.split(marked, _OPEN), lambda p, i: i > 0)
    pairs = F.transform(pieces, lambda p: F.struct(F.substring_index(p, _CLOSE, 1).alias("key"), _value(F.substring_index(p, _CLOSE, -1)).alias("value")))
    first = lambda full: F.filter(full, lambda p, i: F.array_position(F.transform(full, lambda q: q["key"]), p["key"]) == i + 1)
    return F.map_from_entries(_let(F.filter(pairs, lambda p: p["value"] != ""), first))


def card_fields(lines: Column) -> Column:
    """Map of a card's fields from its lines: a label's value ends at the next label or the line's end, and the first value counts."""
    each = F.transform(lines, lambda line: _fields(_labelled(line, CARD_LABELS)))
    return F.aggregate(each, F.create_map().cast("map<string,string>"), lambda acc, m: F.map_concat(F.map_filter(m, lambda k, v: ~F.map_contains_key(acc, k)), acc))


def card_records(cards: DataFrame) -> DataFrame:
    """Reader records of cards (page_number, card_index, id_card_no, lines)."""
    f = lambda k: F.coalesce(F.try_element_at("fields", F.lit(k)), F.lit(""))
    rows = cards.withColumn("lines", F.transform("lines", lambda x: x)).withColumn("fields", card_fields(F.col("lines")))
    split = names.parts(f("name"))
    age = F.regexp_extract(fold_digits(f("age")), r"\d{1,3}", 0).try_cast("int")
    gender = {"third": "तृतीय लिंग", "female": "महिला", "male": "पुरुष"}
    bucket = names.gender_bucket(f("gender"))
    kind = F.coalesce(*[F.when(f(k) != "", F.lit(k)) for k in ("father", "husband", "mother", "other")])
    return rows.select(
        "page_number", "card_index", "id_card_no", *[F.coalesce(split[a], F.lit("")).alias(f"voter_{b}_name") for a, b in (("first", "first"), ("middle", "middle"), ("last", "sur"))],
        f("house").alias("house_no"), F.when(age.between(1, 120), age.cast("string")).otherwise("").alias("age"), F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in gender.items() for x in p]), bucket), F.lit("")).alias("gender"),
        F.regexp_extract(fold_digits(f("serial")), r"\d+", 0).alias("voter_sr_no"), names.relation_printed(kind).alias("relation_name"),
        *[F.when(kind == k, f(k)).alias(f"voter_{k}_first_name") for k in ("father", "husband", "mother", "other")],
        F.when((f("house") != "") | (f("age") != ""), 0.8).otherwise(0.6).alias("confidence"),
    )


def normal_lines(lines: Column) -> Column:
    """Lines in composed Unicode form, as labels are written; this passes through Python once per card."""
    return F.split(nfc(F.array_join(lines, "\n")), "\n")


def cover_facts(text: Column) -> Column:
    """Struct of a cover's labelled facts; a value ends at the next label or line end."""
    clean = F.translate(text, "‌‍", "")
    marked = F.regexp_replace(_labelled(clean, COVER_LABELS), r"\n", f"{_OPEN}end{_CLOSE}")
    made = F.struct(_fields(marked).alias("fields"), fold_digits(clean).alias("clean"))
    return _let(made, _cover_struct)


def _cover_struct(made: Column) -> Column:
    fields, clean = made["fields"], made["clean"]
    get = lambda k: F.try_element_at(fields, F.lit(k))
    number = lambda c: F.regexp_extract(fold_digits(c), r"\d+", 0).try_cast("int")
    date = lambda k: F.regexp_replace(F.regexp_extract(fold_digits(get(k)), r"\d{1,2}\s*[-/.]\s*\d{1,2}\s*[-/.]\s*\d{4}", 0), r"\s", "")
    ac = F.regexp_extract(clean, r"विधानसभा[^\n:]*:\s*([^\n]*)", 1)
    pin = F.regexp_replace(fold_digits(get("pin_code")), r"\D", "")
    station = F.regexp_extract(clean, r"मतदान\s*(?:स्थल|केंद्र|केन्द्र)\s*की\s*संख्या[^\n]*?(\d{1,4}\s*[-–—]\s*[^\n]+)", 1)
    return F.struct(
        number(get("revision_year")).alias("revision_year"), F.nullif(date("qualifying_date"), F.lit("")).alias("qualifying_date"), F.nullif(date("publication_date"), F.lit("")).alias("publication_date"),
        get("revision_type").alias("revision_type"), F.nullif(F.regexp_extract(ac, r"^(\d+)", 1), F.lit("")).alias("ac_code"),
        F.nullif(strip(F.regexp_extract(ac, r"^\d+\s*[-–—]?\s*([^(\n]*)", 1)), F.lit("")).alias("ac_name"), F.nullif(F.regexp_extract(ac, r"\(([^)]*)\)", 1), F.lit("")).alias("ac_reservation"),
        F.regexp_extract(clean, r"भाग\s*संख्या[ \t:：]*(\d+)", 1).try_cast("int").alias("part_number"), F.regexp_extract(clean, r"कुल\s*पृष्ठ[ \t:：]*(\d+)", 1).try_cast("int").alias("total_pages"),
        F.nullif(F.regexp_extract(station, r"^(\d+)", 1), F.lit("")).alias("polling_station_number"), F.nullif(strip(F.regexp_extract(station, r"[-–—]\s*(.+)$", 1)), F.lit("")).alias("polling_station_name"),
        F.when(F.length(pin) >= 6, F.right(pin, F.lit(6))).alias("pin_code"),
        *[get(k).alias(k) for k in ("village", "ward", "post_office", "police_station", "panchayat", "block", "tehsil", "district")],
    )


def _fold(name: Column) -> Column:
    return F.regexp_replace(F.translate(F.coalesce(name, F.lit("")), "ँ", ""), "[^ऀ-ॿ0-9]", "")


def _grams(text: Column, n: int, kind: str) -> Column:
    """Runs of n characters after a letter for their kind, each with the number of equal ones before it, so that common ones count as often as both texts have them."""
    runs = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substr(text, i, F.lit(n)))
    every = F.when(F.length(text) >= n, runs).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(every), lambda e: F.transform(e, lambda g, i: F.concat(F.lit(kind), g, F.size(F.filter(F.slice(e, F.lit(1), i), lambda h: h == g)).cast("string"))))[0]


#: Folded names of more characters than this are long: two of them that are alike share pairs of characters.
SHORT = 3


def alike_names(reads: DataFrame, listed: DataFrame, group: str, least: float = 0.82) -> DataFrame:
    """Pairs (group, read, name, sure) of distinct texts of reads (group, read) and listed (group, name) that can be equal, contained or alike to ``least``.

    Texts meet through an inverted index of their characters and pairs of them, not all with all.
    Where the ratio 2 * m / t of m matched characters to t in both is ``least`` or
    more, t - 2 * m characters at most aren't matched, and so many and one more
    blocks can have been matched, which hold 3 * m - t - 1 pairs of neighbours or more; pairs of
    texts with fewer, or of too unlike lengths, aren't kept. A text that holds the other
    is ``sure``. Nothing that is alike is lost.
    """
    long = lambda c: F.length(c) > SHORT
    one, two = F.col("read"), F.col("name")
    mine = reads.where(F.length("read") > 0).distinct().withColumn("__g", F.when(long(one), F.concat(_grams(one, 2, "p"), _grams(one, 1, "s"))).otherwise(_grams(one, 1, "c")))
    theirs = listed.where(F.length("name") > 0).distinct().withColumn("__g", F.concat(_grams(two, 2, "p"), _grams(two, 1, "c"), F.when(~long(two), _grams(two, 1, "s")).otherwise(F.array().cast("array<string>"))))
    met = mine.select(group, "read", F.explode("__g").alias("__g")).join(theirs.select(group, "name", F.explode("__g").alias("__g")), [group, "__g"])
    shared = met.groupBy(group, "read", "name").agg(F.count_if(F.col("__g").startswith("p")).alias("__n"))
    t, sure = F.length("read") + F.length("name"), F.contains(two, one) | F.contains(one, two)
    sized = 2 * F.least(F.length("read"), F.length("name")) >= least * t
    enough = (F.col("__n") >= F.ceil((1.5 * least - 1) * t - 1 - 1e-9)) | ~long(one) | ~long(two)
    return shared.where(sure | (sized & enough)).select(group, "read", "name", sure.alias("sure"))


def page_sections(pages: DataFrame, entries: DataFrame, document: str, least: float = 0.82) -> DataFrame:
    """Pages (document, page, code, name) with the section of the cover's list (document, code, name).

    A page's code counts if the list has it. Else the name does, folded to
    Devanagari letters and digits, where exactly one entry equals it, contains
    it, is contained in it, or is alike to ``least``. Else the name stays as
    read, with a reason. Each name that a document has is matched once, however
    many pages have it, and the ratio is made only for pairs that ``alike_names`` leaves open.
    """
    listed = entries.where(F.trim(F.coalesce("name", F.lit(""))) != "").select(document, F.col("code").alias("__code"), F.col("name").alias("__name"), _fold(F.col("name")).alias("__fold"))
    by_code = listed.groupBy(document, F.col("__code").alias("code")).agg(F.max("__name").alias("__by_code"))
    keyed = pages.withColumn("__read", _fold(F.col("name"))).join(by_code, [document, "code"], "left")
    open_ = keyed.where("__by_code IS NULL").select(document, F.col("__read").alias("read"))
    pairs = alike_names(open_, listed.select(document, F.col("__fold").alias("name")), document, least)
    sure = pairs.where("sure")
    rated = pairs.where("NOT sure").where(ratio(F.col("name"), F.col("read")) >= least)
    alike = sure.unionByName(rated).select(document, F.col("read").alias("__read"), F.col("name").alias("__fold"))
    near = alike.join(listed, [document, "__fold"]).groupBy(document, "__read").agg(F.count("*").alias("__n"), F.max(F.struct("__code", "__name")).alias("__near"))
    found = keyed.join(near, [document, "__read"], "left")
    known, one = F.col("__by_code").isNotNull(), F.coalesce(F.col("__n") == 1, F.lit(False))
    return found.select(
        document, "page",
        F.when(known, F.col("code")).when(one, F.col("__near.__code")).otherwise("").alias("code"),
        F.when(known, F.col("__by_code")).when(one, F.col("__near.__name")).otherwise(F.col("name")).alias("name"),
        F.when(~known & ~one, "not_in_the_cover_list").alias("reason"),
    )


def adapted(records: DataFrame, page_from: str, page_to: str) -> DataFrame:
    """Reader records (one row each, position n within the reply) in the contract's shape; pages outside the range move to the nearest one."""
    page = F.coalesce(lenient_int(F.col("page_number").cast("string")), F.col(page_from))
    index = lenient_int(F.col("card_index").cast("string"))
    kind = names.relation_key(F.col("relation_name"))
    relative = F.coalesce(*[names.join(F.when(kind == k, F.col(f"voter_{k}_first_name"))) for k in ("father", "husband", "mother", "other")])
    return records.select(
        F.least(F.greatest(page, F.col(page_from)), F.col(page_to)).alias("page_number"), F.coalesce(index + 1, F.col("n")).alias("row_number"),
        names.join(F.col("voter_first_name"), F.col("voter_middle_name"), F.col("voter_sur_name")).alias("name"), relative.alias("relative_name"),
        F.col("house_no").alias("house_number"), "gender", F.col("n").alias("serial_number"), F.col("id_card_no").alias("epic_number"), lenient_int(F.col("age")).alias("age"), kind.alias("relationship_type"), "confidence",
    )
