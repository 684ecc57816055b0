import io
import zipfile
from xml.etree import ElementTree

from pyspark.sql import functions as F

from docmill.functions import rolls, scoring, text
from docmill.operators import browse, changes
from docmill.operators.aggregates import consensus
from docmill.sources import files, sinks


def test_file_names(spark):
    rows = [("2026-EROLLGEN-S24-53-SIR-FinalRoll-Revision1-HIN-107-WI.pdf",), ("a/b/2026-erollgen-s24-53-sir-draftroll-revision2-hin-7-wi.PDF",), ("2026-EROLLGEN-S24-53-WI.pdf",), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "n string").select(rolls.file_name_parts(F.col("n"))).collect()]
    assert tuple(got[0]) == (2026, "S24", 53, "final", 1, "HIN", 107) and tuple(got[1]) == (2026, "S24", 53, "draft", 2, "HIN", 7) and got[2:] == [None] * 3
    rows = [(7, "x-HIN-107-WI.pdf"), (107, "x-107-WI.pdf"), (5, "scan.pdf"), (None, "x-9-WI.pdf"), (None, None)]
    got = [tuple(r[0]) for r in spark.createDataFrame(rows, "c int, n string").select(rolls.part_number(F.col("c"), F.col("n"))).collect()]
    assert got == [(107, "filename", 7, 107), (107, "cover", None, 107), (5, "cover", None, None), (9, "filename", None, 9), (None, "cover", None, None)]


def test_agreement(spark):
    rows = [(["19", "19"], None), (["19", "49"], "19"), (["19"], "19"), (["19"], None), ([], "30"), (["7", None, "x"], "30"), (["19"], "20")]
    df = spark.createDataFrame(rows, "r array<string>, t string")
    assert [r[0] for r in df.select(rolls.agreed_age(F.col("r"), F.col("t"))).collect()] == ["19", None, "19", None, "30", "30", None]
    known = F.array(F.lit("3"), F.lit("12"))
    df = spark.createDataFrame([(["43", "12"],), (["43"],), (["99"],), ([],), (None,)], "r array<string>")
    assert [r[0] for r in df.select(rolls.section_code(F.col("r"), known)).collect()] == ["12", "3", "", "", ""]
    df = spark.createDataFrame([("12", ["12", "7"]), ("12", ["34", "34"]), ("12", ["7", "56", None]), ("12", ["7", ""])], "n string, r array<string>")
    assert [r[0] for r in df.select(rolls.number_vote(F.col("n"), F.col("r"))).collect()] == ["12", "34", "56", None]
    df = spark.createDataFrame([("", "7"), ("", ""), (None, "7"), (" ", "1"), ("12", "12")], "a string, b string")
    assert [r[0] for r in df.select(scoring.same_number(F.col("a"), F.col("b"))).collect()] == [False, False, False, False, True]
    assert spark.range(1).select(text.fold_stress(text.fold_lookalikes(F.lit("Кн॑")))).first()[0] == "कнं"


def test_changes(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7)], "k int, s string, n int")
    new = spark.createDataFrame([(2, None), (9, "z")], "k int, s string")
    assert sorted(map(tuple, changes.updated(rows, new, ["k"], ["s"]).collect())) == [(1, "a", 5), (2, None, 6), (3, None, 7)]
    kids = spark.createDataFrame([(1, "busy"), (2, "done"), (None, "done")], "p int, state string")
    chosen = changes.deletable(rows.select("k"), kids, "k", "p", F.col("state") == "busy")
    assert {r.k: r.refused for r in chosen.collect()} == {1: True, 2: False, 3: False}
    assert sorted((r.p or 0) for r in changes.without(kids, chosen.where("NOT refused"), "k", "p").collect()) == [0, 1]
    assert tuple(changes.insert_counts(rows, rows.where("k = 1"), ["k"], [F.col("n")]).first()) == (3, 2, 1)


def test_consensus_counts_pages_with_a_value(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("b", 1, None), ("c", 1, "x"), ("c", 2, "y"), ("d", 1, "x")], "d string, p int, v string")
    got = {r.d: (r.v, r.pages, r.reason) for r in consensus(rows, ["d"], "p", "v", 2).collect()}
    assert got == {"a": ("x", 2, None), "b": (None, 0, "absent"), "c": (None, 2, "conflict"), "d": (None, 1, "too_few_pages")}


def _sheets(path):
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    out = {}
    with zipfile.ZipFile(path) as z:
        names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{ns['m']}}}sheet")]
        for i, name in enumerate(names, 1):
            rows = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{i}.xml")).findall(".//m:row", ns)
            out[name] = [([("".join(c.itertext()) or None) for c in r], {c.get("s") for c in r}) for r in rows]
    return out


def test_workbooks(spark, tmp_path):
    df = spark.createDataFrame([(1, "राम <&>", True), (2, None, False)], "k int, name string, is_deleted boolean").orderBy("k")
    seen = []
    assert sinks.write_workbook(df, f"{tmp_path}/a.xlsx", {"name": "Name"}, "is_deleted", seen.append) == 2
    sheet = _sheets(f"{tmp_path}/a.xlsx")["Records"]
    assert sheet == [(["k", "Name", "is_deleted"], {None}), (["1", "राम <&>", "Deleted"], {"1"}), (["2", None, "On the roll"], {None})]
    review = sinks.review_summary(spark.createDataFrame([("d", ["x", "y"]), ("d", ["x"])], "doc string, reasons array<string>"), "doc", "reasons").orderBy("reason")
    counts = sinks.write_documents_workbook({"one/1": df, "one:1": df.where("k = 1")}, review, f"{tmp_path}/b.xlsx", ["name", "missing"], "is_deleted")
    assert counts == {"one/1": 2, "one:1": 1}
    book = _sheets(f"{tmp_path}/b.xlsx")
    assert list(book) == ["one_1", "one_1 2", "Review summary"] and [r[0] for r in book["Review summary"]] == [["doc", "reason", "n"], ["d", "x", "2"], ["d", "y", "1"]]
    assert [r[0] for r in book["one_1"]] == [["name"], ["राम <&>"], [None]] and book["one_1"][1][1] == {"1"}
    sinks.write_found(df, browse.Table(("k", "name"), ("name",)), f"{tmp_path}/c", "राम", [F.col("k") < 5])
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").count() == 1


def test_export_choices():
    got = browse.export_choices(("a", "name_hi", "voter_first_name_en"), "hi", ("a",))
    assert got == [("a", "common", True, False, False), ("name_hi", "hi", False, True, False), ("voter_first_name_en", "en", True, False, True)]


def test_a_damaged_member_is_named(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("good.pdf", b"%PDF-1 fine")
        z.writestr("bad.pdf", b"%PDF-1 spoilt")
    data = out.getvalue().replace(b"%PDF-1 spoilt", b"%PDF-1 sp0ilt", 1)
    got = {r.name: r.problem for r in files.archive_members(spark.createDataFrame([("a.zip", bytearray(data))], "path string, content binary")).collect()}
    assert got["good.pdf"] is None and got["bad.pdf"].startswith("damaged")
