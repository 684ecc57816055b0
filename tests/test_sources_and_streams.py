import hashlib
import io
import json
import zipfile

from pyspark.sql import functions as F

from docmill.sources import files, sinks
from docmill.streaming import events


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def test_discovery_and_watching(spark, tmp_path):
    put(tmp_path / "in/a.pdf", b"%PDF-1")
    put(tmp_path / "in/sub/b.pdf", b"%PDF-2")
    put(tmp_path / "in/.hidden/c.pdf", b"%PDF-3")
    put(tmp_path / "in/d.txt", b"x")
    got = {r.relative_path: r for r in files.discovered(spark, str(tmp_path / "in")).collect()}
    assert set(got) == {"a.pdf", "sub/b.pdf"}
    digest = hashlib.sha256(b"%PDF-2").hexdigest()
    assert got["sub/b.pdf"].identity == f"sub/b.pdf#{digest}" and got["sub/b.pdf"].file_name == "b.pdf" and got["a.pdf"].length == 6
    q = files.watched(spark, str(tmp_path / "in")).select("relative_path").writeStream.format("memory").queryName("watched").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r[0] for r in spark.table("watched").collect()} == {"a.pdf", "sub/b.pdf"}


def test_archives(spark, tmp_path):
    def archive(*entries):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in entries:
                z.writestr(name, data)
        return out.getvalue()

    link = zipfile.ZipInfo("link.pdf")
    link.external_attr = 0o120777 << 16
    rows = [("one", archive(("a.pdf", b"%PDF-x"), ("../b.pdf", b"%PDF-"), ("c.pdf", b"nope"), ("d.txt", b""), (link, b"%PDF-"))), ("two", b"junk"), ("three", archive(("x.txt", b"")))]
    got = {(r.archive, r.name): (r.problem, None if r.content is None else bytes(r.content)) for r in files.archive_members(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got == {("one", "a.pdf"): (None, b"%PDF-x"), ("one", "../b.pdf"): ("unsafe path", None), ("one", "c.pdf"): ("bad magic", None), ("one", "link.pdf"): ("symlink", None), ("two", None): ("not a zip", None), ("three", None): ("no pdf", None)}
    ledger = spark.createDataFrame([("b", "k", "1")], "bucket string, key string, etag string")
    assert files.not_ingested(spark.createDataFrame([("b", "k", "1"), ("b", "k", "2")], "bucket string, key string, etag string"), ledger).count() == 1


def test_uploads(spark):
    rows = [(1, "a.pdf", 10, b"%PDF-"), (1, "../b.pdf", 10, b"%PDF-"), (2, "ﬁle.pdf", 10, b"%PDF-"), (3, "x.pdf", 60, b"%PDF-"), (3, "y.pdf", 60, b"%PDF-"), (4, "z.pdf", 10, b"GIF89")]
    got = files.checked_uploads(spark.createDataFrame(rows, "batch int, name string, length long, head binary"), 100, 100).collect()
    assert {(r.batch, r.name): (r.problem, r.accepted) for r in got} == {(1, "a.pdf"): (None, False), (1, "../b.pdf"): ("unsafe name", False), (2, "file.pdf"): (None, True), (3, "x.pdf"): ("batch too large", False), (3, "y.pdf"): ("batch too large", False), (4, "z.pdf"): ("not a pdf", False)}


def test_catalogue(spark, tmp_path):
    row = dict.fromkeys(files.CATALOGUE_KEYS, "x") | {"state_code": " s24 ", "ac_code": "007"}
    (tmp_path / "a.json").write_text(json.dumps({"sections": [row, row | {"source_url": ""}]}))
    (tmp_path / "b.json").write_text(json.dumps([row]))
    for name in ("a.json", "b.json"):
        got = files.catalogue(spark, str(tmp_path / name)).collect()
        assert [(r.state_code, r.ac_code) for r in got] == [("S24", "7")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "राम", True), (2, None, False)], "id int, name string, is_deleted boolean")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("part-*")).read_bytes()
    assert text.startswith("﻿id,name,is_deleted\n".encode()) and "राम" in text.decode()
    rows = list(sinks.workbook_rows(df, {"name": "Name"}, "is_deleted"))
    assert rows[0] == ("id", "Name", "is_deleted", "__deleted") and rows[1] == (1, "राम", "Deleted", True)
    page = [json.loads(r.value) for r in sinks.json_page(df, "is_deleted").collect()]
    assert page[0]["__raw_name"] == "राम" and page[0]["__deleted"] is True and page[1]["name"] == ""
    sinks.write_report(df.agg(F.count("*").alias("n")), df, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report/rows")).count() == 2
    records = spark.createDataFrame([(7, "x"), (8, "y")], "session int, v string")
    tries = spark.createDataFrame([(7, 2)], "session int, attempt_number int")
    assert sinks.attempt_rows(records, tries, "session", "attempt_number").columns[0] == "attempt"


def test_streams(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src.orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 250).parquet(str(tmp_path / "events"))
    stream = events.event_stream(spark, str(tmp_path / "events"))
    q = events.hourly_counts(stream, "40 days").writeStream.format("memory").outputMode("complete").queryName("hours").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.hour, r.event_type): r.n for r in spark.table("hours").collect()}
    want = {(r.hour, r.event_type): r.n for r in src.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert got == want
    for k in (1, 2):  # a second run, and a third from scratch, write nothing twice
        for cp in ("c2", f"c2-{k}"):
            events.append_once(events.event_stream(spark, str(tmp_path / "events"), 100), str(tmp_path / "out"), str(tmp_path / cp), ["event_id"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == src.count()
    assert events.rolling_counts(src).count() > 0 and events.sessions(src).count() > 0


def test_dispatch(spark):
    t = "2024-01-01 00:00:00"
    rows = [(1, "pending", None, t, 1), (2, "retry", "2024-01-02 00:00:00", t, 1), (3, "retry", "2023-12-31 00:00:00", t, 2), (4, "done", None, t, 1)]
    df = spark.createDataFrame(rows, "unit_id int, status string, next_retry_at string, queued_at string, attempt_count int").withColumn("next_retry_at", F.col("next_retry_at").cast("timestamp"))
    now = F.lit(t).cast("timestamp")
    assert [r.unit_id for r in events.dispatched(df, 5, now).collect()] == [1, 3] and events.dispatched(df, -1, now).count() == 0
    out = {r.unit_id: (r.status, str(r.next_retry_at)) for r in events.retried(df, now, 30, 2).collect()}
    assert out[1] == ("retry", "2024-01-01 00:00:30") and out[3] == ("failed", "None")
