import gzip
import hashlib
import io

import pytest

from docmill.llm import warc
from docmill.llm.workspace import Workspace

BIG = "<p>ä " + "x" * 2000


def pages(spark):
    rows = [(1, "http://a/ b%20\r\nc", BIG), (2, None, BIG), (3, "http://c/", "short"), (4, "http://d/", "short"), (5, "http://e/", None), (6, "", ""), (None, "http://n/", BIG), (7, "http://g/", BIG + "!"),
            (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40), (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40), (9, "v", "q" * 3_000_000)]
    return rows, spark.createDataFrame([r + ("x", "y") for r in rows], "page_id long, url string, html string, payload string, record_type string")


def test_round_trip(spark):
    rows, df = pages(spark)
    path = Workspace(spark, "test").path("archives")
    warc.write_archives(warc.to_records(df.repartition(3)), path)
    back = warc.read_archives(spark, path).where("record_type IN ('response', 'revisit')").collect()
    assert len(back) == len(rows)
    by = {}
    for r in back:
        by.setdefault(r.record_id, []).append(r)
    for i, url, html in rows:
        body = (html or "").encode()
        for r in by[f"urn:x-page:{'null' if i is None else i}"]:
            assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha1(body).hexdigest() and r.target_uri == url
            if r.record_type == "response":
                assert bytes(r.payload) == body
            else:
                assert r.payload is None or not r.payload
    kinds = {k: {(r.record_type, r.refers_to) for r in v} for k, v in by.items()}
    assert kinds["urn:x-page:1"] == {("revisit", "urn:x-page:2")} and kinds["urn:x-page:2"] == {("response", None)} and kinds["urn:x-page:null"] == {("revisit", "urn:x-page:2")}
    assert kinds["urn:x-page:3"] == kinds["urn:x-page:4"] == {("response", None)} and kinds["urn:x-page:8"] == {("response", None)}


def test_payload_option_and_predicates(spark):
    _, df = pages(spark)
    path = Workspace(spark, "test").path("archives")
    warc.write_archives(warc.to_records(df), path)
    none = warc.read_archives(spark, path, payload="none")
    assert none.where("payload IS NOT NULL").count() == 0
    picked = none.where("record_type = 'revisit' AND record_id IN ('urn:x-page:1', 'urn:x-page:2')")
    assert [r.record_id for r in picked.collect()] == ["urn:x-page:1"]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "= revisit" not in plan and " IN (" not in plan  # both are tested by the reader
    assert none.where("record_type = 'warcinfo'").count() >= 1


def test_foreign_files():
    record = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:r:%d>\r\nContent-Type: text/plain\r\nX-Folded: a\r\n b\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    made = [record % (t, i, len(b), b) for i, (t, b) in enumerate([(b"response", b"abc"), (b"request", b"y" * 200_000), (b"response", b""), (b"metadata", b"\r\n\r\n")])]
    everything = lambda h: (h["warc-type"] != "request", h["warc-type"] == "response")
    for data, zipped in ((b"".join(made), False), (b"".join(gzip.compress(m) for m in made), True), (b"".join(warc.member(m) for m in made), True)):
        got = list(warc.records(io.BytesIO(data), zipped, everything))
        assert [(h["warc-record-id"], b) for _, h, b in got] == [("<urn:r:0>", b"abc"), ("<urn:r:2>", b""), ("<urn:r:3>", None)]
        assert got[0][1]["x-folded"] == "a b"
    assert [len(gzip.decompress(warc.member(m))) for m in made] == [len(m) for m in made]


def test_unwanted_members_are_not_inflated(monkeypatch):
    body = warc.member(b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 9000000\r\n\r\n" + b"z" * 9_000_000)
    broken = body[:-200] + b"\xff" * 192 + body[-8:]  # would fail to inflate
    data = broken + warc.member(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")
    got = list(warc.records(io.BytesIO(data), True, lambda h: (h["warc-type"] == "response", True)))
    assert [b for *_, b in got] == [b"ok"]


def test_empty(spark):
    _, df = pages(spark)
    path = Workspace(spark, "test").path("archives")
    warc.write_archives(warc.to_records(df.limit(0)), path)
    assert warc.read_archives(spark, path).where("record_type <> 'warcinfo'").count() == 0


def test_members_with_several_records():
    record = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:r:%d>\r\nContent-Type: text/plain\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    blocks = [(b"response", b"abc"), (b"request", b"\r\n\r\nWARC/1.0\r\n" * 30_000), (b"response", b"z" * 300_000), (b"response", b""), (b"metadata", b"\r\n\r\n")]
    made = [record % (t, i, len(b), b) for i, (t, b) in enumerate(blocks)]
    everything = lambda h: (h["warc-type"] != "request", h["warc-type"] == "response")
    want = [("<urn:r:0>", b"abc"), ("<urn:r:2>", b"z" * 300_000), ("<urn:r:3>", b""), ("<urn:r:4>", None)]
    one = gzip.compress(b"".join(made))
    two = gzip.compress(b"".join(made[:2])) + warc.member(made[2]) + gzip.compress(b"".join(made[3:]))
    for data in (one, two):
        assert [(h["warc-record-id"], b) for _, h, b in warc.records(io.BytesIO(data), True, everything)] == want
    for cut in (one[:-30], gzip.compress(b"".join(made)[:-20]), gzip.compress(made[0] + made[1][:60])):
        with pytest.raises(ValueError, match="cut off"):
            list(warc.records(io.BytesIO(cut), True, everything))
