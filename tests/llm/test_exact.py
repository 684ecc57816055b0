import hashlib

from docmill.llm import exact
from docmill.llm.workspace import Workspace

from .helpers import odd_docs


def test_odd_rows(spark):
    got = {}
    for r in exact.exact_dedup(odd_docs(spark)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [len(got[i]) for i in (1, 2, 3, 4, 5, 6, None)] == [1, 1, 1, 1, 1, 2, 1]
    assert (got[1][0].keep_id, got[1][0].kept, got[2][0].kept, got[2][0].group_size) == (2, False, True, 2)
    assert {got[i][0].keep_id for i in (3, 4, 8)} == {8} and got[3][0].group_size == 3
    assert all(r.kept and r.group_size == 2 for r in got[6])
    assert got[None][0].kept and got[None][0].keep_id is None
    assert got[4][0].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_rows_that_stay(spark):
    docs = odd_docs(spark)
    out = exact.drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, i) for i in (2, 5, 6, 7, 8, 9)] + [(True, 0)]


def test_index_lasts(spark):
    path = Workspace(spark, "test").path("index")
    schema = "doc_id long, text string"
    index = exact.DigestIndex(spark, path, 8)
    first = exact.exact_dedup(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], schema), index)
    assert {r.doc_id: r.keep_id for r in first.collect()} == {1: 2, 2: 2, 3: 3}
    again = exact.DigestIndex(spark, path, 8)
    second = exact.exact_dedup(spark.createDataFrame([(10, "a"), (11, "c"), (12, "c")], schema), again)
    assert {r.doc_id: (r.keep_id, r.kept) for r in second.collect()} == {10: (2, False), 11: (12, False), 12: (12, True)}
    assert again.read().count() == 3
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {again.table}").collect()}
    assert told["Num Buckets"] == "8" and "digest" in told["Bucket Columns"] and "digest" in told["Sort Columns"]


def test_rebuilt_index_is_compact_and_keeps_its_digests(spark, monkeypatch):
    work = Workspace(spark, "test")
    index = exact.DigestIndex(spark, work.path("index"), 2)
    for start in (0, 40, 80):
        exact.exact_dedup(spark.range(start, start + 50).selectExpr("id AS doc_id", "concat('t', id) AS text"), index)
    monkeypatch.setattr(exact, "LEAST_BUCKETS", 1)
    monkeypatch.setattr(exact, "BUCKET_ROWS", 40)
    new = index.rebuilt(work.path("new"))
    assert new.buckets == 4 and len(new.read().inputFiles()) == 4 < len(index.read().inputFiles())
    assert sorted(map(tuple, new.read().collect())) == sorted(map(tuple, index.read().collect())) and new.read().count() == 130
    again = exact.exact_dedup(spark.createDataFrame([(500, "t7"), (501, "new")], "doc_id long, text string"), new)
    assert {r.doc_id: r.keep_id for r in again.collect()} == {500: 7, 501: 501}


def test_empty(spark):
    assert exact.exact_dedup(odd_docs(spark).limit(0)).count() == 0
