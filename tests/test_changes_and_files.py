import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docmill.operators import changes
from docmill.sources import derived


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in sorted(Path(path).rglob("*.parquet"))}


def test_only_partitions_that_change_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"p{i % 4}" if i % 4 else None, i * 1.0 if i % 5 else None, "x") for i in range(40)]
    table = spark.createDataFrame(rows, "k long, part string, v double, w string")
    table.repartition(2).write.partitionBy("part").parquet(path)
    before = files_of(path)
    news = spark.createDataFrame([(1, 5.5, "x"), (5, None, "y"), (9, 9.0, "x"), (2, 2.0, "x"), (99, 1.0, "z"), (None, 1.0, "z"), (8, 8.0, "q")], "k long, v double, w string")
    assert changes.rewrite_changed(spark, path, news, ["k"], ["v", "w"], "part") == 3  # 9 and 2 have these values already
    after = files_of(path)
    kept = [f for f in before if "part=p2" in str(f) or "part=p3" in str(f)]
    assert kept and all(after[f] == before[f] for f in kept) and not [f for f in before if "part=p1" in str(f) and f in after]
    told = {r[0]: r for r in news.collect()}
    want = {k: (k, p, *(told[k][1:] if k in told else (v, w))) for k, p, v, w in rows}
    got = {r.k: (r.k, r.part, r.v, r.w) for r in spark.read.parquet(path).collect()}
    assert got == want and got[5][2] is None
    assert changes.rewrite_changed(spark, path, news, ["k"], ["v", "w"], "part") == 0
    assert files_of(path) == after  # a second run writes nothing
    assert changes.rewrite_changed(spark, path, news.limit(0), ["k"], ["v"], "part") == 0 and changes.rewrite_changed(spark, path, news, ["k"], [], "part") == 0


def test_backfill_and_durations(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = [(1, "राम", None, 1), (2, "राम", "Ram", 1), (3, "राम", "राम", 2), (4, None, None, 2), (5, "  ", "", 3), (6, "सीता", " ", 3)]
    spark.createDataFrame(rows, "id int, name_hi string, name_en string, day int").write.partitionBy("day").parquet(path)
    english = lambda c: F.when(c == "राम", "Raam").otherwise("Siita")

    def run():
        found = changes.backfilled(spark.read.parquet(path), {"name_hi": "name_en"}, english)
        return changes.rewrite_changed(spark, path, found.select("id", "name_en"), ["id"], ["name_en"], "day")

    assert run() == 3 and run() == 0
    assert {r.id: r.name_en for r in spark.read.parquet(path).collect()} == {1: "Raam", 2: "Ram", 3: "Raam", 4: None, 5: "", 6: "Siita"}


def frame(spark, rows):
    return spark.createDataFrame(rows, "source_hash string, page int, name string, content binary")


def test_derived_files(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    rows = [("a1", 3, "p-1.png", b"one"), ("a1", 3, "p-2.png", b""), ("b2", 12, "p-1.png", b"three"), ("b2", 1000, "x", None)]
    derived.write_derived(frame(spark, rows).repartition(3), path)
    got = {r.key: r for r in derived.derived_files(spark, path, content=True).collect()}
    assert set(got) == {"derived/a1/page-003/p-1.png", "derived/a1/page-003/p-2.png", "derived/b2/page-012/p-1.png", "derived/b2/page-1000/x"}
    one = got["derived/a1/page-003/p-1.png"]
    assert bytes(one.content) == b"one" and (one.length, one.sha256) == (3, hashlib.sha256(b"one").hexdigest())
    assert (tmp_path / "store/derived/a1/page-003/p-1.png").read_bytes() == b"one"
    # The same again changes nothing that is told; new content takes the old one's place.
    derived.write_derived(frame(spark, rows), path)
    assert derived.derived_files(spark, path).count() == 4
    derived.write_derived(frame(spark, [("a1", 3, "p-1.png", b"newer")]), path)
    new = derived.derived_files(spark, path, content=True).where("source_hash = 'a1' AND name IN ('p-1.png', 'q')").collect()
    assert [(bytes(r.content), r.length) for r in new] == [(b"newer", 5)]
    few = derived.derived_files(spark, path).where("page = 12")
    assert few.count() == 1 and "= 12" not in few._jdf.queryExecution().executedPlan().toString()  # the reader tests it
    assert not [f for f in (tmp_path / "store").rglob("_*") if f.is_file()]  # nothing half written is left


def test_what_a_failed_write_leaves_is_not_told(spark, tmp_path):
    path = str(tmp_path / "store")
    for bad in ("../x", "", "_x", "a/b"):
        with pytest.raises(Exception, match="can't be"):
            derived.write_derived(frame(spark, [("a1", 1, "good", b"1"), ("a1", 1, bad, b"2")]).coalesce(1), path)
    assert (tmp_path / "store/derived/a1/page-001/good").exists() and derived.derived_files(spark, path).count() == 0
    derived.write_derived(frame(spark, [("a1", 1, "good", b"1")]), path)
    assert [r.name for r in derived.derived_files(spark, path).collect()] == ["good"]
    derived.write_derived(frame(spark, []), path)
    assert derived.derived_files(spark, path).count() == 1 and derived.derived_files(spark, str(tmp_path / "none")).count() == 0
