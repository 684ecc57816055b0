"""Steps whose cost must follow the input: what they deal out, recompute, and call once per row."""

import numpy as np
from pyspark.sql import functions as F

from docmill.operators import cards, georeference, joins, placed, windows
from docmill.streaming import leases


def plan(df, stage="executedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


def test_dealt_rows_are_not_broadcast(spark, tmp_path):
    spark.range(1, 500).select("id", F.concat(F.lit("v"), F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p"))
    out = joins.aligned(rows, rows.withColumn("id", F.col("id") + 3), "id", "v")
    assert "Broadcast" not in plan(out)
    # The value is v of the position; three places on, within reach of 5, it is 4 places behind.
    assert {r.verdict: r["count"] for r in out.groupBy("verdict").count().collect()} == {"ORDER_SHIFT": 499}
    spans = rows.select(F.col("id").alias("a"), (F.col("id") + 900).alias("b"))
    assert "Broadcast" not in plan(joins.points_in_spans(rows, spans, "id", "a", "b", 1.0))


def test_aligned_against_plain_python(spark):
    r = np.random.default_rng(5)
    left = [(int(p), f"v{v}") for p, v in enumerate(r.integers(0, 9, 200), -60)] + [(300, None)]
    right = [(int(p), f"v{v}") for p, v in enumerate(r.integers(0, 40, 200), -60)] + [(300, None)]
    for reach in (0, 1, 5):
        frames = [spark.createDataFrame(x, "p long, v string") for x in (left, right)]
        got = {x.position: x.verdict for x in joins.aligned(*frames, "p", "v", reach).collect()}
        offs = {p: [abs(p - q) for q, w in right if w == v and v is not None and abs(p - q) <= reach] for p, v in left}
        assert got == {p: "TRUE_MISMATCH" if not o else "ORDER_SHIFT" if min(o) else "MATCH" for p, o in offs.items()}


def test_cluster_starts_against_plain_python():
    r = np.random.default_rng(2)
    for k in range(200):
        values = np.sort(r.uniform(0, 50, 60)) if k % 2 else np.sort(r.integers(0, 400, 60) / 10)
        new = r.random(60) < 0.1
        want, first = [], None
        for i, v in enumerate(values):
            if first is None or new[i] or v - first > 3.3:
                want.append(i)
                first = v
        assert windows.cluster_starts(values, values, new, 3.3).tolist() == want


def test_triples_are_drawn_once_and_fit_as_by_solving():
    assert georeference._triples(40) is georeference._triples(40)
    r = np.random.default_rng(3)
    for n in (4, 9, 25):
        pixels = r.uniform(0, 1000, (n, 2))
        metres = pixels @ r.normal(size=(2, 2)) + r.normal(size=2) * 1000
        metres[: n // 4] += 5000
        good = georeference.agreeing(pixels, metres)
        assert good.tolist() == [i >= n // 4 for i in range(n)] or n == 4


def test_boxes_and_lines_read_their_words_few_times(spark):
    words = spark.createDataFrame([(1, 10.0 + 200 * k, 10.0, 80.0 + 200 * k, 20.0, f"ABC000000{k}") for k in range(3)], "page long, x0 double, y0 double, x1 double, y1 double, word string")
    sizes = spark.createDataFrame([(1, 600.0, 800.0)], "page long, page_width double, page_height double")
    assert plan(placed.card_boxes(words, ["page"], sizes)).count("Scan ExistingRDD") <= 3
    boxes = spark.createDataFrame([(1, "i", 0.0, 0.0, 500.0, 500.0)], "page long, id string, left double, top double, width double, height double")
    lines = placed.card_lines(words, boxes, ["page"])
    assert plan(lines).count("Scan ExistingRDD") == 2 and "MapIn" not in plan(lines)


def test_labels_are_found_once(spark):
    out = spark.createDataFrame([("x",)], "t string").select(cards.cover_facts(F.col("t")).alias("c")).select("c.district", "c.pin_code", "c.qualifying_date", "c.village")
    assert plan(out, "optimizedPlan").count(cards.COVER_LABELS["panchayat"]) == 1


class Handle:
    """A state store of one unit that counts calls."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, name, schema):
        return self

    getListState = getValueState

    def exists(self):
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def appendValue(self, value):
        self.calls += 1

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


def test_a_unit_costs_few_calls_however_many_events():
    import pandas as pd

    handle, unit = Handle(), leases._Leases("u", 30)
    unit.init(handle)
    rows = pd.DataFrame({"lease_at": [k * 1_000_000 for k in range(1, 500)], "lease_rank": 0, "lease_worker": "a"})
    assert list(unit.handleInputRows((1,), iter([rows]), None)) == []
    assert handle.timers == [1000] and handle.calls <= 3
