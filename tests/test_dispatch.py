import datetime as dt
import random

import pytest

from docmill.streaming import dispatch as d

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "unit_id long, kind string, at timestamp, next_retry_at timestamp"


def at(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


def plain(batches, window):
    """(claims per batch, open units) by the rule, one batch after the other."""
    units, out = {}, []
    for events in batches:
        for u, kind, t, again in sorted(events, key=lambda e: (e[2], ["ready", "retry", "finished"].index(e[1]))):
            if u in units and units[u][1] > t:
                continue
            if kind == "finished":
                units[u] = ("finished", t, t, None)
            else:
                units[u] = ("waiting", t, t, again if kind == "retry" else None)
        units = {u: x for u, x in units.items() if x[0] != "finished"}
        now = max(e[2] for e in events)
        room = max(0, window - sum(x[0] == "in_flight" for x in units.values()))
        can = sorted((x[2], u) for u, x in units.items() if x[0] == "waiting" and (x[3] is None or x[3] <= now))
        out.append([u for _, u in can[:room]])
        for u in out[-1]:
            units[u] = ("in_flight", now, units[u][2], None)
    return out, {u: x[0] for u, x in units.items()}


def made(seed, n=6):
    r = random.Random(seed)
    t, batches = 0, []
    for _ in range(n):
        events = []
        for _ in range(25):
            t += r.randrange(1, 4)
            kind = r.choices(["ready", "retry", "finished"], [3, 1, 2])[0]
            events.append((r.randrange(40), kind, t, t + r.randrange(60) if kind == "retry" else None))
        batches.append(events)
    return batches


def write(spark, batch, path):
    spark.createDataFrame([(u, k, at(t), at(x)) for u, k, t, x in batch], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def told(spark, path):
    rows = d.claims(spark, path).collect()
    return {n: sorted(r.unit_id for r in rows if r.batch == n) for n in {r.batch for r in rows}}


@pytest.mark.parametrize("window", [0, 7])
def test_batches_follow_the_rule(spark, tmp_path, window):
    path, batches = str(tmp_path / "ledger"), made(window)
    want, units = plain(batches, window)
    for n, b in enumerate(batches):
        rows = spark.createDataFrame([(u, k, at(t), at(x)) for u, k, t, x in b] + [(None, "ready", at(1), None), (5, "other", at(1), None), (5, "ready", None, None)], SCHEMA)
        d.apply_batch(rows, n, path, window)
        d.apply_batch(rows, n, path, window)  # delivered again
        open_ = d.open_units(spark, path).collect()
        assert sum(r.state == "in_flight" for r in open_) <= window
    assert told(spark, path) == {n: sorted(x) for n, x in enumerate(want) if x}
    assert {r.unit_id: r.state for r in d.open_units(spark, path).collect()} == units


def test_a_stop_between_claim_and_commit(spark, tmp_path):
    batches, window = made(3), 5
    want, units = plain(batches, window)
    source, path, cp = (str(tmp_path / x) for x in ("in", "ledger", "cp"))
    calls = []

    def fall():
        calls.append(1)
        if len(calls) in (2, 4):
            raise RuntimeError("stopped here")

    for b in batches:
        write(spark, b, source)
        for _ in range(3):
            before = told(spark, path)
            q = d.dispatch(stream(spark, source), path, cp, window, fall)
            try:
                q.awaitTermination()
                break
            except Exception as e:
                assert "stopped here" in str(e)
                assert told(spark, path) == before  # what isn't committed isn't told
    assert len(calls) == len(batches) + 2
    assert told(spark, path) == {n: sorted(x) for n, x in enumerate(want) if x}
    assert {r.unit_id: r.state for r in d.open_units(spark, path).collect()} == units


def test_nothing_yet(spark, tmp_path):
    assert d.claims(spark, str(tmp_path)).count() == 0 and d.open_units(spark, str(tmp_path)).count() == 0
    d.apply_batch(spark.createDataFrame([], SCHEMA), 0, str(tmp_path / "x"), 5)
    assert d.claims(spark, str(tmp_path / "x")).count() == 0
