import datetime as dt
import random

import pytest

from docmill.streaming import leases

SECONDS, LATE = 30, 60
T0 = dt.datetime(2024, 1, 1)


def plain(events):
    """The rule, event by event."""
    out, held = [], {}
    for unit, at, kind, worker in sorted(set(events), key=lambda e: (e[0], e[1], ["claim", "heartbeat", "done"].index(e[2]), e[3])):
        lease = held.get(unit)
        if lease and at > lease[2] + SECONDS:
            out.append((unit, *lease))
            held.pop(unit)
            lease = None
        if kind == "claim":
            held[unit] = (worker, at, at)
        elif lease and lease[0] == worker:
            if kind == "done":
                held.pop(unit)
            else:
                held[unit] = (worker, lease[1], at)
    return sorted(out + [(u, *x) for u, x in held.items()])


def made(seed, n=400, units=12, span=3000):
    r = random.Random(seed)
    rows = [(r.randrange(units), r.randrange(span * 4) / 4, r.choices(["claim", "heartbeat", "done"], [2, 6, 1])[0], r.choice("ab")) for _ in range(n)]
    return rows + r.sample(rows, n // 10)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(u, at(t), k, w, 1) for u, t, k, w in rows], "unit_id long, ts timestamp, kind string, worker string, expired_at int")


def told(rows):
    secs = lambda t: (t - T0).total_seconds()
    for r in rows:
        assert secs(r.expired_at) == secs(r.last_beat) + SECONDS
    return sorted((r.unit_id, r.worker, secs(r.claimed_at), secs(r.last_beat)) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_of_a_table(spark, seed):
    rows = made(seed)
    assert told(leases.replayed(frame(spark, rows), SECONDS).collect()) == plain(rows)


def test_replay_edges(spark):
    rows = [(1, 0, "claim", "a"), (1, 30, "heartbeat", "a"), (1, 60.25, "heartbeat", "a"), (2, 0, "claim", "a"), (2, 10, "heartbeat", "b"), (2, 20, "done", "b"), (3, 5, "heartbeat", "a"), (4, 0, "claim", "a"), (4, 9, "claim", "b"), (4, 12, "done", "a"), (4, 15, "done", "b"),
            (5, 0, "claim", "b"), (5, 0, "done", "b"), (6, 0, "claim", "a"), (6, 0, "claim", "b"), (6, 31, "claim", "a"), (6, 40, "done", "a"), (6, 41, "heartbeat", "a")]
    got = told(leases.replayed(frame(spark, rows), SECONDS).collect())
    assert got == plain(rows) == [(1, "a", 0, 30), (2, "a", 0, 0), (6, "b", 0, 0)]
    odd = spark.createDataFrame([(None, T0, "claim", "a"), (1, None, "claim", "a"), (1, T0, None, "a"), (1, T0, "claim", None), (1, T0, "other", "a")], "unit_id long, ts timestamp, kind string, worker string")
    assert leases.replayed(odd, SECONDS).count() == 0 and leases.replayed(odd.limit(0), SECONDS).count() == 0


def test_stream_equals_replay_and_restarts_tell_nothing_twice(spark, tmp_path):
    leases.use_state_store(spark)
    rows = sorted(made(3), key=lambda e: e[1])
    r = random.Random(7)
    # Delivered out of order, but never more than LATE behind what was delivered.
    rows.sort(key=lambda e: e[1] + r.uniform(0, LATE - 1))
    path, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = spark.readStream.schema(frame(spark, []).schema).option("maxFilesPerTrigger", 2).parquet(path)
        q = leases.expired(stream, SECONDS, f"{LATE} seconds").writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start()
        q.awaitTermination()
        return told(spark.read.parquet(out).collect())

    parts = [rows[i : i + 110] for i in range(0, len(rows), 110)]
    for k, part in enumerate(parts):
        frame(spark, part).coalesce(1).write.mode("append").parquet(path)
        if k == 1:  # stop half way, and start again without and with new files
            first = run()
            assert first and run() == first
    end = max(e[1] for e in rows)
    got = run()
    assert len(got) == len(set(got)) and set(first) <= set(got)
    # What the watermark has passed by the end was told, and nothing else.
    assert got == [x for x in plain(rows) if x[3] + SECONDS < end - LATE]
    late = [(99, 1.0, "claim", "a")]
    frame(spark, late).coalesce(1).write.mode("append").parquet(path)
    assert run() == got
