"""Leases of work units over an event stream: who holds a unit, and which leases ran out.

A worker claims a unit, and its heartbeats keep the lease for ``seconds`` more.
A lease that gets neither a heartbeat nor an end in time has expired, and its unit can be
dispatched again. ``expired`` finds that in a stream with state and timers per
unit, by event time, so a late or repeated delivery and a restart
change nothing; ``replayed`` says the same of a table, with windows only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from ..shipping import ship

CLAIM, BEAT, DONE = "claim", "heartbeat", "done"
OUT = "worker string, claimed_at timestamp, last_beat timestamp, expired_at timestamp"
#: Of events at one time, a claim comes first and an end last.
_RANK = {CLAIM: 0, BEAT: 1, DONE: 2}
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Timers need the state store that keeps state on disk; set it before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)


class _Leases(StatefulProcessor):
    """State of a unit: its lease, and events that wait until the watermark says that none before them can come.

    Each call reads the state once and writes it once, and sets one timer at
    most, for the first event or end of a lease that waits: what a unit costs is in its batches, not in its events.
    """

    def __init__(self, key: str, seconds: float):
        self.key, self.length = key, int(seconds * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # ``until``: what is behind was told; ``timer``: the earliest one that is set; no ``worker``: no lease.
        self.unit = handle.getValueState("unit", "until long, timer long, worker string, claimed long, beat long, waiting binary")

    def _read(self) -> tuple[int, int | None, tuple | None, list[tuple]]:
        found = self.unit.get() if self.unit.exists() else None
        if found is None:
            return -(1 << 62), None, None, []
        until, timer, worker, claimed, beat, waiting = found
        return until, timer, None if worker is None else (worker, claimed, beat), [tuple(e) for e in json.loads(bytes(waiting))]

    def _write(self, until: int, timer: int | None, lease: tuple | None, waiting: list[tuple]) -> None:
        """Keep the state; ``timer`` is the one that is set already."""
        ends = [e[0] for e in waiting] + ([lease[2] + self.length + 1] if lease else [])
        due = _up(min(ends)) if ends else None
        if due is not None and (timer is None or due < timer):
            self.handle.registerTimer(due)
            timer = due
        self.unit.update((until, timer, *(lease or (None, None, None)), json.dumps(waiting).encode()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        until, timer, lease, waiting = self._read()
        for batch in rows:
            if batch.empty:  # it may have no columns then
                continue
            waiting += [(int(a), int(r), w) for a, r, w in zip(batch["lease_at"], batch["lease_rank"], batch["lease_worker"]) if a > until]
        self._write(until, timer, lease, sorted(set(waiting)))  # a repeated delivery counts once
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # All that the watermark has passed, as a timer that is set here for before it would wait for another batch.
        fired = expiredTimerInfo.getExpiryTimeInMs()
        until = max(fired, timerValues.getCurrentWatermarkInMs()) * 1000
        before, timer, lease, waiting = self._read()
        until = max(until, before)
        out: list[tuple] = []
        now, later = [e for e in waiting if e[0] <= until], [e for e in waiting if e[0] > until]
        for at, rank, worker in now:
            if lease and at > lease[2] + self.length:
                out.append(lease)
                lease = None
            if rank == _RANK[CLAIM]:
                lease = (worker, at, at)
            elif lease and lease[0] == worker:
                lease = (worker, lease[1], at) if rank == _RANK[BEAT] else None
        if lease and until >= lease[2] + self.length + 1:
            out.append(lease)
            lease = None
        self._write(until, None if timer is None or timer <= until // 1000 else timer, lease, later)
        if out:
            when = lambda k: pd.to_datetime([k(x) for x in out], unit="us")
            yield pd.DataFrame({self.key: [key[0]] * len(out), "worker": [x[0] for x in out], "claimed_at": when(lambda x: x[1]), "last_beat": when(lambda x: x[2]), "expired_at": when(lambda x: x[2] + self.length)})

    def close(self) -> None:
        pass


def _up(us: int) -> int:
    """The first millisecond that isn't before a time in microseconds."""
    return -(-us // 1000)


def _events(events: DataFrame, key: str, worker: str, kind: str, ts: str) -> DataFrame:
    rank = F.coalesce(*[F.when(F.col(kind) == k, r) for k, r in _RANK.items()])
    rows = events.where(rank.isNotNull() & F.col(key).isNotNull() & F.col(worker).isNotNull() & F.col(ts).isNotNull())
    return rows.select(key, F.col(ts).alias("__ts"), F.unix_micros(ts).alias("__at"), rank.alias("__rank"), F.col(worker).cast("string").alias("__worker"))


def expired(events: DataFrame, seconds: float, late: str = "1 minute", key: str = "unit_id", worker: str = "worker", kind: str = "kind", ts: str = "ts") -> DataFrame:
    """Each lease of a stream that expired: key, worker, claimed_at, last_beat and expired_at (last_beat and ``seconds``).

    Events (kind claim, heartbeat or done; others and those with nulls are left
    out) are taken in the order of their times, however they arrive within
    ``late``; claims first and ends last among equal times. A lease lives through a
    sign at its very last microsecond. A claim takes a unit over without an expiry. Heartbeats and ends of a
    worker that doesn't hold the unit are ignored. A lease is told when the
    watermark has passed its end, once, also after a restart from the checkpoint.
    """
    ship(events.sparkSession)
    kind_of_key = events.schema[key].dataType.simpleString()
    rows = _events(events, key, worker, kind, ts).withWatermark("__ts", late)
    # The state operator renames columns that begin with a line.
    rows = rows.withColumnsRenamed({"__ts": "lease_ts", "__at": "lease_at", "__rank": "lease_rank", "__worker": "lease_worker"})
    return rows.groupBy(key).transformWithStateInPandas(_Leases(key, seconds), outputStructType=f"`{key}` {kind_of_key}, {OUT}", outputMode="Append", timeMode="EventTime")


def replayed(events: DataFrame, seconds: float, key: str = "unit_id", worker: str = "worker", kind: str = "kind", ts: str = "ts") -> DataFrame:
    """What ``expired`` tells of a table of events, with all of time behind its watermark; repeated events count once.

    A lease begins at its claim and has the signs of its worker up to the next
    claim of the unit. The first gap of more than ``seconds`` after any of them, or
    the first end, ends it.
    """
    length = int(seconds * 1_000_000)
    rows = _events(events, key, worker, kind, ts).drop("__ts").distinct()
    by_unit = Window.partitionBy(key).orderBy("__at", "__rank", "__worker")
    claim = F.col("__rank") == 0
    # Claims of one unit at one time are one after the other by worker; the last holds it.
    marked = rows.withColumns({"__n": F.sum(claim.cast("long")).over(by_unit.rowsBetween(Window.unboundedPreceding, 0)), "__holder": F.last(F.when(claim, F.col("__worker")), ignorenulls=True).over(by_unit.rowsBetween(Window.unboundedPreceding, 0))})
    own = marked.where((F.col("__n") > 0) & (F.col("__holder") == F.col("__worker")))
    in_lease = Window.partitionBy(key, "__n").orderBy("__at", "__rank")
    broken = (F.col("__at") > F.lag("__at").over(in_lease) + length) | (F.lag("__rank").over(in_lease) == _RANK[DONE])
    own = own.withColumn("__broken", F.coalesce(broken, F.lit(False)))
    own = own.withColumn("__gone", F.sum(F.col("__broken").cast("int")).over(in_lease.rowsBetween(Window.unboundedPreceding, 0)))
    leases = own.where("__gone = 0").groupBy(key, "__n").agg(F.min("__at").alias("__claimed"), F.max("__at").alias("__beat"), F.max("__worker").alias("worker"), F.bool_or(F.col("__rank") == _RANK[DONE]).alias("__done"))
    ends = F.col("__beat") + length
    following = F.lead("__claimed").over(Window.partitionBy(key).orderBy("__n"))
    left = leases.withColumn("__next", following).where(~F.col("__done") & (F.col("__next").isNull() | (F.col("__next") > ends)))
    when = F.timestamp_micros
    return left.select(key, "worker", when("__claimed").alias("claimed_at"), when("__beat").alias("last_beat"), when(ends).alias("expired_at"))
