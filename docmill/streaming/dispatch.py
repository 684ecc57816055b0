"""Dispatch of work units from a stream, never more at a time than a window has room for.

Each micro-batch of unit events makes a new version of the table of open units
and, from its waiting ones, claims as many as there is room for. Both are written
under the batch's number, claims first; the version's success file commits both. A
batch that is delivered again finds its version and does nothing, or, if it
was stopped before, makes the same claims again in the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import scratch
from ..operators.progress import due

READY, RETRY, FINISHED = "ready", "retry", "finished"
WAITING, IN_FLIGHT = "waiting", "in_flight"
STATE = "unit_id long, state string, at timestamp, queued_at timestamp, next_retry_at timestamp"
CLAIMS = "unit_id long, claimed_at timestamp"
#: Versions that are kept; the last one is needed, one more helps whoever reads just now.
KEPT = 2


def _committed(spark: SparkSession, path: str) -> list[int]:
    found = [int(n.removeprefix("batch=")) for n in scratch.children(spark, f"{path}/state") if n.startswith("batch=")]
    return sorted(n for n in found if scratch.exists(spark, f"{path}/state/batch={n}/_SUCCESS"))


def next_version(state: DataFrame, events: DataFrame, window: int) -> DataFrame:
    """The open units after a batch of events, with ``claimed``: whether the batch claims them.

    Of a unit's state and events the latest counts; among equal times an end
    comes last. Finished units go. Waiting units that are due at the batch's
    latest time are claimed, oldest first, as far as ``window`` units in flight leave room.
    """
    rank = lambda c, kinds: F.coalesce(*[F.when(F.col(c) == k, i) for i, k in enumerate(kinds)], F.lit(-1))
    told = events.where(F.col("unit_id").isNotNull() & F.col("at").isNotNull() & F.col("kind").isin(READY, RETRY, FINISHED))
    new = told.select("unit_id", F.when(F.col("kind") == FINISHED, FINISHED).otherwise(WAITING).alias("state"), "at", rank("kind", (READY, RETRY, FINISHED)).alias("__rank"),
                      F.col("at").alias("queued_at"), F.when(F.col("kind") == RETRY, F.col("next_retry_at")).alias("next_retry_at"))
    old = state.withColumn("__rank", F.lit(-1)).select(new.columns)
    fields = ["at", "__rank", "state", "queued_at", "next_retry_at"]
    latest = old.unionByName(new).groupBy("unit_id").agg(F.max(F.struct(*fields)).alias("s")).select("unit_id", *[F.col(f"s.{f}") for f in fields]).where(F.col("state") != FINISHED).drop("__rank")
    now = told.agg(F.max("at").alias("__now"))
    open_ = latest.join(F.broadcast(now), F.lit(True), "left")
    status = F.when(F.col("next_retry_at").isNull(), "pending").otherwise("retry")
    can = (F.col("state") == WAITING) & F.coalesce(due(status, F.col("next_retry_at"), F.col("__now")), F.lit(False))
    room = open_.agg(F.greatest(F.lit(window) - F.count_if(F.col("state") == IN_FLIGHT), F.lit(0)).alias("__room"))
    # The window bounds what is taken to one place.
    first = open_.where(can).orderBy("queued_at", "unit_id").limit(window).select("unit_id", "queued_at")
    place = F.size(F.filter("__first", lambda x: F.struct(x["queued_at"], x["unit_id"]) < F.struct(F.col("queued_at"), F.col("unit_id"))))
    every = first.agg(F.collect_list(F.struct("queued_at", "unit_id")).alias("__first")).crossJoin(room)
    got = first.join(F.broadcast(every), F.lit(True)).where(place < F.col("__room")).select("unit_id", F.lit(True).alias("claimed"))
    out = open_.join(F.broadcast(got), "unit_id", "left").withColumn("claimed", F.coalesce("claimed", F.lit(False)))
    return out.select(
        "unit_id", F.when(F.col("claimed"), IN_FLIGHT).otherwise(F.col("state")).alias("state"), F.when(F.col("claimed"), F.col("__now")).otherwise(F.col("at")).alias("at"), "queued_at",
        F.when(~F.col("claimed"), F.col("next_retry_at")).alias("next_retry_at"), "claimed",
    )


def apply_batch(events: DataFrame, number: int, path: str, window: int, between: Callable[[], None] | None = None) -> None:
    """Make version ``number`` of the tables at path from the version before it; ``between`` runs after the claims and before their commit."""
    spark = events.sparkSession
    done = _committed(spark, path)
    if done and done[-1] >= number:
        return
    state = spark.read.schema(STATE).parquet(f"{path}/state/batch={done[-1]}") if done else spark.createDataFrame([], STATE)
    # Written once and read by both tables, so that both say the same.
    made = f"{path}/making/batch={number}"
    next_version(state, events, window).write.mode("overwrite").parquet(made)
    made_rows = spark.read.schema(f"{STATE}, claimed boolean").parquet(made)
    made_rows.where("claimed").select("unit_id", F.col("at").alias("claimed_at")).write.mode("overwrite").parquet(f"{path}/claims/batch={number}")
    if between:
        between()
    made_rows.drop("claimed").write.mode("overwrite").parquet(f"{path}/state/batch={number}")
    scratch.delete(spark, made)
    for n in done[: 1 - KEPT]:
        scratch.delete(spark, f"{path}/state/batch={n}")


def dispatch(events: DataFrame, path: str, checkpoint: str, window: int, between: Callable[[], None] | None = None) -> StreamingQuery:
    """Run a stream of unit events (unit_id, kind: ready, retry or finished, at, next_retry_at) against the tables at path."""
    return events.writeStream.foreachBatch(lambda batch, number: apply_batch(batch, number, path, window, between)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def claims(spark: SparkSession, path: str) -> DataFrame:
    """batch, unit_id and claimed_at of all committed claims."""
    last = max(_committed(spark, path), default=-1)
    if last < 0:
        return spark.createDataFrame([], f"batch long, {CLAIMS}")
    return spark.read.schema(f"{CLAIMS}, batch long").parquet(f"{path}/claims").where(F.col("batch") <= last).select("batch", "unit_id", "claimed_at")


def open_units(spark: SparkSession, path: str) -> DataFrame:
    """The last committed version of the open units."""
    done = _committed(spark, path)
    return spark.read.schema(STATE).parquet(f"{path}/state/batch={done[-1]}") if done else spark.createDataFrame([], STATE)
