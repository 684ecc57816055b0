"""The event log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, per_trigger: int = 1) -> DataFrame:
    """Event files in a folder, as they appear."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(path)


def hourly_counts(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Counts and sums per hour and type; events more than ``late`` behind are dropped."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("hour"), "event_type", "n", "total")


def rolling_counts(events: DataFrame, span: str = "1 hour", step: str = "10 minutes", late: str = "2 hours") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", span, step)).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Spells of a user's activity without a longer gap."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def once_each(events: DataFrame, key: str = "event_id", late: str = "2 hours") -> DataFrame:
    """Each key once within the watermark, for sources that may repeat."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def fresh(events: DataFrame, as_of, seconds: int = 30) -> DataFrame:
    from ..operators.progress import stale

    return events.where(~stale(F.col("ts"), F.col("ts"), as_of, seconds))


def append_once(events: DataFrame, path: str, checkpoint: str, key: list[str], at: str = "ts") -> StreamingQuery:
    """Append each key once to a Parquet table partitioned by the day of ``at``, whatever is delivered again.

    Every batch is anti-joined with what the table has between the batch's first
    and last day, so that a batch that is replayed after a failure writes
    nothing twice, and old days aren't read. A key always has one day; rows
    without a time form a part of their own.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates(key).withColumn("day", F.to_date(at))
        first, last = new.agg(F.min("day"), F.max("day")).first()
        try:
            there = spark.read.schema(new.schema).parquet(path)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
        else:
            there = there.where(F.col("day").isNull() | F.col("day").between(F.lit(first), F.lit(last)))
            new = new.join(there.select(*key), key, "left_anti").select(new.columns)
        new.write.mode("append").partitionBy("day").parquet(path)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dispatched(units: DataFrame, room: int, as_of) -> DataFrame:
    """The units that a dispatcher may claim now, oldest first; for use in foreachBatch or as a batch."""
    from ..operators.progress import due

    return units.where(due(F.col("status"), F.col("next_retry_at"), as_of)).orderBy("queued_at", "unit_id").limit(max(0, room))


def retried(units: DataFrame, as_of, base: float = 30.0, most: int = 5) -> DataFrame:
    """Failed units with their next state: retry at an exponentially later time, or failed after ``most`` attempts."""
    from ..functions.display import backoff
    from ..operators.progress import later

    again = F.col("attempt_count") < most
    wait = backoff(F.col("attempt_count"), base).cast("long")
    return units.withColumns({"status": F.when(again, "retry").otherwise("failed"), "next_retry_at": F.when(again, later(as_of, wait))})
