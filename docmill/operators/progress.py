"""Work units, their states and times. Every rule about now takes as_of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def later(ts: Column, seconds: Column | int) -> Column:
    """The time so many seconds later."""
    step = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_micros(F.unix_micros(ts) + step.cast("long") * 1_000_000)


def units(documents: DataFrame, document: str, pages: str, per_unit: int = 10, first_page: int = 3) -> DataFrame:
    """Page ranges of per_unit pages; a document of first_page pages or more starts there, else at page 1."""
    start = F.when(F.col(pages) >= first_page, first_page).otherwise(1)
    marked = documents.where(F.col(pages) >= 1).withColumn("page_from", F.explode(F.sequence(start, F.col(pages), F.lit(per_unit))))
    number = ((F.col("page_from") - start) / per_unit + 1).cast("int")
    return marked.select(document, number.alias("unit_number"), F.col("page_from").cast("int").alias("page_from"), F.least(F.col("page_from") + per_unit - 1, F.col(pages)).cast("int").alias("page_to"))


def span(page_from: Column, page_to: Column) -> Column:
    return F.greatest(F.lit(0), page_to - page_from + 1)


def finalized(units_: DataFrame, session: str, status: Column, pages: Column, records: Column) -> DataFrame:
    """Per session: totals and completed, partial or failed; open while a unit is."""
    done, failed = status == "completed", status == "failed"
    out = units_.groupBy(session).agg(
        F.count("*").alias("units"), F.count_if(done).alias("done"), F.count_if(failed).alias("failed"),
        F.coalesce(F.sum(F.when(done, pages)), F.lit(0)).alias("pages"), F.coalesce(F.sum(F.when(done, records)), F.lit(0)).alias("records"),
    )
    state = F.when(F.col("done") + F.col("failed") < F.col("units"), "open").when(F.col("failed") == 0, "completed").when(F.col("done") > 0, "partial").otherwise("failed")
    return out.withColumn("state", state)


def active_ms(start: Column, end: Column) -> Column:
    """Sum of the spans that aren't negative, in whole milliseconds; null if there is none."""
    us = F.unix_micros(end) - F.unix_micros(start)
    return F.floor(F.sum(F.when(us >= 0, us)) / 1000).cast("long")


def due(status: Column, retry_at: Column, as_of: Column) -> Column:
    return (status == "pending") | ((status == "retry") & (retry_at <= as_of))


def stale(heartbeat: Column, started: Column, as_of: Column, seconds: int, unseen: bool = True) -> Column:
    """Whether the last sign of life is older than ``seconds``; without any, what ``unseen`` says."""
    last = F.coalesce(heartbeat, started)
    return F.coalesce(F.unix_micros(last) < F.unix_micros(as_of) - seconds * 1_000_000, F.lit(unseen))


def live_cards(active_page: Column, page_from: Column, page_to: Column, done: Column, idle_seconds: Column, cards: Column, most_idle: float = 30.0) -> Column:
    """A reader's card counter, if it is running, fresh, and on a page of this unit; else 0."""
    live = ~F.coalesce(done, F.lit(False)) & (idle_seconds <= most_idle) & active_page.between(page_from, page_to)
    return F.when(F.coalesce(live, F.lit(False)), F.coalesce(cards, F.lit(0))).otherwise(0)


def leaves(structure: DataFrame, tree: str, path: list[str]) -> DataFrame:
    """Rows of a nested map of maps (values: map or array of leaves) with a column per level; the last name is the leaf's."""
    out, at = structure, F.col(tree)
    for name in path[:-1]:
        out = out.select(*[c for c in out.columns if c != tree], F.explode(at).alias(name, tree))
        at = F.col(tree)
    return out.select(*[c for c in out.columns if c != tree], F.explode(at).alias(path[-1]))


def chunked(rows: DataFrame, group: list[str], order: list[Column], size: int = 10) -> DataFrame:
    """rows with the number (from 1) of their chunk of ``size`` rows within the group."""
    from .dedup import positions

    return positions(rows, group, order, "__k").withColumn("chunk", (F.floor((F.col("__k") - 1) / size) + 1).cast("int")).drop("__k")


def hourly(events: DataFrame, ts: str, as_of: Column, hours: int = 12, zone: str = "Asia/Kolkata") -> DataFrame:
    """Counts per local hour for the current hour and those before it, 0 where none, and bar heights of 4 to 100."""
    now = F.date_trunc("hour", F.from_utc_timestamp(as_of, zone))
    back = F.sequence(F.lit(0), F.lit(hours - 1))
    grid = events.sparkSession.range(1).select(F.explode(back).alias("__b")).select(later(now, -3600 * F.col("__b")).alias("hour"))
    # The scan needs no older or newer rows, whatever minutes the zone has.
    recent = events.where((F.col(ts) < later(as_of, 7200)) & (F.col(ts) > later(as_of, -3600 * (hours + 1))))
    counted = recent.select(F.date_trunc("hour", F.from_utc_timestamp(F.col(ts), zone)).alias("hour")).groupBy("hour").agg(F.count("*").alias("n"))
    out = F.broadcast(grid).join(counted, "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))
    top = out.agg(F.max("n").alias("top"))
    height = F.when(F.col("top") > 0, F.greatest(F.lit(4), F.bround(F.try_divide(F.col("n") * 100, F.col("top"))).cast("int"))).otherwise(4)
    return out.join(F.broadcast(top), F.lit(True)).select("hour", "n", height.cast("int").alias("height"))


def per_hour(events: DataFrame, ts: str, as_of: Column, most: float = 12.0) -> DataFrame:
    """Events in the last ``most`` hours over the hours observed, a minute at least."""
    recent = events.where((F.col(ts) > later(as_of, -int(most * 3600))) & (F.col(ts) <= as_of))
    hours = F.least(F.lit(most), F.greatest((F.unix_micros(as_of) - F.min(F.unix_micros(F.col(ts)))) / 3_600_000_000, F.lit(1 / 60)))
    return recent.agg(F.count("*").alias("n"), F.coalesce(F.count("*") / hours, F.lit(0.0)).alias("per_hour"))
