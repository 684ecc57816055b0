"""Joins that the relational ones don't cover by themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def without_or_due(rows: DataFrame, done: DataFrame, key: str, due: Column) -> DataFrame:
    """Rows that have no counterpart in done, and those whose counterpart is due again (``due`` over done's columns)."""
    fresh = rows.join(done.select(key), key, "left_anti")
    again = rows.join(done.where(due).select(key).distinct(), key, "left_semi")
    return fresh.unionByName(again)


def unique_lookup(rows: DataFrame, catalogue: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """rows with the catalogue's values where exactly one entry has the key, else null."""
    once = catalogue.groupBy(*key).agg(F.count("*").alias("__n"), *[F.first(v).alias(v) for v in value]).where("__n = 1").drop("__n")
    return rows.join(once, key, "left")


def containing_one(rows: DataFrame, text: str, names: DataFrame, name: str, most: int = 10_000) -> DataFrame:
    """rows with the one name that occurs in the text, null where none or several do.

    names must be a short list (``most`` is checked); it becomes an array of
    constants, so rows are neither shuffled nor joined.
    """
    listed = [r[0] for r in names.select(name).where(F.col(name).isNotNull()).distinct().limit(most + 1).collect()]
    if len(listed) > most:
        raise ValueError(f"over {most} names")
    found = F.filter(F.array(*[F.lit(n) for n in sorted(listed)]).cast("array<string>"), lambda n: F.contains(F.col(text), n))
    return rows.withColumn(name, F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def points_in_spans(points: DataFrame, spans: DataFrame, at: str, start: str, end: str, width: float, on: list[str] | None = None) -> DataFrame:
    """Pairs of a point and a span with start <= at <= end, by an equi join on bins of the axis and of ``on``.

    at, start and end are numbers; width is the bin's. A span takes part once
    per bin that it touches, so width should be about a usual span.
    """
    on = on or []
    binned = points.withColumn("__bin", F.floor(F.col(at) / width))
    touched = spans.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    # The size of spans that are dealt to bins is guessed from that of their file, so they aren't broadcast by it.
    return binned.join(touched.hint("merge"), [*on, "__bin"]).where((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))).drop("__bin")


def difference(old: DataFrame, new: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Per key: side (both, only_old, only_new) and the names of the fields that differ, nulls being equal."""
    a = old.select(*key, F.struct(*fields).alias("__a"))
    b = new.select(*key, F.struct(*fields).alias("__b"))
    off = F.array_compact(F.array(*[F.when(~F.col(f"__a.{f}").eqNullSafe(F.col(f"__b.{f}")), F.lit(f)) for f in fields]))
    side = F.when(F.col("__a").isNull(), "only_new").when(F.col("__b").isNull(), "only_old").otherwise("both")
    return a.join(b, key, "full").select(*key, side.alias("side"), F.when(side == "both", off).otherwise(F.array().cast("array<string>")).alias("changed"))


def aligned(left: DataFrame, right: DataFrame, position: str, value: str, reach: int = 5) -> DataFrame:
    """Per position of left: MATCH, ORDER_SHIFT (the value is within ``reach`` positions), or TRUE_MISMATCH.

    Rows meet in blocks of positions; a row of right is dealt to each block, one
    or two, that has positions within its reach. Spark guesses the size of the
    dealt rows from that of the file, so it is told not to broadcast them.
    """
    width = 4 * reach + 1
    block = lambda c: F.floor(c / width)
    a = left.select(F.col(position).alias("position"), F.col(value).alias("value")).withColumn("__block", block(F.col("position")))
    b = right.select(F.col(position).alias("__at"), F.col(value).alias("__value")).where("__value IS NOT NULL")
    near = b.withColumn("__near", F.explode(F.sequence(block(F.col("__at") - reach), block(F.col("__at") + reach))))
    off = F.abs(F.col("__at") - F.col("position"))
    both = a.join(near.hint("merge"), (F.col("__block") == F.col("__near")) & (F.col("value") == F.col("__value")) & (off <= reach), "left")
    found = both.groupBy("position", "value").agg(F.min(off).alias("off"))
    return found.select("position", "value", F.when(F.col("off") == 0, "MATCH").when(F.col("off") > 0, "ORDER_SHIFT").otherwise("TRUE_MISMATCH").alias("verdict"))
