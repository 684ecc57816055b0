"""What is missing, wrong or different in records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import blank_to_null


def missing(fields: list[str]) -> Column:
    """Names of the fields that are null or blank."""
    return F.array_compact(F.array(*[F.when(blank_to_null(F.col(f).cast("string")).isNull(), F.lit(f)) for f in fields]))


def incomplete(rows: DataFrame, place: list[str], fields: list[str], reasons: Column, valid: Column) -> DataFrame:
    """Rows that miss a field, have reasons or aren't valid: their place and why, and no values."""
    marked = rows.select(*place, F.array_join(missing(fields), ",").alias("missing"), F.array_join(F.coalesce(reasons, F.array().cast("array<string>")), ",").alias("reasons"), F.coalesce(valid, F.lit(False)).alias("valid"))
    return marked.where("missing <> '' OR reasons <> '' OR NOT valid")


def missing_counts(rows: DataFrame, fields: list[str]) -> DataFrame:
    return rows.select(F.explode(missing(fields)).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def filled(rows: DataFrame, second: DataFrame, key: list[str], fields: list[str], eligible: Column | None = None) -> DataFrame:
    """rows with blank fields taken from a second source with the same key; what is there stays, and so do rows that aren't eligible."""
    other = second.select(*key, *[F.col(f).alias(f"__{f}") for f in fields])
    allowed = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    both = rows.join(other, key, "left")
    return both.withColumns({f: F.when(allowed & blank_to_null(F.col(f).cast("string")).isNull(), F.col(f"__{f}")).otherwise(F.col(f)) for f in fields}).drop(*[f"__{f}" for f in fields])


def preview(rows: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    """The first rows of each group, with the number that isn't shown."""
    w = Window.partitionBy(*group)
    marked = rows.withColumn("shown", F.row_number().over(w.orderBy(*order))).withColumn("more", F.greatest(F.lit(0).cast("long"), F.count("*").over(w) - most))
    return marked.where(F.col("shown") <= most)


def sweep_flags(read: Column, expected: Column, blank_headers: Column, drift: Column) -> Column:
    """Flags of a document: low yield under .90, very low under .75, a blank header, a drift over .02."""
    share = F.try_divide(read, expected)
    return F.array_compact(F.array(
        F.when(share < 0.75, "yield_very_low").when(share < 0.90, "yield_low"), F.when(blank_headers > 0, "empty_header"), F.when(F.abs(drift) > 0.02, "count_drift"),
    ))


def outcome(deleted: Column, identity: Column) -> Column:
    """Why a row was or wasn't saved."""
    return F.when(F.coalesce(deleted, F.lit(False)), "deleted").when(blank_to_null(identity).isNull(), "no_id").otherwise("extracted")
