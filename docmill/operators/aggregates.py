"""Aggregates with the exact rules that reports rely on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def upper_median(value: str) -> Column:
    """The middle value of a number column, of two middle ones the larger, as a double; not an interpolation.

    A group is held as counts of its distinct values, merged from partial ones.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}` DESC)")


def whole_percent(part: Column, total: Column) -> Column:
    """Rounded half to even; 0 of nothing."""
    return F.coalesce(F.bround(F.try_divide(part * 100, total)), F.lit(0)).cast("long")


def weighted_rate(total: Column, weight: Column) -> Column:
    """Sum over sum, null for a weight of 0; never a mean of ratios."""
    return F.try_divide(F.sum(total), F.nullif(F.sum(weight), F.lit(0)))


def value_counts(rows: DataFrame, array: str, name: str) -> DataFrame:
    """How often each value occurs in an array column; null arrays have none."""
    return rows.select(F.explode(array).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def single_value(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """The group's value where it has exactly one that isn't null, else null."""
    out = rows.groupBy(*group).agg(F.min(value).alias("__a"), F.max(value).alias("__b"))
    return out.select(*group, F.when(F.col("__a") == F.col("__b"), F.col("__a")).alias(value))


def majority(rows: DataFrame, group: list[str], vote: str, least: int = 2) -> DataFrame:
    """The vote with ``least`` votes or more and strictly more than any other, else null."""
    counted = rows.where(F.col(vote).isNotNull()).groupBy(*group, vote).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*group)
    ranked = counted.withColumn("__top", F.max("__n").over(w))
    tops = ranked.groupBy(*group).agg(F.max("__top").alias("votes"), F.count_if(F.col("__n") == F.col("__top")).alias("__ties"), F.max(F.when(F.col("__n") == F.col("__top"), F.col(vote))).alias("__vote"))
    return tops.select(*group, F.when((F.col("votes") >= least) & (F.col("__ties") == 1), F.col("__vote")).alias(vote), "votes")


def consensus(rows: DataFrame, group: list[str], page: str, value: str, least: int) -> DataFrame:
    """A repeated header's value if all pages that have one agree and there are ``least`` such pages; else a reason."""
    out = rows.groupBy(*group).agg(F.min(value).alias("__a"), F.max(value).alias("__b"), F.countDistinct(F.when(F.col(value).isNotNull(), F.col(page))).alias("pages"))
    reason = F.when(F.col("__a").isNull(), "absent").when(F.col("__a") != F.col("__b"), "conflict").when(F.col("pages") < least, "too_few_pages")
    return out.select(*group, F.when(reason.isNull(), F.col("__a")).alias(value), F.coalesce("pages", F.lit(0)).alias("pages"), reason.alias("reason"))


def rolled_up(states: DataFrame, group: list[str], state: str) -> DataFrame:
    """mismatched if any child is, matched if all are, progress if any is in progress or matched, else pending."""
    has = lambda s: F.bool_or(F.col(state) == s)
    rule = F.when(has("mismatched"), "mismatched").when(F.bool_and(F.col(state) == "matched"), "matched").when(has("progress") | has("matched"), "progress").otherwise("pending")
    return states.groupBy(*group).agg(rule.alias("state"))


def confusion(predicted: Column, actual: Column) -> list[Column]:
    return [
        F.count_if(p & a).alias(name)
        for name, p, a in (("tp", predicted, actual), ("fp", predicted, ~actual), ("fn", ~predicted, actual), ("tn", ~predicted, ~actual))
    ]
