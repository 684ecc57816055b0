"""Declared totals against what was extracted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def living_counts(records: DataFrame, group: list[str], deleted: Column, buckets: dict[str, Column]) -> DataFrame:
    """Per group: extracted, deleted, living, and living in each bucket."""
    alive = ~F.coalesce(deleted, F.lit(False))
    return records.groupBy(*group).agg(
        F.count("*").alias("extracted"), F.count_if(~alive).alias("deleted"), F.count_if(alive).alias("living"),
        *[F.count_if(alive & F.coalesce(c, F.lit(False))).alias(name) for name, c in buckets.items()],
    )


def reconcile(documents: DataFrame, declared: DataFrame, counts: DataFrame, key: str, fields: list[str], open_: Column) -> DataFrame:
    """Per document: the names of fields whose declared total isn't the extracted one, and its state.

    declared has a column declared_<field> per field; a null one isn't
    compared. An open document is in progress, one without counts pending.
    """
    both = documents.join(declared, key, "left").join(counts, key, "left")
    off = F.array_compact(F.array(*[F.when(F.col(f"declared_{f}") != F.coalesce(F.col(f), F.lit(0)), F.lit(f)) for f in fields]))
    state = F.when(open_, "progress").when(F.col(fields[0]).isNull(), "pending").when(F.size(off) > 0, "mismatched").otherwise("matched")
    return both.select(key, *[F.coalesce(F.col(f), F.lit(0)).alias(f) for f in fields], off.alias("mismatches"), state.alias("state"))


def consistent(parts: list[Column], total: Column) -> Column:
    """Whether parts add up to the total; unknown with a null among them."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole + p
    return whole == total
