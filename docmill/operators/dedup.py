"""Removing repeated rows by content, natural key or fallback key, and appending what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .attempts import latest_per_key


def keep_first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return latest_per_key(rows, key, order)


def by_natural_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key where no part of the key is null; other rows are exempt and all stay."""
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return latest_per_key(rows.where(whole), key, order).unionByName(rows.where(~whole))


def by_fallback_key(rows: DataFrame, scope: list[str], first: str, second: str, order: list[Column]) -> DataFrame:
    """One row per first key, or per second key where the first is blank; rows with neither stay."""
    one, two = (F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in (first, second))
    rows = rows.withColumn("__key", F.coalesce(F.concat(F.lit("1:"), one), F.concat(F.lit("2:"), two)))
    return by_natural_key(rows, [*scope, "__key"], order).drop("__key")


def cancelled_copies(rows: DataFrame, content: str, identity: str, completed: Column) -> DataFrame:
    """Rows that aren't completed and whose content is completed under another identity."""
    done = rows.where(completed).groupBy(content).agg(F.min(identity).alias("__a"), F.max(identity).alias("__b"))
    open_ = rows.where(~F.coalesce(completed, F.lit(False)))
    return open_.join(done, content).where((F.col("__a") != F.col(identity)) | (F.col("__b") != F.col(identity))).drop("__a", "__b")


def new_rows(candidates: DataFrame, existing: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Candidates whose key isn't there yet, one per key: what an insert that skips conflicts writes."""
    return keep_first(candidates, key, order).join(existing.select(*key), key, "left_anti")


def positions(rows: DataFrame, group: list[str], order: list[Column], name: str = "position") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
