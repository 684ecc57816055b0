"""Inserts, updates and deletes as new versions of tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import scratch
from ..functions.text import blank_to_null, has_devanagari
from .dedup import new_rows


def insert_counts(candidates: DataFrame, existing: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row: how many candidates were expected, how many an insert that skips conflicts writes, and how many it skips."""
    expected = candidates.agg(F.count("*").alias("expected"))
    written = new_rows(candidates, existing, key, order).agg(F.count("*").alias("written"))
    # Both sides are single rows of totals.
    return expected.crossJoin(written).withColumn("skipped", F.col("expected") - F.col("written"))


def updated(rows: DataFrame, changes: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """rows with the fields of the change that has their key, null values included; changes has each key once."""
    new = changes.select(*key, F.struct(*fields).alias("__new"))
    both = rows.join(new, key, "left")
    return both.withColumns({f: F.when(F.col("__new").isNotNull(), F.col(f"__new.{f}")).otherwise(F.col(f)) for f in fields}).select(rows.columns)


def deletable(parents: DataFrame, children: DataFrame, parent: str, child: str, active: Column) -> DataFrame:
    """parents with refused: whether a child is active, so that the parent must stay."""
    busy = children.where(active).select(F.col(child).alias(parent)).distinct().withColumn("refused", F.lit(True))
    return parents.join(busy, parent, "left").withColumn("refused", F.coalesce("refused", F.lit(False)))


def without(children: DataFrame, parents: DataFrame, parent: str, child: str) -> DataFrame:
    """Children whose parent isn't deleted; children go before their parents, table by table."""
    return children.join(parents.select(F.col(parent).alias(child)).distinct(), child, "left_anti")


def rewrite_changed(spark: SparkSession, path: str, changes: DataFrame, key: list[str], fields: list[str], partition: str) -> int:
    """Set ``fields`` of the rows of a Parquet table that have a key of changes to its values, nulls included, and return how many rows that changes.

    Only partitions (of the column ``partition``) in which a value differs, null
    being like null, are written again; others keep their files, and where nothing differs
    nothing is written, so a second run does nothing. changes has each key
    once; a null key matches nothing. The new partitions are whole in the
    shared folder before they take the places of the old ones; after a failure, the
    same call can be made again.
    """
    table = spark.read.parquet(path)
    differs = lambda f: ~F.col(f"__new.{f}").eqNullSafe(F.col(f))
    new = changes.select(*key, F.struct(*[F.col(f).cast(table.schema[f].dataType).alias(f) for f in fields]).alias("__new"))
    touched = table.join(new, key).where(F.expr("false") if not fields else functools.reduce(Column.__or__, [differs(f) for f in fields]))
    counts = touched.groupBy(partition).agg(F.count("*").alias("n")).collect()  # one row per partition
    if not counts:
        return 0
    hit = functools.reduce(Column.__or__, [F.col(partition).eqNullSafe(F.lit(r[partition])) for r in counts])
    made = scratch.new_path(spark, "rewritten")
    updated(table.where(hit), changes.select(*key, *[F.col(f).cast(table.schema[f].dataType).alias(f) for f in fields]), key, fields).write.partitionBy(partition).parquet(made)
    # Read with the table's own types, which values of a partition's name alone may not give.
    spark.read.schema(table.schema).parquet(made).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    scratch.delete(spark, made)
    return sum(r.n for r in counts)


def backfilled(rows: DataFrame, pairs: dict[str, str], english: Callable[[Column], Column]) -> DataFrame:
    """The rows whose English columns lack what their Devanagari ones say, with those columns filled; ``pairs`` is of Devanagari columns to English ones.

    An English cell is filled where it is blank or still in Devanagari and its
    Devanagari cell isn't blank.
    """
    needs = {en: blank_to_null(F.col(hi)).isNotNull() & (blank_to_null(F.col(en)).isNull() | has_devanagari(F.col(en))) for hi, en in pairs.items()}
    some = rows.where(functools.reduce(Column.__or__, [F.coalesce(n, F.lit(False)) for n in needs.values()]))
    return some.withColumns({en: F.when(needs[en], english(F.col(hi))).otherwise(F.col(en)) for hi, en in pairs.items()})
