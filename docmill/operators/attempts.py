"""Which attempt at a document counts, and the records of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; end the order with a unique column."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def authoritative_attempt(attempts: DataFrame, records: DataFrame, document: str, attempt: str, record_attempt: str, finished: Column, newest: list[Column]) -> DataFrame:
    """Of each document's attempts that have records, a finished one before others, then the newest."""
    with_records = attempts.join(records.select(F.col(record_attempt).alias(attempt)), attempt, "left_semi")
    return latest_per_key(with_records, [document], [finished.cast("int").desc(), *newest])


def scoped_records(records: DataFrame, chosen: DataFrame, attempt: str, record_attempt: str, columns: list[str]) -> DataFrame:
    """The records of the chosen attempts, with columns of the attempt."""
    picked = chosen.select(F.col(attempt).alias("__attempt"), *columns)
    return records.join(picked, records[record_attempt] == picked["__attempt"]).drop("__attempt")
