"""Deterministic invented records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def mock_records(spark: SparkSession, page_from: int, page_to: int, per_page: int = 2) -> DataFrame:
    pages = spark.range(page_from, page_to + 1).withColumnRenamed("id", "page")
    rows = pages.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(per_page).cast("long"))))
    return rows.select("page", "row", F.concat_ws("-", F.lit("row"), "page", "row").alias("name"), F.concat(F.lit("TST"), F.lpad((F.col("page") * 100 + F.col("row")).cast("string"), 7, "0")).alias("epic_number"))
