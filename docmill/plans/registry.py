"""Named queries over the benchmark tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """tables.orders reads the orders table; times are UTC timestamps."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship(spark)
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.select([F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def query(sql: str | None = None):
    """Register a function of Tables under its name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
