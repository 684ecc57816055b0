"""Connected components of a link table, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, hot_join


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node hands the smallest of itself and its neighbours to its larger neighbours."""
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"), F.count("*").alias("degree"))
    return hot_join(both.where("b > a"), least, ["a"], "degree", 2 * total).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
    return (
        hot_join(down, least, ["a"], "degree", total)
        .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        .select("e.*")
        .where("a > b")
    )


def _settled(edges: DataFrame) -> tuple[int, bool]:
    """How many links there are, and whether all are stars: every node that has a smaller neighbour has just one, and that one has none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"), (F.col("a") < F.col("b")).alias("odd"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"), F.lit(False).alias("odd")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"), F.max("odd").alias("odd"))
    seen = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)).alias("links"), F.coalesce(F.max((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0) | F.col("odd")), F.lit(False)).alias("open")).first()
    return seen["links"], not seen["open"]


def connected_components(edges: DataFrame, work: Workspace, name: str = "cc", rounds: int = 60) -> DataFrame:
    """Rows (node, component) for every node of a link; component is its smallest node.

    edges has columns a and b of one orderable type. Large-star and small-star
    steps alternate (Kiveris et al., 2014) until all links are stars around
    their smallest node. Each step is written to the
    shared folder. Per step a node's rows are pre-aggregated to one minimum,
    which is handed out to hubs' rows without shuffling them (see hot_join).
    Links of a node to itself and links with a null count for nothing.
    """
    now = work.save(edges.select("a", "b").where("a <> b").distinct(), f"{name}-0")
    for i in range(rounds + 1):
        total, settled = _settled(now)
        if settled:
            break
        # Large stars are written for themselves: both steps read their input several times.
        large = work.save(_large_star(now, total).distinct(), f"{name}-large")
        now = work.save(_small_star(large, total).distinct(), f"{name}-{i + 1}")
        work.drop(f"{name}-{i}")
    else:
        raise RuntimeError(f"links did not settle within {rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
