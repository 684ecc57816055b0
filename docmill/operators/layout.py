"""Page layouts from the places of ID words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import upper_median
from .windows import clustered

#: Words closer than these stand in one column or row; a grid needs so many hits in at least two columns.
COLUMN_GAP, ROW_GAP, GRID_HITS, GRID_RATIO = 60.0, 18.0, 6, 0.6
#: Card size as a share of the distance between IDs.
CARD_WIDTH, CARD_HEIGHT = 0.92, 0.90


def accepted_pages(hits: DataFrame, page: list[str], leading: Column, least: int = 4) -> DataFrame:
    """Pages with ``least`` hits, or with a hit in a leading place."""
    return hits.groupBy(*page).agg(F.count("*").alias("hits"), (F.bool_or(leading) | (F.count("*") >= least)).alias("accepted"))


def layouts(words: DataFrame, page: list[str]) -> DataFrame:
    """Per page with ID words: hits, columns, rows and kind (single, column, sparse, grid) of their places at x and y; ``placed.layout_kinds`` knows pages without any."""
    columns = clustered(words, page, "x", COLUMN_GAP).groupBy(*page).agg(F.count("*").alias("columns"))
    rows = clustered(words, page, "y", ROW_GAP).groupBy(*page).agg(F.count("*").alias("rows"))
    out = words.groupBy(*page).agg(F.count("*").alias("hits")).join(columns, page, "left").join(rows, page, "left")
    full = F.col("hits") / (F.col("columns") * F.col("rows"))
    kind = F.when(F.col("hits") == 1, "single").when(F.col("columns") == 1, "column").when((F.col("hits") >= GRID_HITS) & (full >= GRID_RATIO), "grid").otherwise("sparse")
    return out.select(*page, "hits", "columns", "rows", kind.alias("kind"))


def card_sizes(words: DataFrame, page: list[str]) -> DataFrame:
    """Card width and height from the upper medians of the distances between neighbouring columns and rows."""
    from pyspark.sql.window import Window

    def pitch(axis: str, gap: float, share: float, name: str) -> DataFrame:
        found = clustered(words, page, axis, gap)
        step = F.col("first") - F.lag("first").over(Window.partitionBy(*page).orderBy("cluster"))
        return found.withColumn("step", step).where("step IS NOT NULL").groupBy(*page).agg((upper_median("step") * share).alias(name))

    return pitch("x", COLUMN_GAP, CARD_WIDTH, "width").join(pitch("y", ROW_GAP, CARD_HEIGHT, "height"), page, "full")


def words_in_boxes(words: DataFrame, boxes: DataFrame, page: list[str]) -> DataFrame:
    """Words (x0, y0, x1, y1) whose centre lies in a box (left, top, right, bottom) of their page."""
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return words.withColumns({"__x": x, "__y": y}).join(boxes, page).where("__x >= left AND __x < right AND __y >= top AND __y < bottom").drop("__x", "__y")


def compiled_template(labels: DataFrame, layout: str, cards: DataFrame) -> DataFrame:
    """Per layout and label seen in half of the layout's cards or more: upper medians of its place in the card."""
    total = cards.groupBy(layout).agg(F.countDistinct("card").alias("__cards"))
    seen = labels.groupBy(layout, "label").agg(F.countDistinct("card").alias("cards"), upper_median("dx").alias("dx"), upper_median("dy").alias("dy"))
    return seen.join(total, layout).where("cards * 2 >= __cards").drop("__cards")
