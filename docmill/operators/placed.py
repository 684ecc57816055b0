"""Words with places on a page: which layout a page has, its card boxes, and the lines of each card.

Words are rows of a page (its key columns) with x0, y0, x1, y1 in points and
word. A card is known by its printed ID.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip
from .aggregates import upper_median
from .windows import clustered

# The printed forms of an ID, and the known grid of three columns and ten rows as shares of the page.
ID_FORM = r"^(?:[A-Z]{3}[0-9]{6,8}|[A-Z]{2}/[0-9]{2}/[0-9]{3}/[0-9]{6})$"
LEFT_MARGIN, RIGHT_MARGIN, COLUMN_SPACE, SLACK, COLUMNS = 0.011, 0.019, 0.0055, 0.02, 3
ROWS = [(0.0325, 0.1209), (0.1266, 0.2155), (0.2213, 0.3099), (0.3155, 0.4042), (0.4094, 0.4982), (0.5035, 0.5921), (0.5975, 0.6863), (0.6917, 0.7806), (0.786, 0.8748), (0.8802, 0.969)]
# How many IDs make a page, and what a grid needs.
LEAST_IDS, GRID_HITS, GRID_SHARE, GRID_COLUMNS = 4, 6, 0.6, 2
# Points between rows of IDs, columns of IDs, and rows that count; shares of the pitch; what there is without a pitch.
ROW_GAP, LEAST_PITCH_X, LEAST_PITCH_Y, WIDTH_SHARE, HEIGHT_SHARE = 18.0, 40.0, 24.0, 0.92, 0.90
LEAST_WIDTH, EDGE, HEIGHT, ABOVE, BEFORE, BEFORE_SHARE = 160.0, 12.0, 140.0, 6.0, 40.0, 0.25
LINE_GAP = 8.0
#: Side of the cells in which words meet boxes.
CELL = 128.0


def id_token(word: Column) -> Column:
    """The word without white space and points at its ends, in upper case."""
    return F.upper(F.regexp_replace(strip(F.coalesce(word, F.lit(""))), r"^[.,;:|]+|[.,;:|]+$", ""))


def ids(words: DataFrame) -> DataFrame:
    """The words that are IDs, with id."""
    return words.withColumn("id", id_token(F.col("word"))).where(F.col("id").rlike(ID_FORM))


def with_cluster(rows: DataFrame, group: list[str], value: str, gap: float, name: str) -> DataFrame:
    """rows with the number of their cluster (see ``clustered``) within the group; null without a value.

    Clusters' first values and the rows are put in one order, and each row takes
    the last cluster before it, so no two rows of a group are paired.
    """
    v = F.col(value).cast("double")
    starts = clustered(rows, group, value, gap).select(*group, F.col("first").alias("__v"), F.col("cluster").alias(name))
    here = rows.withColumns({"__v": v, name: F.lit(None).cast("int"), "__row": F.lit(1)})
    both = here.unionByName(starts.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*group).orderBy(F.col("__v").asc_nulls_first(), "__row").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(name, F.last(name, ignorenulls=True).over(w)).where("__row = 1").drop("__v", "__row")


def layout_kinds(words: DataFrame, page: list[str], sizes: DataFrame) -> DataFrame:
    """Per page of ``sizes`` (page, page_width, page_height): ids, hits, columns, and kind.

    kind is none without an ID, few with fewer than LEAST_IDS, known where enough
    IDs have their centre in the cells of the known grid, in two columns or more,
    and else other.
    """
    width = (1 - LEFT_MARGIN - RIGHT_MARGIN - COLUMN_SPACE * (COLUMNS - 1)) / COLUMNS
    lefts = [LEFT_MARGIN + k * (width + COLUMN_SPACE) for k in range(COLUMNS)]
    known = ids(words).join(sizes, page)
    x, y = (F.col("x0") + F.col("x1")) / 2 / F.col("page_width"), (F.col("y0") + F.col("y1")) / 2 / F.col("page_height")
    column = F.coalesce(*[F.when(x.between(a - SLACK, a + width + SLACK), k) for k, a in enumerate(lefts)])
    row = F.coalesce(*[F.when(y.between(a - SLACK, b + SLACK), k) for k, (a, b) in enumerate(ROWS)])
    hit = column.isNotNull() & row.isNotNull()
    found = known.groupBy(*page).agg(F.count("*").alias("ids"), F.count_if(hit).alias("hits"), F.count_distinct(F.when(hit, column)).alias("columns"))
    out = sizes.select(*page).join(found, page, "left").na.fill(0, ["ids", "hits", "columns"])
    grid = (F.col("hits") >= GRID_HITS) & (F.col("hits") >= GRID_SHARE * F.col("ids")) & (F.col("columns") >= GRID_COLUMNS)
    return out.withColumn("kind", F.when(F.col("ids") == 0, "none").when(F.col("ids") < LEAST_IDS, "few").when(grid, "known").otherwise("other"))


def card_boxes(words: DataFrame, page: list[str], sizes: DataFrame, least: int = LEAST_IDS) -> DataFrame:
    """A box for every ID of the pages with ``least`` IDs or more: page, id, left, top, width, height.

    Width and height are shares of the page's pitch: the upper medians of the
    distances between neighbours in a row of IDs, and between the tops of rows.
    Without neighbours a box runs to the page's edge, or has a usual height.
    """
    rows = with_cluster(ids(words), page, "y0", ROW_GAP, "__band")
    in_band = Window.partitionBy(*page, "__band").orderBy("x0", "y0", "id")
    in_page = Window.partitionBy(*page)
    # Rows are together by page from their bands on: windows take it from there without another shuffle. Tops rise from band to band.
    dx = F.col("x0") - F.lag("x0").over(in_band)
    rows = rows.withColumns({"__dx": F.when(dx > LEAST_PITCH_X, dx), "__first": F.row_number().over(in_band) == 1, "__top": F.min("y0").over(Window.partitionBy(*page, "__band"))})
    dy = F.col("__top") - F.max("__top").over(in_page.orderBy("__band").rangeBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__dy", F.when(F.col("__first") & (dy > LEAST_PITCH_Y), dy))
    rows = rows.withColumns({"__px": upper_median("__dx").over(in_page), "__py": upper_median("__dy").over(in_page), "__ids": F.count("*").over(in_page)})
    every = rows.where(F.col("__ids") >= least).join(sizes, page)
    one = lambda c: F.bround(c, 1)
    every = every.withColumn("width", F.when(F.col("__px").isNotNull(), one(F.col("__px") * WIDTH_SHARE)).otherwise(one(F.greatest(F.lit(LEAST_WIDTH), F.col("page_width") - F.col("x0") - EDGE))))
    height = F.when(F.col("__py").isNotNull(), one(F.col("__py") * HEIGHT_SHARE)).otherwise(F.lit(HEIGHT))
    left = one(F.greatest(F.lit(0.0), F.col("x0") - F.least(F.lit(BEFORE), F.col("width") * BEFORE_SHARE)))
    return every.select(*page, "id", left.alias("left"), one(F.greatest(F.lit(0.0), F.col("y0") - ABOVE)).alias("top"), "width", height.alias("height"))


def words_in_boxes(words: DataFrame, boxes: DataFrame, page: list[str], cell: float = CELL) -> DataFrame:
    """Each word with each box (left, top, width, height, edges included) of its page that holds its centre.

    A box is dealt to the cells that it touches, and a word to the one cell of
    its centre, so words meet only boxes near them, however full a page is.
    """
    at = lambda c: F.floor(c / cell)
    every = lambda a, b: F.explode(F.sequence(at(a), at(b)))
    right, bottom = F.col("left") + F.col("width"), F.col("top") + F.col("height")
    fit = boxes.where((F.col("width") >= 0) & (F.col("height") >= 0))
    cells = fit.withColumn("__cx", every(F.col("left"), right)).withColumn("__cy", every(F.col("top"), bottom))
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    placed = words.withColumns({"__x": x, "__y": y}).withColumns({"__cx": at(F.col("__x")), "__cy": at(F.col("__y"))})
    inside = F.col("__x").between(F.col("left"), right) & F.col("__y").between(F.col("top"), bottom)
    return placed.join(cells.hint("merge"), [*page, "__cx", "__cy"]).where(inside).drop("__x", "__y", "__cx", "__cy")


def _held(words: DataFrame, boxes: DataFrame, page: list[str], cell: float = CELL) -> DataFrame:
    """The words (x0, y0, x1, y1, word) that boxes hold, as ``words_in_boxes`` says: page, id, left, top and w, a struct of y0, x0 and word.

    Words and boxes are shuffled once, by page, before boxes are dealt to cells. Cells and
    boxes are then groups of rows that are together already, so neither cells nor pairs are shuffled.
    """
    double = lambda *names: [F.col(c).cast("double") for c in names]
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    facts = ["__a", "__b", "__c", "__d", "__text", "__box"]
    # Of a word its centre and x0 and y0, of a box left, top, width and height.
    one = words.where(x.isNotNull() & y.isNotNull()).select(*page, x.cast("double"), y.cast("double"), *double("x0", "y0"), "word", F.lit(False))
    two = boxes.where((F.col("width") >= 0) & (F.col("height") >= 0)).select(*page, *double("left", "top", "width", "height"), "id", F.lit(True))
    names = [*page, *facts]
    both = one.toDF(*names).unionByName(two.toDF(*names)).dropna(subset=page).repartition(*page)
    at = lambda c: F.floor(c / cell)
    end = lambda a, size: at(F.when(F.col("__box"), F.col(a) + F.col(size)).otherwise(F.col(a)))
    cells = both.withColumn("__cx", F.explode(F.sequence(at(F.col("__a")), end("__a", "__c")))).withColumn("__cy", F.explode(F.sequence(at(F.col("__b")), end("__b", "__d"))))
    near = F.collect_list(F.when(F.col("__box"), F.struct(F.col("__a").alias("left"), F.col("__b").alias("top"), F.col("__c").alias("width"), F.col("__d").alias("height"), F.col("__text").alias("id"))))
    met = cells.withColumn("__near", near.over(Window.partitionBy(*page, "__cx", "__cy"))).where("NOT __box")
    inside = lambda b: F.col("__a").between(b["left"], b["left"] + b["width"]) & F.col("__b").between(b["top"], b["top"] + b["height"])
    word = F.struct(F.col("__d").alias("y0"), F.col("__c").alias("x0"), F.col("__text").alias("word"))
    held = met.select(*page, F.explode(F.filter("__near", inside)).alias("__b"), word.alias("w"))
    kinds = {c: boxes.schema[c].dataType for c in ("id", "left", "top")}
    return held.select(*page, *[F.col(f"__b.{c}").cast(k).alias(c) for c, k in kinds.items()], "w")


def card_lines(words: DataFrame, boxes: DataFrame, page: list[str]) -> DataFrame:
    """Per box with words: page, id, left, top, and lines, an array of texts from top to bottom.

    A line ends where a word lies more than LINE_GAP below the line's first.
    Words of a line stand from left to right; blank ones are left out. Boxes of
    one page with the same id, left and top are one.
    """
    box = [*page, "id", "left", "top"]
    named = words.select(*page, "x0", "y0", "x1", "y1", strip(F.coalesce("word", F.lit(""))).alias("word"))
    # A box's words, few or many, become one row as its lines do.
    words_ = _held(named, boxes.dropDuplicates(box), page).groupBy(*box).agg(F.sort_array(F.collect_list("w")).alias("__words"))
    # Where lines begin: words are sorted by y0, so a pass over them tells it.
    none = F.array().cast("array<double>")
    starts = F.aggregate("__words", none, lambda f, w: F.when((F.size(f) == 0) | (w["y0"] - F.element_at(f, -1) > LINE_GAP), F.concat(f, F.array(w["y0"].cast("double")))).otherwise(f))
    placed = words_.withColumn("__starts", starts)
    full = F.filter("__words", lambda w: w["word"] != "")
    by_x = lambda ws: F.array_sort(F.transform(ws, lambda w: F.struct(w["x0"], w["y0"], w["word"])))
    within = lambda f, i: lambda w: (w["y0"] >= f) & F.coalesce(w["y0"] < F.get("__starts", i + 1), F.lit(True))
    texts = F.transform("__starts", lambda f, i: F.array_join(F.transform(by_x(F.filter("__full", within(f, i))), lambda w: w["word"]), " "))
    out = placed.withColumn("__full", full).where(F.size("__full") > 0).withColumn("lines", F.filter(texts, lambda x: x != ""))
    return out.select(*box, "lines")


def compiled_template(cards: DataFrame, layout: list[str], labels: DataFrame, near: float = 30.0) -> DataFrame:
    """Per layout: its cards' size, columns, labels, and an identity made of them.

    ``cards`` has layout, card, x, width and height; ``labels`` layout, card, label, dx
    and dy. Sizes and places are upper medians, and labels those that half of the cards or
    more have. Columns are x values, each more than ``near`` from the one before that began a column.
    """
    size = cards.groupBy(*layout).agg(F.count("*").alias("cards"), upper_median("width").alias("card_width"), upper_median("height").alias("card_height"))
    columns = clustered(cards, layout, "x", near).groupBy(*layout).agg(F.count("*").alias("columns"))
    each = labels.groupBy(*layout, "label").agg(F.count_distinct("card").alias("__n"), upper_median("dx").alias("dx"), upper_median("dy").alias("dy"))
    seen = each.join(size.select(*layout, "cards"), layout).where("__n * 2 >= cards")
    found = seen.groupBy(*layout).agg(F.sort_array(F.collect_list(F.struct("label", "dx", "dy"))).alias("labels"))
    out = size.join(columns, layout, "left").join(found, layout, "left")
    out = out.withColumn("columns", F.coalesce("columns", F.lit(1))).withColumn("labels", F.coalesce("labels", F.array().cast("array<struct<label:string,dx:double,dy:double>>")))
    short = lambda c: F.regexp_replace(F.col(c).cast("string"), r"\.0$", "")
    name = F.concat_ws("_", F.concat(F.lit("c"), F.col("columns").cast("string")), F.concat(F.lit("w"), short("card_width")), F.concat(F.lit("h"), short("card_height")), F.transform("labels", lambda x: x["label"]))
    return out.withColumn("identity", name)
