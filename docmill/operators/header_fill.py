"""Header values that a document proves for its own records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import blank_to_null


def document_code(rows: DataFrame, document: str, code: str, fallback: DataFrame, sources: list[str]) -> DataFrame:
    """Per document: its one code, or without any the first of the fallback's sources; with several codes none. origin names where it comes from."""
    out = rows.groupBy(document).agg(F.min(code).alias("__a"), F.max(code).alias("__b"))
    both = out.join(fallback, document, "left")
    one = F.col("__a") == F.col("__b")
    value, origin = F.when(one, F.col("__a")), F.when(one, F.lit("records"))
    for s in sources:
        usable = F.col("__a").isNull() & blank_to_null(F.col(s)).isNotNull()
        origin = F.when(origin.isNotNull(), origin).when(usable, F.lit(s))
        value = F.when(value.isNotNull(), value).when(usable, F.col(s))
    return both.select(document, value.alias(code), origin.alias("origin"))


def filled_sections(rows: DataFrame, document: str, page: str, code: str, name: str, addition: str, cover: DataFrame | None = None) -> DataFrame:
    """Records with a blank section code filled where the nearest pages before and after have the same one.

    Names that begin with ``addition`` are no witnesses. Pages after the last
    or before the first witness are filled only if the document has one code.
    Without any witness, a cover (document, section) with one section counts.
    origin is neighbours, only_code, cover, or null where nothing was filled.
    """
    witness = F.col(code).isNotNull() & ~F.coalesce(F.col(name).startswith(addition), F.lit(False))
    pages = rows.groupBy(document, page).agg(F.max(F.when(witness, F.col(code))).alias("__hi"), F.min(F.when(witness, F.col(code))).alias("__lo"))
    order = Window.partitionBy(document).orderBy(page)
    whole = Window.partitionBy(document)
    pages = pages.select(
        document, page,
        F.last("__hi", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("__before"),
        F.first("__lo", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)).alias("__after"),
        F.min("__lo").over(whole).alias("__min"), F.max("__hi").over(whole).alias("__max"),
    )
    both = rows.join(pages, [document, page], "left")
    if cover is not None:
        once = cover.groupBy(document).agg(F.min("section").alias("__a"), F.max("section").alias("__b")).select(document, F.when(F.col("__a") == F.col("__b"), F.col("__a")).alias("__cover"))
        both = both.join(once, document, "left")
    else:
        both = both.withColumn("__cover", F.lit(None).cast(rows.schema[code].dataType))
    near = F.when(F.col("__before") == F.col("__after"), F.col("__before"))
    only = F.when(F.col("__min") == F.col("__max"), F.col("__min"))
    origin = F.when(F.col(code).isNotNull(), None).when(near.isNotNull(), "neighbours").when(only.isNotNull(), "only_code").when(F.col("__min").isNull() & F.col("__cover").isNotNull(), "cover")
    value = F.coalesce(F.col(code), near, only, F.when(F.col("__min").isNull(), F.col("__cover")))
    return both.withColumns({"origin": origin, code: value}).drop("__before", "__after", "__min", "__max", "__cover")
