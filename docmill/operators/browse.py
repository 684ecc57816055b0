"""Registry-checked projection, search and paging."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import search

PAGE = 100


@dataclass(frozen=True)
class Table:
    """The columns that may be named at all, in their order, and those that a search looks into."""

    columns: tuple[str, ...]
    searchable: tuple[str, ...] = ()


def projected(df: DataFrame, table: Table, language: str | None = None) -> DataFrame:
    """The registry's columns that df has; hi leaves out *_en, en leaves out *_hi."""
    drop = {"hi": "_en", "en": "_hi"}.get(language or "")
    return df.select([c for c in table.columns if c in df.columns and not (drop and c.endswith(drop))])


def found(df: DataFrame, table: Table, term: str | None) -> DataFrame:
    return df.where(search([F.col(c) for c in table.searchable if c in df.columns], term))


def named(df: DataFrame, columns: tuple[str, ...], term: str | None) -> DataFrame:
    """Rows with the term in any of the columns; a blank term keeps all."""
    return df.where(search([F.col(c) for c in columns], term))


#: Parts of names that make a column an extra of an export.
EXTRA_PARTS = ("_first_name_", "_middle_name_", "_sur_name_", "_last_name_")


def export_choices(columns: tuple[str, ...], language: str = "both", extras: tuple[str, ...] = (), english: tuple[str, ...] = ("relationship_type",)) -> list[tuple[str, str, bool, bool, bool]]:
    """What an export offers: name, language (hi, en or common), extra, checked and hidden of each column.

    Columns of the other language are hidden; extras and parts of names begin unchecked.
    """
    offered = []
    for c in columns:
        own = "hi" if c.endswith("_hi") else "en" if c.endswith("_en") or c in english else "common"
        shown = language not in ("hi", "en") or own in (language, "common")
        extra = c in extras or any(p in c for p in EXTRA_PARTS)
        offered.append((c, own, extra, shown and not extra, not shown))
    return offered


def page(df: DataFrame, order: list[Column], number: int, size: int = PAGE) -> DataFrame:
    """Rows of a page (from 1) in an order that ends with a unique column, each with pages and has_more."""
    total = df.count()
    pages = max(1, -(-total // size))
    rows = df.orderBy(*order).offset((number - 1) * size).limit(size)
    return rows.withColumn("pages", F.lit(pages)).withColumn("has_more", F.lit(number < pages))


def age_filter(column: Column, text: str | None) -> Column:
    """An age or an inclusive range like 20-30; anything else filters nothing."""
    lo, _, hi = (text or "").partition("-")
    try:
        a, b = int(lo), int(hi or lo)
    except ValueError:
        return F.lit(True)
    return column.between(a, b)
