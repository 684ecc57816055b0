"""Writing results: CSV, workbook rows, JSON pages and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import display
from ..operators import browse
from .workbook import Workbook

BOM = "﻿"


def write_csv(df: DataFrame, path: str, excel: bool = True) -> None:
    """CSV files with a header; for Excel each file begins with a byte order mark."""
    if excel:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    df.write.mode("overwrite").option("header", "true").option("emptyValue", "").csv(path)


def attempt_rows(records: DataFrame, attempts: DataFrame, attempt: str, number: str) -> DataFrame:
    """Records of one attempt each, with the attempt's number as the first column."""
    out = records.join(attempts.select(attempt, F.col(number).alias("attempt")), attempt)
    return out.select("attempt", *records.columns)


def workbook_rows(df: DataFrame, labels: dict[str, str], deleted: str | None = None) -> Iterator[tuple]:
    """A header and then the rows, as a workbook writer takes them: partition by partition, booleans as words, a last flag for deleted rows."""
    cols = [c for c in df.columns]
    yield (*[labels.get(c, c) for c in cols], "__deleted")
    kinds = dict(df.dtypes)
    shown = [display.bool_word(c, F.col(c)).alias(c) if kinds[c] == "boolean" else F.col(c) for c in cols]
    flag = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    for row in df.select(*shown, flag.alias("__deleted")).toLocalIterator(prefetchPartitions=True):
        yield tuple(row)


def _told(rows: Iterator[tuple], progress: Callable[[int], None] | None) -> Iterator[tuple]:
    for n, row in enumerate(rows):
        if progress and n and n % 250 == 0:
            progress(n)
        yield row


def write_workbook(df: DataFrame, path: str, labels: dict[str, str] | None = None, deleted: str | None = None, progress: Callable[[int], None] | None = None) -> int:
    """An .xlsx file with one sheet, streamed; deleted rows are red. progress is told every 250 rows. Returns the number of records."""
    return Workbook(path).add("Records", _told(workbook_rows(df, labels or {}, deleted), progress)).close()[0] - 1


def write_documents_workbook(documents: dict[str, DataFrame], review: DataFrame, path: str, columns: list[str], deleted: str | None = None) -> dict[str, int]:
    """An .xlsx file with a sheet of the chosen columns per document, and a sheet "Review summary". Returns the number of records by document."""
    book = Workbook(path)
    for name, df in documents.items():
        flag = [deleted] if deleted and deleted not in columns else []
        rows = workbook_rows(df.select(*[c for c in columns if c in df.columns], *flag), {}, deleted)
        book.add(name, (r[: len(r) - 1 - len(flag)] + r[-1:] for r in rows))
    counts = book.add("Review summary", workbook_rows(review, {})).close()
    return {name: n - 1 for name, n in zip(documents, counts)}


def write_found(df: DataFrame, table: browse.Table, path: str, term: str | None = None, filters: Sequence[Column] = (), language: str | None = None) -> None:
    """CSV of the rows that a search and filters leave, in the table's columns."""
    rows = browse.found(df, table, term)
    for f in filters:
        rows = rows.where(f)
    write_csv(browse.projected(rows, table, language), path)


def review_summary(df: DataFrame, document: str, reasons: str) -> DataFrame:
    """Per document and reason, how many records have it."""
    return df.select(document, F.explode(reasons).alias("reason")).groupBy(document, "reason").agg(F.count("*").alias("n"))


def json_page(page: DataFrame, deleted: str | None = None, most: int = 4000) -> DataFrame:
    """One JSON object per row: display cells, raw texts of at most ``most`` characters under __raw_, and __deleted."""
    cols = [c for c in page.columns if c not in ("pages", "has_more")]
    cells = [display.cell(c, F.col(c)).alias(c) for c in cols]
    raws = [F.substring(F.col(c).cast("string"), 1, most).alias(f"__raw_{c}") for c in cols]
    flag = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    return page.select(F.to_json(F.struct(*cells, *raws, flag.alias("__deleted"))).alias("value"))


def write_report(summary: DataFrame, rows: DataFrame, path: str) -> None:
    """Two folders of JSON lines: summary and rows."""
    summary.write.mode("overwrite").json(f"{path}/summary")
    rows.write.mode("overwrite").json(f"{path}/rows")
