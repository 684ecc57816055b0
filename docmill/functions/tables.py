"""Table functions for SQL: ``SELECT ... FROM t, LATERAL page_list(t.text)``."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..shipping import ship


def _asked(name: str, given: AnalyzeArgument, kinds: tuple) -> None:
    if not isinstance(given.dataType, kinds):
        raise ValueError(f"{name} takes {' or '.join(k().typeName() if k is not ArrayType else 'array' for k in kinds)}, not {given.dataType.simpleString()}")


@udtf
class PageList:
    """position and page for each page of '2,4-6', each page once in the order of its first place; a bad piece makes the whole list empty."""

    @staticmethod
    def analyze(text: AnalyzeArgument) -> AnalyzeResult:
        _asked("page_list", text, (StringType,))
        return AnalyzeResult(StructType().add("position", IntegerType()).add("page", IntegerType()))

    def eval(self, text: str | None) -> Iterator[tuple[int, int]]:
        spans = []
        for piece in filter(None, (p.strip() for p in (text or "").split(","))):
            m = re.fullmatch(r"([1-9]\d{0,5})(?:\s*-\s*([1-9]\d{0,5}))?", piece)
            if not m or int(m[2] or m[1]) < int(m[1]):
                return
            spans.append(range(int(m[1]), int(m[2] or m[1]) + 1))
        seen: set[int] = set()
        for span in spans:
            for page in span:
                if page not in seen:
                    seen.add(page)
                    yield len(seen), page


@udtf
class CardFields:
    """label and value of a card's lines (an array, or one text with line feeds): a value ends at the next label or the line's end, and a label's first value counts."""

    @staticmethod
    def analyze(lines: AnalyzeArgument) -> AnalyzeResult:
        _asked("card_fields", lines, (StringType, ArrayType))
        return AnalyzeResult(StructType().add("label", StringType()).add("value", StringType()))

    def __init__(self):
        from ..operators.cards import CARD_LABELS

        # In the order of the list, so that a label that holds another comes before it.
        self.any = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in CARD_LABELS.items()), re.IGNORECASE)

    def eval(self, lines) -> Iterator[tuple[str, str]]:
        found: dict[str, str] = {}
        for line in (lines.split("\n") if isinstance(lines, str) else lines or ()):
            marks = list(self.any.finditer(line or ""))
            for m, ends in zip(marks, [*(n.start() for n in marks[1:]), len(line or "")]):
                value = re.sub(r"[\s.;:|\-]+$", "", re.sub(r"^[\s:：.\-+|]+", "", line[m.end() : ends]))
                if value:
                    found.setdefault(m.lastgroup, value)
        yield from found.items()


def register(spark: SparkSession) -> None:
    """Make page_list and card_fields known to the session's SQL."""
    ship(spark)
    spark.udtf.register("page_list", PageList)
    spark.udtf.register("card_fields", CardFields)
