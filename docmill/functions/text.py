"""Text cleaning and comparison as column expressions; Unicode forms as Arrow UDFs where Spark has no builtin."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEVANAGARI_DIGITS = "०१२३४५६७८९"
_EDGE = r"^[\s\p{Z}\x{1C}-\x{1F}\x{85}]+|[\s\p{Z}\x{1C}-\x{1F}\x{85}]+$"


def strip(value: Column) -> Column:
    """Without white space at both ends, Unicode spaces included."""
    return F.regexp_replace(value.cast("string"), _EDGE, "")


def blank_to_null(value: Column) -> Column:
    """Stripped text, null where nothing is left."""
    return F.nullif(strip(value), F.lit(""))


def collapse(value: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(value, r"[\s\p{Z}]+", " "))


def fold_digits(value: Column) -> Column:
    return F.translate(value, DEVANAGARI_DIGITS, "0123456789")


# Capital letters of another alphabet, and the Devanagari letters and signs that they are read for; small letters are read like them.
LOOKALIKES = {
    "А": "अ", "Б": "भ", "В": "व", "Г": "ग", "Д": "द", "Е": "ए", "Ж": "झ", "З": "ज", "И": "इ", "Й": "य", "К": "क", "Л": "ल", "М": "म", "Н": "न", "О": "ओ", "П": "प",
    "Р": "र", "С": "स", "Т": "त", "У": "उ", "Ф": "फ", "Х": "ह", "Ц": "थ", "Ч": "च", "Ш": "ष", "Щ": "श", "Ъ": "\u094d", "Ы": "\u094f", "Ь": "\u094d", "Э": "ए", "Ю": "य", "Я": "य",
}
LOOKALIKES |= {capital.lower(): letter for capital, letter in LOOKALIKES.items()}
STRESS_MARKS, ANUSVARA = "\u0951\u0952", "\u0902"


def fold_lookalikes(value: Column) -> Column:
    """Cyrillic letters as the Devanagari letters they were read for."""
    return F.translate(value, "".join(LOOKALIKES), "".join(LOOKALIKES.values()))


def fold_stress(value: Column) -> Column:
    """Stress marks as the anusvara they were read for."""
    return F.translate(value, STRESS_MARKS, ANUSVARA * len(STRESS_MARKS))


def lenient_int(value: Column) -> Column:
    """Integer, 0 kept, null for anything that isn't a whole number; Devanagari digits count."""
    text = fold_digits(strip(value))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def strict_int(value: Column) -> Column:
    """Struct of value and bad: blank is null, a boolean or other text is bad."""
    text = fold_digits(strip(value))
    number = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))
    return F.struct(number.alias("value"), (F.coalesce(text, F.lit("")) != "").__and__(number.isNull()).alias("bad"))


def has_devanagari(value: Column) -> Column:
    return F.coalesce(value.rlike("[ऀ-ॿ]"), F.lit(False))


def cut(value: Column, most: int = 80) -> Column:
    """A display cell: white space collapsed, at most ``most`` characters and an ellipsis."""
    text = collapse(value)
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"))).otherwise(text)


def distance_within(a: Column, b: Column, most: int) -> Column:
    """Edit distance, null above ``most``."""
    return F.nullif(F.levenshtein(a, b, most), F.lit(-1))


def squash(value: Column) -> Column:
    """Spelling fold: a-z only, long i and u as short ones, repeated letters as one."""
    text = F.regexp_replace(F.lower(value), "[^a-z]", "")
    for long, short in (("ee", "i"), ("ii", "i"), ("oo", "u"), ("uu", "u")):
        text = F.replace(text, F.lit(long), F.lit(short))
    return F.regexp_replace(text, r"(.)\1+", "$1")


def label(value: Column) -> Column:
    """Lower case; hyphens, underscores and runs of spaces as one space."""
    return strip(F.regexp_replace(F.lower(value), r"[-_\s]+", " "))


def label_matches(have: Column, want: Column) -> Column:
    """Equal labels; a wholly numeric wish also matches a label that starts with that number as a word."""
    h, w = label(have), label(want)
    return (h == w) | (w.rlike(r"^\d+$") & F.startswith(h, F.concat(w, F.lit(" "))))


def safe_file_name(value: Column, most: int = 180) -> Column:
    """A name without path and control characters, reserved device names prefixed, at most ``most`` characters."""
    name = F.regexp_replace(value, r'[\\/:*?"<>|\x00-\x1f]+', "_")
    name = F.regexp_replace(strip(name), r"^[. ]+|[. ]+$", "")
    name = F.when(F.upper(name).rlike(r"^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])(\..*)?$"), F.concat(F.lit("_"), name)).otherwise(name)
    return F.when(name == "", F.lit("file")).otherwise(F.substring(name, 1, most))


def search(columns: Sequence[Column], term: str | None) -> Column:
    """Whether any column has the trimmed term, in any case; % and _ in it stay wildcards, and a blank term finds all."""
    term = (term or "").strip()
    if not term:
        return F.lit(True)
    found = F.lit(False)
    for c in columns:
        found = found | F.coalesce(c.cast("string").ilike(f"%{term}%"), F.lit(False))
    return found


@F.pandas_udf(T.StringType())
def nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFC", v))


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def _ordered(text: str | None) -> str | None:
    """Marks after each base character in canonical order, equal classes in place."""
    if text is None:
        return None
    out: list[str] = []
    marks: list[str] = []
    for ch in text:
        if unicodedata.category(ch).startswith("M"):
            marks.append(ch)
        else:
            out += sorted(marks, key=unicodedata.combining) + [ch]
            marks = []
    return "".join(out + sorted(marks, key=unicodedata.combining))


@F.pandas_udf(T.StringType())
def order_marks(values: pd.Series) -> pd.Series:
    return values.map(_ordered)


def _skeleton(text: str | None) -> str | None:
    if text is None:
        return None
    kept = (c for c in unicodedata.normalize("NFC", text) if "ऀ" <= c <= "ॿ" and unicodedata.category(c) not in ("Mn", "Mc", "Me") and c not in "।॥")
    return "".join(kept)


@F.pandas_udf(T.StringType())
def skeleton(values: pd.Series) -> pd.Series:
    """The Devanagari letters without vowel signs and other marks."""
    return values.map(_skeleton)


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching runs, from 0 to 1; null with a null side."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")
