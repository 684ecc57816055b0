"""House numbers as they are read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, fold_digits, strip
from .transliterate import transliterate

# Words as they are misread, and as they are printed; and what is read from a frame beside the number.
SPELLINGS = {"हाऊस": "हाउस", "न॑": "नं", "नें.": "नं.", "नं इ": "नं 1"}
FRAME = "पाटकबबः"
NO_HOUSE = ("UTTARPRADESH",)


def cleaned(value: Column) -> Column:
    """The number without a read frame and its next Devanagari word, commas as spaces, and usual misreadings put right."""
    words = F.split(strip(F.translate(value, ",،", "  ")), r"\s+")
    framed = F.get(words, F.lit(0)).startswith(FRAME)
    first = F.when(~framed, 1).when(F.coalesce(F.get(words, F.lit(1)), F.lit("")).rlike("^[व-ॿ]"), 3).otherwise(2)
    out = F.array_join(F.filter(words, lambda w, i: i + 1 >= first), " ")
    for read, printed in SPELLINGS.items():
        out = F.replace(out, F.lit(read), F.lit(printed))
    return out


def is_noise(value: Column) -> Column:
    """Brackets and signs without a Devanagari letter or a word of three Latin ones."""
    v = F.coalesce(value, F.lit(""))
    return ~v.rlike("[ऀ-ॿ]") & ~v.rlike("[A-Za-z]{3}") & v.rlike(r"[()\[\]{}+#%&|]")


def slash_number(reads: Column) -> Column:
    """The first number like 132/10 that two reads without letters agree on; /044 stands for 1/044."""
    plain = F.transform(F.filter(reads, lambda r: ~r.rlike("[ऄ-हA-Za-z]")), fold_digits)
    whole = F.flatten(F.transform(plain, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?<!\d)(\d{1,5}\s*/\s*\d{1,4})(?!\d)"), F.lit(1)), lambda m: F.regexp_replace(m, r"\s", ""))))
    short = F.flatten(F.transform(plain, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?<![\d\s])\s*(?<!\d)(?<!\d\s)/\s*(\d{2,4})(?!\d)"), F.lit(1)), lambda m: F.concat(F.lit("1/"), m))))
    found = F.concat(whole, short)
    twice = F.filter(found, lambda m: F.size(F.filter(found, lambda n: n == m)) >= 2)
    return F.get(twice, F.lit(0))


def _tokens(read: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.upper(F.coalesce(read, F.lit(""))), r"[^A-Z0-9/\- ]", " "), r"\s+"), lambda t: t != "")


def agreed_line(first: Column, second: Column) -> Column:
    """The line that two Latin reads share: equal, equal but for one to three-letter words at one's end, or equal but for spaces. Else null, and so for a state's name."""
    a, b = _tokens(first), _tokens(second)
    n = F.least(F.size(a), F.size(b))
    head = F.slice(a, F.lit(1), n) == F.slice(b, F.lit(1), n)
    longer = F.when(F.size(a) >= F.size(b), a).otherwise(b)
    tail = F.slice(longer, n + 1, F.greatest(F.size(longer) - n, F.lit(0)))
    by_words = F.when((n > 0) & head & F.forall(tail, lambda t: t.rlike("^[A-Z]{1,3}$")), F.array_join(F.slice(longer, F.lit(1), n), " "))
    squeezed = lambda t: F.regexp_replace(F.array_join(t, ""), "[^A-Z0-9]", "")
    by_letters = F.when((n > 0) & (squeezed(a) == squeezed(b)), F.array_join(F.when(F.size(a) <= F.size(b), a).otherwise(b), " "))
    out = F.coalesce(by_words, by_letters)
    return F.when(~F.regexp_replace(out, "[^A-Z]", "").isin(*NO_HOUSE), out)


def latin(value: Column) -> Column:
    """Latin letters of a house number; a lone i before a number is the letter E."""
    return F.regexp_replace(transliterate(collapse(value)), r"(?<![A-Za-z])[iI](?=\s*[-–/,.]?\s*\d)", "E")
