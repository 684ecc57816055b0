"""Names and closed vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, strip

#: What stands in a name cell that has no value.
MISSING = "—"

# Printed labels and the English words they stand for.
GENDER = {"पुरुष": "Male", "पुरूष": "Male", "पु": "Male", "महिला": "Female", "स्त्री": "Female", "म": "Female", "तृतीय लिंग": "Third Gender"}
RELATION = {"पिता": "father", "पति": "husband", "माता": "mother", "अन्य": "other"}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for p in pairs.items() for x in p])


def parts(name: Column, only_words: bool = False) -> Column:
    """Struct of first, middle and last: one word is the first, two are first and last. only_words drops tokens without a letter or digit."""
    words = F.filter(F.split(strip(name), r"\s+"), lambda w: w.rlike(r"[\p{L}\p{N}]") if only_words else w != "")
    n = F.size(words)
    return F.struct(
        F.when(n >= 1, F.get(words, F.lit(0))).alias("first"),
        F.when(n >= 3, F.array_join(F.slice(words, F.lit(2), n - 2), " ")).alias("middle"),
        F.when(n >= 2, F.get(words, n - 1)).alias("last"),
    )


def join(*pieces: Column) -> Column:
    """Pieces that aren't blank with one space between, null if none is left."""
    return F.nullif(F.concat_ws(" ", *[blank_to_null(p) for p in pieces]), F.lit(""))


def cell(name: Column) -> Column:
    return F.coalesce(blank_to_null(name), F.lit(MISSING))


def gender_english(value: Column) -> Column:
    return F.try_element_at(_map(GENDER), strip(value))


def gender_bucket(value: Column) -> Column:
    """male, female or third from a word in either language, read with OCR's slips; third is looked for first."""
    v = F.lower(strip(value))
    return (
        F.when(v.rlike("तृतीय|ततीय|third|trans|^t$"), "third")
        .when(v.rlike("महिला|महीला|स्त्री|^म$|female|^f$"), "female")
        .when(v.rlike("पुरुष|पुरूष|^पु|male|^m$"), "male")
    )


def relation_key(value: Column) -> Column:
    """The English key of a printed relation; an English word is its own key, an unknown printed word has none."""
    v = F.lower(strip(value))
    return F.coalesce(F.try_element_at(_map(RELATION), v), F.when(v.rlike("^[a-z]+$"), v))


def relation_printed(key: Column) -> Column:
    return F.try_element_at(_map({v: k for k, v in RELATION.items()}), F.lower(strip(key)))


def corrected(name: Column, corrections: Column) -> Column:
    """The name with a map of corrections applied to the whole, then to each word, then to the whole again."""
    look = lambda v: F.coalesce(F.try_element_at(corrections, v), v)
    whole = look(strip(name))
    words = F.array_join(F.transform(F.split(whole, r"\s+"), look), " ")
    return look(words)
