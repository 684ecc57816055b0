"""What a roll's file name says, and numbers that several readings must agree on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scoring import REVIEW_AGE
from .text import lenient_int, strip


def file_name_parts(name: Column) -> Column:
    """Struct of a roll's file name, null for another name.

    A name has ten pieces between hyphens: year, EROLLGEN, state, constituency,
    SIR, kind of roll, revision, language, part, and WI.pdf; case doesn't matter.
    """
    piece = F.split(F.element_at(F.split(name, "/"), -1), "-")
    at = lambda i: F.get(piece, F.lit(i))
    same = lambda i, word: F.lower(at(i)) == word
    whole = lambda c: c.rlike(r"^\d+$")
    state, revision = F.upper(at(2)), F.lower(at(6))
    good = (
        (F.size(piece) == 10) & at(0).rlike(r"^\d{4}$") & same(1, "erollgen") & state.rlike(r"^S\d+$") & whole(at(3)) & same(4, "sir")
        & (same(5, "finalroll") | same(5, "draftroll")) & revision.rlike(r"^revision\d+$") & at(7).rlike(r"^[A-Za-z]+$") & whole(at(8)) & same(9, "wi.pdf")
    )
    number = lambda c: c.try_cast("int")
    return F.when(good, F.struct(
        number(at(0)).alias("year"), state.alias("state"), number(at(3)).alias("ac"), F.when(same(5, "finalroll"), "final").otherwise("draft").alias("kind"),
        number(F.replace(revision, F.lit("revision"))).alias("revision"), F.upper(at(7)).alias("language"), number(at(8)).alias("part"),
    ))


def part_number(cover: Column, file_name: Column) -> Column:
    """Struct of part_number, source, on_cover and in_file_name: a number in the file name goes before the cover's, and both are kept where they differ."""
    named = F.regexp_extract(F.coalesce(file_name, F.lit("")), r"(?i)-(\d{1,4})-wi\.pdf$", 1).try_cast("int")
    differs = named.isNotNull() & ~cover.eqNullSafe(named)
    return F.struct(
        F.coalesce(named, cover).alias("part_number"), F.when(differs, "filename").otherwise("cover").alias("source"), F.when(differs, cover).alias("on_cover"), named.alias("in_file_name"),
    )


def agreed_age(reads: Column, tight: Column | None = None, bounds: tuple[int, int] = REVIEW_AGE) -> Column:
    """The age that all usable reads have, where two do; a lone one needs an equal tight read, which also counts where there is none."""
    usable = lambda r: lenient_int(r).between(*bounds)
    valid = F.filter(F.transform(reads, strip), lambda r: F.coalesce(usable(r), F.lit(False)))
    kinds = F.size(F.array_distinct(valid))
    out = F.when((kinds == 1) & (F.size(valid) >= 2), F.get(valid, F.lit(0)))
    if tight is None:
        return out
    again = F.when(F.coalesce(usable(tight), F.lit(False)), strip(tight))
    return F.when(kinds > 1, F.lit(None).cast("string")).otherwise(F.coalesce(out, F.when((kinds == 0) | F.array_contains(valid, again), again)))


def section_code(runs: Column, known: Column) -> Column:
    """The first run of digits that is a known section; without one, the first whose last digit is; else blank."""
    clean = F.transform(F.coalesce(runs, F.array().cast("array<string>")), strip)
    first = lambda tries: F.get(F.filter(tries, lambda r: F.array_contains(known, r)), F.lit(0))
    return F.coalesce(first(clean), first(F.transform(clean, lambda r: F.right(r, F.lit(1)))), F.lit(""))


def number_vote(normalised: Column, reads: Column) -> Column:
    """The first value that two of all reads have; without one, the first other read with as many digits as the normalised one; else null."""
    others = F.filter(reads, lambda r: F.coalesce(r != "", F.lit(False)))
    every = F.concat(F.array(normalised), others)
    twice = F.filter(every, lambda r: F.size(F.filter(every, lambda x: x == r)) >= 2)
    digits = lambda c: F.length(F.regexp_replace(c, r"\D", ""))
    alike = F.filter(others, lambda r: digits(r) == digits(normalised))
    return F.coalesce(F.get(twice, F.lit(0)), F.get(alike, F.lit(0)))
