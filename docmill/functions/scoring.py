"""Confidence, validity, identity and arbitration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lenient_int, strip

#: Three age ranges on purpose: what can be stored, what needs no review, what a reader accepts.
STORED_AGE, REVIEW_AGE, READ_AGE = (0, 120), (18, 120), (1, 120)
ID_PATTERNS = {"plain": r"^[A-Z]{3}\d{7}$", "slashed": r"^[A-Z]{2}/\d{2}/\d{3}/\d{7}$", "slashed_short": r"^[A-Z]{2}/\d{2}/\d{3}/\d{6}$", "gate": r"^[A-Z]{3}\d{6,8}$"}


def _finite(x: Column) -> Column:
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), x)


def _clamp(x: Column) -> Column:
    return F.when(x < 0, 0.0).when(x > 1, 1.0).otherwise(x)


def field_score(value: Column) -> Column:
    """A field's score (text) from 0 to 1; 0 where it is unusable."""
    return F.coalesce(_clamp(_finite(value.try_cast("double"))), F.lit(0.0))


def confidence_of(word_mean: Column, field_mean: Column, coverage: Column) -> Column:
    """Struct of confidence and coverage from a word mean (0 to 100) and the mean of field scores, either null; for where both are aggregated before."""
    words = _clamp(_finite(word_mean.cast("double")) / 100)
    both = F.when(words.isNotNull() & field_mean.isNotNull(), (words + field_mean) / 2).otherwise(F.coalesce(words, field_mean))
    return F.struct(both.alias("confidence"), coverage.alias("coverage"))


def confidence(word_mean: Column, fields: Column) -> Column:
    """Struct of confidence and coverage (0 to 1) from a word mean (0 to 100) and a map of field scores as text.

    Unusable scores and zeros count as 0 in the mean. Both sources average, one
    stands alone, none gives null. Coverage is the share of fields above 0,
    null without fields.
    """

    def of(scores: Column) -> Column:
        n = F.when(F.size(scores) > 0, F.size(scores))
        sums = F.aggregate(scores, F.struct(F.lit(0.0).alias("a"), F.lit(0).alias("b")), lambda s, x: F.struct((s["a"] + x).alias("a"), (s["b"] + (x > 0).cast("int")).alias("b")))
        return F.transform(F.array(sums), lambda s: F.struct((s["a"] / n).alias("mean"), (s["b"] / n).alias("coverage")))[0]

    # Scores, and then their sums, are made once and used several times.
    made = F.transform(F.array(F.transform(F.map_values(fields), field_score)), of)[0]
    return F.transform(F.array(made), lambda m: confidence_of(word_mean, m["mean"], m["coverage"]))[0]


def stored_confidence(raw: Column) -> Column:
    """Struct of value and error of a reported confidence (text): unusable ones are null, others clamped to 0..1."""
    number = F.when(~F.lower(raw).isin("true", "false"), _finite(raw.try_cast("double")))
    error = F.when(raw.isNotNull() & number.isNull(), "confidence not a number").when((number < 0) | (number > 1), "confidence outside 0–1")
    return F.struct(_clamp(number).alias("value"), error.alias("error"))


def errors(*checks: tuple[Column, str | Column]) -> Column:
    """Array of the messages whose check holds."""
    return F.array_compact(F.array(*[F.when(c, F.lit(m) if isinstance(m, str) else m) for c, m in checks]))


def record_hash(session: Column, page: Column, row: Column) -> Column:
    return F.sha2(F.concat_ws(":", session.cast("string"), page.cast("string"), row.cast("string")), 256)


def repaired_id(text: Column) -> Column:
    """A slashed number kept or given back its slashes; else three characters and then digits, S read as 5, other letters dropped."""
    upper = F.regexp_replace(F.regexp_replace(F.translate(F.upper(F.regexp_replace(text, r"\s+", "")), "\\", "/"), "/+", "/"), "^/|/$", "")
    compact = F.regexp_replace(upper, "[^A-Z0-9]", "")
    slashed = F.when(upper.rlike(ID_PATTERNS["slashed"]), upper).when(compact.rlike(r"^[A-Z]{2}\d{12}$"), F.regexp_replace(compact, r"^(..)(..)(...)(.*)$", "$1/$2/$3/$4"))
    plain = F.regexp_replace(text, "[^A-Za-z0-9]", "")
    rest = F.regexp_replace(F.translate(F.substr(plain, F.lit(4)), "S", "5"), "[^0-9]", "")
    return F.coalesce(slashed, F.when(F.length(plain) <= 3, plain).otherwise(F.concat(F.substring(plain, 1, 3), rest)))


def agreed(reads: Column) -> Column:
    """The one value that all non-blank reads have, else null."""
    found = F.array_distinct(F.filter(reads, lambda r: r.isNotNull() & (strip(r) != "")))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def same_number(a: Column, b: Column) -> Column:
    """Whether two digit runs are one number read twice: one digit differs at most, or the longer has one digit more. Single digits must be equal; blank reads are no number."""
    la, lb = F.length(a), F.length(b)
    close = F.levenshtein(a, b) <= 1
    blank = F.coalesce(strip(a) == "", F.lit(True)) | F.coalesce(strip(b) == "", F.lit(True))
    return F.when(blank, False).when((la == 1) & (lb == 1), a == b).when(F.abs(la - lb) <= 1, close).otherwise(False)


def vote(reads: Column, pattern: str = "[A-Za-z]", least: int = 5) -> Column:
    """Whether at least ``least`` of the reads match."""
    return F.size(F.filter(reads, lambda r: F.coalesce(r.rlike(pattern), F.lit(False)))) >= least


def flagged(reasons: Column, *checks: tuple[Column, str]) -> Column:
    """The reasons with those of the checks that hold added once, in order; no value is changed."""
    return F.array_union(F.coalesce(reasons, F.array().cast("array<string>")), errors(*checks))


def age_flag(age: Column, bounds: tuple[int, int] = REVIEW_AGE) -> Column:
    n = lenient_int(age)
    return F.when(n.isNull(), "age_absent").when(~n.between(*bounds), "age_out_of_range")
