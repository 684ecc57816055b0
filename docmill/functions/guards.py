"""Reasons not to take a model's spelling of a name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A piece of two letters or more three times in a row, or one character five times.
REPEATS = (r"(\S.{1,29}?)\1\1", r"(.)\1\1\1\1")


def reasons(source: Column, answer: Column, meanings: Sequence[str] = ()) -> Column:
    """Array of reasons; empty for a usable answer. A blank source switches the length and digit rules off.

    meanings lists words (lower case) that a name's meaning is translated to,
    as the caller's language needs them; an answer that begins with "the" counts always.
    """
    out = F.coalesce(answer, F.lit(""))
    src = F.coalesce(source, F.lit(""))
    plain = F.trim(F.regexp_replace(F.lower(F.trim(out)), r"[^\p{L}\p{N}\s]", ""))
    lost = F.array_except(F.regexp_extract_all(src, F.lit(r"(\d)"), F.lit(1)), F.regexp_extract_all(out, F.lit(r"(\d)"), F.lit(1)))
    checks = (
        (out.rlike("[ऀ-ॿ]"), "devanagari residue"),
        (out.rlike(r"[\p{Mn}\p{Mc}À-ÖØ-öø-ɏḀ-ỿ]"), "orphan combining marks"),
        (out.rlike(REPEATS[0]) | out.rlike(REPEATS[1]), "degenerate repetition"),
        ((plain.isin(*meanings) if meanings else F.lit(False)) | plain.startswith("the "), "meaning drift"),
        ((src != "") & (F.length(out) > 3 * F.greatest(F.length(src), F.lit(4))), "runaway length"),
        (F.size(lost) > 0, "digits lost"),
    )
    found = F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in checks]))
    return F.when(F.trim(out) == "", F.array(F.lit("empty"))).otherwise(found)
