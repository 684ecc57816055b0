"""Words for times, sizes and cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, cut, strip

ZONE = "Asia/Kolkata"
# Words for booleans, and cells that say that no house number was printed.
WORDS = {"is_deleted": ("Deleted", "On the roll"), "needs_review": ("Check", "OK"), "is_valid": ("Passed", "Failed")}
NO_HOUSE = ("-", "—", "–", "«", ",")


# Words for states.
STATES = {"pending": "Waiting to start", "queued": "In the queue", "processing": "Being processed", "completed": "Finished", "retry": "Retrying", "failed": "Failed",
          "cancelled": "Stopped", "partial": "Partly finished", "paused": "Paused"}


def state_word(state: Column) -> Column:
    """The state in words; an unknown one with spaces for underscores."""
    known = F.create_map(*[F.lit(x) for p in STATES.items() for x in p])
    return F.coalesce(F.try_element_at(known, state), F.replace(state, F.lit("_"), F.lit(" ")))


# Headlines of errors.
ERRORS = {"EXTRACTION_TIMEOUT": "Took too long", "MODEL_TIMEOUT": "Took too long", "EXTRACTION_FAILED": "Could not read the PDF", "INTERNAL_ERROR": "Something went wrong inside the system",
          "EXTRACTION_SERVICE_UNAVAILABLE": "The reading service is not answering", "INVALID_PDF": "The PDF could not be opened", "INVALID_RESPONSE": "The reply did not make sense",
          "INVALID_CONFIGURATION": "The system is not set up correctly", "EXTRACTOR_HTTP_ERROR": "The reading service had a problem"}


# What events are called.
EVENTS = {"DOCUMENT_DISCOVERED": "New PDF found", "SESSION_CREATED": "Started work on the PDF", "SESSION_STARTED": "Work started", "SESSION_FAILED": "Work stopped with an error", "UNITS_CREATED": "PDF split into batches",
          "UNIT_STARTED": "Started a batch of pages", "UNIT_COMPLETED": "Finished a batch of pages", "UNIT_FAILED": "A batch of pages failed", "UNIT_RETRY": "Retrying a batch of pages",
          "RAW_RESPONSE_SAVED": "Saved the reading result", "RECORDS_SAVED": "Saved voter records", "RECORDS_SKIPPED": "Some records were skipped"}


def code_word(code: Column, words: dict[str, str]) -> Column:
    """What a code stands for; one without an entry in lower case, with spaces and a capital letter."""
    known = F.create_map(*[F.lit(x) for p in words.items() for x in p])
    plain = F.lower(F.replace(code, F.lit("_"), F.lit(" ")))
    return F.coalesce(F.try_element_at(known, code), F.concat(F.upper(F.substring(plain, 1, 1)), F.substr(plain, F.lit(2))))


def local_time(ts: Column, pattern: str = "dd MMM yyyy, HH:mm:ss") -> Column:
    return F.concat(F.date_format(F.from_utc_timestamp(ts, ZONE), pattern), F.lit(" IST"))


def local_midnight(day: Column) -> Column:
    """The UTC time at which a local day begins."""
    return F.to_utc_timestamp(day.cast("timestamp"), ZONE)


def _two(big: Column, big_word: str, small: Column, small_word: str) -> Column:
    text = F.concat(big.cast("string"), F.lit(f" {big_word}"))
    return F.when(small > 0, F.concat(text, F.lit(" "), small.cast("string"), F.lit(f" {small_word}"))).otherwise(text)


def duration(ms: Column, zero: str | None = None) -> Column:
    """'2 min 5 sec'; null for null, and ``zero`` for 0."""
    s = F.floor(ms / 1000).cast("long")
    m = F.floor(s / 60).cast("long")
    return (
        F.when(F.coalesce(ms, F.lit(0)) == 0, F.when(ms == 0, F.lit(zero).cast("string")))
        .when(s < 60, F.concat(s.cast("string"), F.lit(" sec")))
        .when(m < 60, _two(m, "min", s % 60, "sec"))
        .otherwise(_two(F.floor(m / 60).cast("long"), "hr", m % 60, "min"))
    )


def milliseconds(start: Column, end: Column) -> Column:
    """Whole milliseconds, cut; null if negative or unknown."""
    ms = F.floor((F.unix_micros(end) - F.unix_micros(start)) / 1000).cast("long")
    return F.when(ms >= 0, ms)


def between(start: Column, end: Column) -> Column:
    ms = milliseconds(start, end)
    return F.when(ms < 1000, F.lit("under a second")).otherwise(duration(ms))


def remaining(seconds: Column) -> Column:
    """'about 4 min left'; minutes round half to even."""
    m = F.bround(seconds / 60).cast("long")
    left = lambda c: F.concat(F.lit("about "), c, F.lit(" left"))
    return (
        F.when(seconds.isNull() | (seconds < 0), F.lit(None).cast("string"))
        .when(seconds < 60, F.lit("less than a minute left"))
        .when(m < 60, left(F.concat(m.cast("string"), F.lit(" min"))))
        .otherwise(left(_two(F.floor(m / 60).cast("long"), "hr", m % 60, "min")))
    )


def ago(ts: Column, as_of: Column) -> Column:
    s = F.floor((F.unix_micros(as_of) - F.unix_micros(ts)) / 1_000_000).cast("long")
    days = F.floor(s / 86400).cast("long")
    word = F.when(days == 1, " day ago").otherwise(" days ago")
    return (
        F.when(s < 60, F.lit("just now"))
        .when(s < 3600, F.concat(F.floor(s / 60).cast("string"), F.lit(" min ago")))
        .when(s < 86400, F.concat(F.floor(s / 3600).cast("string"), F.lit(" hr ago")))
        .when(s.isNotNull(), F.concat(days.cast("string"), word))
    )


def file_size(size: Column, zero: str | None = None, gigabytes: bool = True) -> Column:
    """'4.6 MB'; null for null, and ``zero`` for 0. Without ``gigabytes`` the largest unit is MB."""
    one = lambda x, unit: F.concat(F.format_string("%.1f", F.bround(x, 1)), F.lit(f" {unit}"))
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, F.when(size == 0, F.lit(zero).cast("string")))
        .when(size < 1024, F.concat(size.cast("long").cast("string"), F.lit(" bytes")))
        .when(size < 1024**2, one(size / 1024, "KB"))
        .when((size < 1024**3) | F.lit(not gigabytes), one(size / 1024**2, "MB"))
        .otherwise(one(size / 1024**3, "GB"))
    )


def backoff(attempt: Column, base: float) -> Column:
    return F.lit(float(base)) * F.pow(F.lit(2.0), attempt - 1)


def masked(name: str, value: Column) -> Column:
    """A value for logs: identity fields show a few characters, others are cut at 97."""
    text = strip(value)
    key = name.lower().replace("-", "_")
    if key in ("epic_number", "epic", "id_card_no", "voter_sr_no", "source_record_hash", "identity") or "epic" in key or key.endswith("_hash"):
        n = F.length(text)
        shown = F.when(n <= 4, F.lit("****")).when(n <= 8, F.concat(F.substring(text, 1, 2), F.lit("…"), F.right(text, F.lit(1)))).otherwise(F.concat(F.substring(text, 1, 4), F.lit("…"), F.right(text, F.lit(2))))
    else:
        shown = F.when(F.length(text) > 100, F.concat(F.substring(text, 1, 97), F.lit("…"))).otherwise(text)
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("—")).otherwise(shown)


def bool_word(name: str, value: Column) -> Column:
    on, off = WORDS.get(name, ("yes", "no"))
    return F.when(value, F.lit(on)).when(~value, F.lit(off)).otherwise(F.lit(""))


def cell(name: str, value: Column) -> Column:
    text = F.coalesce(cut(value.cast("string")), F.lit(""))
    return F.when(text.isin(*NO_HOUSE), F.lit("Not provided in roll")).otherwise(text) if name in ("house_number_hi", "house_number_en") else text


def section_number(status: Column, ward: Column, code: Column) -> Column:
    """The section's number cell; a ward roll has none and shows its ward."""
    own = blank_to_null(ward)
    shown = F.when(own.isNotNull(), F.concat(F.lit("Ward "), own)).otherwise(F.lit("n/a (municipal ward roll)"))
    return F.when(F.coalesce(status, F.lit("")) == "not_applicable", shown).otherwise(F.coalesce(code.cast("string"), F.lit("")))


def page_list(text: str) -> list[int]:
    """Pages of '2,4-6', in order and once each; anything else is refused."""
    pages: list[int] = []
    for piece in filter(None, (p.strip() for p in (text or "").split(","))):
        m = re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", piece)
        if not m or int(m[1]) < 1 or int(m[2] or m[1]) < int(m[1]):
            raise ValueError(f"not a page range: {piece!r}")
        pages += range(int(m[1]), int(m[2] or m[1]) + 1)
    return list(dict.fromkeys(pages))


def pages(text: Column) -> Column:
    """Array of pages of '2,4-6'; null where a piece is no page or range."""
    pieces = F.filter(F.transform(F.split(text, ","), strip), lambda p: p != "")
    good = F.forall(pieces, lambda p: p.rlike(r"^[1-9]\d{0,5}(\s*-\s*[1-9]\d{0,5})?$"))
    ends = F.transform(pieces, lambda p: F.split(p, r"\s*-\s*"))
    spans = F.transform(ends, lambda e: F.struct(F.get(e, F.lit(0)).try_cast("int").alias("a"), F.element_at(e, -1).try_cast("int").alias("b")))
    rising = F.forall(spans, lambda s: s["a"] <= s["b"])
    return F.when(good & rising, F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["a"], s["b"])))))
