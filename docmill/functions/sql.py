"""The column functions of this package under names for SQL.

``register`` creates a temporary SQL function for each, whose body is what
Catalyst says of the column expression, so SQL and DataFrames share one definition.
Calls are expanded into the query: the optimizer sees through them, and no Python runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import display, geo, names, scoring, text

#: Name: (parameters, body).
FUNCTIONS: dict[str, tuple[str, Callable[..., Column]]] = {
    "trim_or_null": ("value STRING", text.blank_to_null), "collapse_space": ("value STRING", text.collapse), "fold_digits": ("value STRING", text.fold_digits),
    "fold_lookalikes": ("value STRING", text.fold_lookalikes), "fold_stress": ("value STRING", text.fold_stress), "lenient_int": ("value STRING", text.lenient_int),
    "is_bad_int": ("value STRING", lambda v: text.blank_to_null(v).isNotNull() & text.lenient_int(v).isNull()),
    "has_devanagari": ("value STRING", text.has_devanagari), "cut_80": ("value STRING", text.cut), "squash": ("value STRING", text.squash), "label_key": ("value STRING", text.label),
    "edits_up_to_4": ("a STRING, b STRING", lambda a, b: text.distance_within(a, b, 4)), "label_matches": ("have STRING, want STRING", text.label_matches), "safe_file_name": ("value STRING", text.safe_file_name),
    "gender_bucket": ("value STRING", names.gender_bucket), "relation_key": ("value STRING", names.relation_key), "state_word": ("state STRING", display.state_word),
    "error_word": ("code STRING", lambda c: display.code_word(c, display.ERRORS)), "event_word": ("code STRING", lambda c: display.code_word(c, display.EVENTS)), "duration_words": ("ms BIGINT", display.duration), "file_size": ("size BIGINT", display.file_size),
    "local_time": ("ts TIMESTAMP", display.local_time), "backoff_seconds": ("attempt INT", lambda a: display.backoff(a, 30.0)), "near_point": ("lat DOUBLE, lon DOUBLE, lat0 DOUBLE, lon0 DOUBLE", geo.near_point),
    "record_hash": ("session STRING, page INT, line INT", scoring.record_hash), "repaired_id": ("value STRING", scoring.repaired_id),
}


def body(spark: SparkSession, parameters: str, make: Callable[..., Column]) -> str:
    """The expression over the parameters as SQL text; one with lambdas or grouping can't be said that way."""
    asked = [p.split()[0] for p in parameters.split(", ")]
    plan = spark.createDataFrame([], parameters).select(make(*[F.col(p) for p in asked]).alias("__body"))._jdf.queryExecution().analyzed()
    found = plan.expressions().head().child().sql()
    if "lambdafunction(" in found:
        raise ValueError("a body with a lambda has no SQL text")
    return found


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create all functions in the session, each under its name after ``prefix``, and return the names."""
    for name, (parameters, make) in FUNCTIONS.items():
        returns = spark.createDataFrame([], parameters).select(make(*[F.col(p.split()[0]) for p in parameters.split(", ")]).alias("r")).schema["r"].dataType.simpleString()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {returns} RETURN {body(spark, parameters, make)}")
    return [prefix + n for n in FUNCTIONS]
