"""Attempts, dedup, reconciliation, header fill and quality of records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, scoring
from ..operators import aggregates, attempts, dedup, quality, reconcile as rec, progress
from ..operators.normalize import normalised_records, validated
from .registry import query
from .relational import AS_OF

_CHOSEN = """SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus IN ('F', 'P')) DESC, o_orderdate DESC, o_orderkey DESC) AS k
  FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) WHERE k = 1"""


def _chosen(t):
    return attempts.authoritative_attempt(t.orders, t.lineitem, "o_custkey", "o_orderkey", "l_orderkey", F.col("o_orderstatus").isin("F", "P"), [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query(_CHOSEN)
def authoritative_attempt(t):
    return _chosen(t).select("o_custkey", "o_orderkey", "o_orderstatus")


@query(f"SELECT o_custkey, l_returnflag, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM ({_CHOSEN}) JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def scoped_records(t):
    rows = attempts.scoped_records(t.lineitem, _chosen(t), "o_orderkey", "l_orderkey", ["o_custkey"])
    return rows.groupBy("o_custkey", "l_returnflag").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(t):
    return attempts.latest_per_key(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_id", "event_type")


@query("SELECT doc_id, sha256(text) AS file_hash FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1")
def dedup_content(t):
    return dedup.keep_first(t.documents.select("doc_id", F.sha2("text", 256).alias("file_hash")), ["file_hash"], [F.col("doc_id")])


_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(f"""
WITH r AS (SELECT l_orderkey, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS n, l_partkey, {', '.join(_ORDER[1:])} FROM lineitem)
SELECT l_orderkey, n, l_partkey, l_suppkey FROM r WHERE n IS NULL UNION ALL
SELECT l_orderkey, n, l_partkey, l_suppkey FROM (SELECT * FROM r WHERE n IS NOT NULL QUALIFY row_number() OVER (PARTITION BY l_orderkey, n ORDER BY {', '.join(_ORDER)}) = 1)""")
def dedup_natural(t):
    rows = t.lineitem.withColumn("n", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber"))).select("l_orderkey", "n", *_ORDER)
    return dedup.by_natural_key(rows, ["l_orderkey", "n"], [F.col(c) for c in _ORDER]).select("l_orderkey", "n", "l_partkey", "l_suppkey")


@query("""
WITH r AS (SELECT event_id, user_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS a, CASE WHEN event_id % 2 <> 0 THEN CAST(json_extract(props, '$.k') AS VARCHAR) END AS b FROM events),
k AS (SELECT *, coalesce('1:' || a, '2:' || b) AS key FROM r)
SELECT event_id FROM k WHERE key IS NULL UNION ALL SELECT event_id FROM (SELECT * FROM k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, key ORDER BY event_id) = 1)""")
def dedup_fallback(t):
    rows = t.events.select("event_id", "user_id", F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("a"), F.when(F.col("event_id") % 2 != 0, F.get_json_object("props", "$.k")).alias("b"))
    return dedup.by_fallback_key(rows, ["user_id"], "a", "b", [F.col("event_id")]).select("event_id")


@query("""
WITH d AS (SELECT doc_id, sha256(text) AS h, doc_id % 3 = 0 AS done FROM documents)
SELECT doc_id FROM d WHERE NOT done AND EXISTS (SELECT 1 FROM d x WHERE x.done AND x.h = d.h AND x.doc_id <> d.doc_id)""")
def dedup_cancel(t):
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("h"), (F.col("doc_id") % 3 == 0).alias("done"))
    return dedup.cancelled_copies(rows, "h", "doc_id", F.col("done")).select("doc_id")


@query("""
WITH c AS (SELECT l_orderkey AS o_orderkey, count(*) FILTER (l_returnflag <> 'R') AS living, count(*) FILTER (l_returnflag <> 'R' AND l_linestatus = 'F') AS male FROM lineitem GROUP BY 1),
d AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 <> 0 THEN 1 + (CAST(round(o_totalprice * 100) AS BIGINT) % 4) END AS dl, CAST(round(o_totalprice * 100) AS BIGINT) % 3 AS dm FROM orders)
SELECT d.o_orderkey, coalesce(living, 0) AS living, coalesce(male, 0) AS male,
  concat_ws(',', CASE WHEN dl <> coalesce(living, 0) THEN 'living' END, CASE WHEN dm <> coalesce(male, 0) THEN 'male' END) AS mismatches,
  CASE WHEN o_orderstatus = 'O' THEN 'progress' WHEN living IS NULL THEN 'pending' WHEN coalesce(dl <> coalesce(living, 0), false) OR dm <> coalesce(male, 0) THEN 'mismatched' ELSE 'matched' END AS state
FROM d LEFT JOIN c ON c.o_orderkey = d.o_orderkey""")
def reconcile(t):
    price = F.round(F.col("o_totalprice") * 100).cast("long")
    declared = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, 1 + price % 4).alias("declared_living"), (price % 3).alias("declared_male"))
    counts = rec.living_counts(t.lineitem, ["l_orderkey"], F.col("l_returnflag") == "R", {"male": F.col("l_linestatus") == "F"}).withColumnRenamed("l_orderkey", "o_orderkey")
    out = rec.reconcile(t.orders.select("o_orderkey", "o_orderstatus"), declared, counts, "o_orderkey", ["living", "male"], F.col("o_orderstatus") == "O")
    return out.withColumn("mismatches", F.array_join("mismatches", ","))


@query("""
SELECT l_orderkey, coalesce(CASE WHEN count(DISTINCT v) = 1 THEN min(v) END, CASE WHEN count(v) = 0 AND l_orderkey % 2 = 0 THEN 'cover' END, CASE WHEN count(v) = 0 THEN 'file' END) AS code
FROM (SELECT l_orderkey, CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag END AS v FROM lineitem) GROUP BY 1""")
def fill_single(t):
    from ..operators.header_fill import document_code

    rows = t.lineitem.select("l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.col("l_returnflag")).alias("code"))
    fallback = t.lineitem.select("l_orderkey").distinct().select("l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, "cover").alias("cover"), F.lit("file").alias("file"))
    return document_code(rows, "l_orderkey", "code", fallback, ["cover", "file"]).select("l_orderkey", "code")


_FIELDS = ["a", "b", "c"]
_BLANKS = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE o_orderpriority END AS b, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS c FROM orders"


def _blanks(t):
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", F.when(k % 3 != 0, F.col("o_orderstatus")).alias("a"), F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("o_orderpriority")).alias("b"), F.when(k % 7 != 0, F.col("o_custkey")).alias("c"))


@query(f"""
SELECT * FROM (SELECT o_orderkey, concat_ws(',', CASE WHEN a IS NULL THEN 'a' END, CASE WHEN trim(b) = '' THEN 'b' END, CASE WHEN c IS NULL THEN 'c' END) AS missing, CASE WHEN o_orderkey % 11 = 0 THEN 'late' ELSE '' END AS reasons, o_orderkey % 13 <> 0 AS valid FROM ({_BLANKS}))
WHERE missing <> '' OR reasons <> '' OR NOT valid""")
def completeness_rows(t):
    reasons = F.when(F.col("o_orderkey") % 11 == 0, F.array(F.lit("late")))
    return quality.incomplete(_blanks(t), ["o_orderkey"], _FIELDS, reasons, F.col("o_orderkey") % 13 != 0)


@query(f"SELECT field, count(*) AS n FROM (SELECT unnest([CASE WHEN a IS NULL THEN 'a' END, CASE WHEN trim(b) = '' THEN 'b' END, CASE WHEN c IS NULL THEN 'c' END]) AS field FROM ({_BLANKS})) WHERE field IS NOT NULL GROUP BY 1")
def completeness_summary(t):
    return quality.missing_counts(_blanks(t), _FIELDS)


@query(f"SELECT o_orderkey, CASE WHEN a IS NULL AND o_orderkey % 2 = 0 THEN upper(o_priority) ELSE a END AS a FROM (SELECT b.*, o.o_orderpriority AS o_priority FROM ({_BLANKS}) b JOIN orders o USING (o_orderkey))")
def coalesce_fill(t):
    second = t.orders.select("o_orderkey", F.upper("o_orderpriority").alias("a"))
    return quality.filled(_blanks(t), second, ["o_orderkey"], ["a"], F.col("o_orderkey") % 2 == 0).select("o_orderkey", "a")


@query("SELECT l_orderkey, l_partkey, l_suppkey, k::INT AS shown, greatest(0, c - 3)::BIGINT AS more FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY " + ", ".join(["l_linenumber", *_ORDER]) + ") AS k, count(*) OVER (PARTITION BY l_orderkey) AS c FROM lineitem) WHERE k <= 3")
def preview_per_group(t):
    return quality.preview(t.lineitem, ["l_orderkey"], [F.col(c) for c in ["l_linenumber", *_ORDER]], 3).select("l_orderkey", "l_partkey", "l_suppkey", "shown", "more")


@query("SELECT CASE WHEN l_returnflag = 'R' THEN 'deleted' WHEN l_linenumber = 4 THEN 'no_id' ELSE 'extracted' END AS outcome, count(*) AS n FROM lineitem GROUP BY 1")
def row_outcome(t):
    identity = F.when(F.col("l_linenumber") == 4, F.lit("  ")).otherwise(F.col("l_partkey").cast("string"))
    return t.lineitem.select(quality.outcome(F.col("l_returnflag") == "R", identity).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n"))


@query("""
WITH x AS (SELECT o_orderkey, count(l_orderkey) AS got, 1 + o_orderkey % 6 AS want FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o_orderkey, concat_ws(',', CASE WHEN got * 1.0 / want < 0.75 THEN 'yield_very_low' WHEN got * 1.0 / want < 0.9 THEN 'yield_low' END, CASE WHEN o_orderkey % 4 = 0 THEN 'empty_header' END, CASE WHEN abs(got - want) > 1 THEN 'count_drift' END) AS flags FROM x""")
def sweep_flags(t):
    got = t.orders.join(t.lineitem.select("l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey").agg(F.count("l_orderkey").alias("got"))
    want = 1 + F.col("o_orderkey") % 6
    drift = F.when(F.abs(F.col("got") - want) > 1, 1.0).otherwise(0.0)
    return got.select("o_orderkey", F.array_join(quality.sweep_flags(F.col("got"), want, F.when(F.col("o_orderkey") % 4 == 0, 1).otherwise(0), drift), ",").alias("flags"))


@query("SELECT p_brand, p_type, count(*) AS n FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$') OR p_size <> CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT) GROUP BY 1, 2")
def audit_suspicious(t):
    number = F.regexp_extract("p_brand", r"([0-9]+)$", 1).try_cast("int")
    return t.part.where(~F.col("p_brand").rlike("^Brand#[0-9]$") | (F.col("p_size") != number)).groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))


_COPY = "SELECT l_orderkey AS k, min(l_linenumber) AS a, max(l_suppkey) AS b FROM lineitem GROUP BY 1"


@query(f"""
WITH o AS ({_COPY}), n AS (SELECT k, a, CASE WHEN k % 11 = 0 THEN b + 1 ELSE b END AS b FROM o WHERE k % 13 <> 0)
SELECT count(*) AS records, count(n.k) AS found, sum(2 - CASE WHEN o.b <> n.b THEN 1 ELSE 0 END) FILTER (n.k IS NOT NULL)::BIGINT AS fields_right, 2 * count(n.k) AS fields, count(*) FILTER (o.b = n.b) AS exact FROM o LEFT JOIN n ON o.k = n.k""")
def accuracy(t):
    from ..operators.joins import difference
    from .relational import _copies

    old, _ = _copies(t)
    new = old.where("k % 13 <> 0").withColumn("b", F.when(F.col("k") % 11 == 0, F.col("b") + 1).otherwise(F.col("b")))
    d = difference(old, new, ["k"], ["a", "b"])
    both = F.col("side") == "both"
    return d.agg(
        F.count("*").alias("records"), F.count_if(both).alias("found"), F.sum(F.when(both, 2 - F.size("changed"))).alias("fields_right"),
        (2 * F.count_if(both)).alias("fields"), F.count_if(both & (F.size("changed") == 0)).alias("exact"),
    )


@query("SELECT o_orderkey, s + (u.i - 1)::INT * 10 AS page_from, u.i::INT AS unit_number, least(s + (u.i - 1) * 10 + 9, pages)::INT AS page_to FROM (SELECT o_orderkey, 1 + o_custkey % 60 AS pages, CASE WHEN 1 + o_custkey % 60 >= 3 THEN 3 ELSE 1 END AS s FROM orders), range(1, 8) u(i) WHERE s + (u.i - 1) * 10 <= pages")
def split_units(t):
    return progress.units(t.orders.select("o_orderkey", (1 + F.col("o_custkey") % 60).cast("int").alias("pages")), "o_orderkey", "pages")


_UNIT = "CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_orderkey % 5 = 0 AND l_linestatus = 'O' THEN 'running' ELSE 'completed' END"


@query(f"""
WITH u AS (SELECT l_orderkey, {_UNIT} AS s, l_linenumber AS p, CAST(l_quantity AS BIGINT) AS r FROM lineitem)
SELECT l_orderkey, count(*) AS units, count(*) FILTER (s = 'completed') AS done, count(*) FILTER (s = 'failed') AS failed, coalesce(sum(p) FILTER (s = 'completed'), 0)::BIGINT AS pages, coalesce(sum(r) FILTER (s = 'completed'), 0)::BIGINT AS records,
  CASE WHEN count(*) FILTER (s IN ('completed', 'failed')) < count(*) THEN 'open' WHEN count(*) FILTER (s = 'failed') = 0 THEN 'completed' WHEN count(*) FILTER (s = 'completed') > 0 THEN 'partial' ELSE 'failed' END AS state FROM u GROUP BY 1""")
def finalize(t):
    return progress.finalized(t.lineitem.withColumn("s", F.expr(_UNIT)), "l_orderkey", F.col("s"), F.col("l_linenumber"), F.col("l_quantity").cast("long"))


@query(f"""
WITH u AS (SELECT l_orderkey, {_UNIT} AS s, l_linenumber AS p FROM lineitem), g AS (SELECT l_orderkey, sum(p) AS total, coalesce(sum(p) FILTER (s = 'completed'), 0) AS done FROM u GROUP BY 1)
SELECT l_orderkey, done::BIGINT AS pages_done, total::BIGINT AS pages, CASE WHEN done = total THEN 100 ELSE least(95, round_even(100.0 * done / total, 0)) END::BIGINT AS percent FROM g""")
def live_progress(t):
    done = F.coalesce(F.sum(F.when(F.expr(_UNIT) == "completed", F.col("l_linenumber"))), F.lit(0))
    out = t.lineitem.groupBy("l_orderkey").agg(done.alias("pages_done"), F.sum("l_linenumber").alias("pages"))
    share = aggregates.whole_percent(F.col("pages_done"), F.col("pages"))
    return out.withColumn("percent", F.when(F.col("pages_done") == F.col("pages"), F.lit(100).cast("long")).otherwise(F.least(F.lit(95).cast("long"), share)))


@query(f"""
SELECT event_type, count(*) AS n, count(*) FILTER (event_id % 4 = 0) AS never_started, count(*) FILTER (event_id % 4 = 0 OR ts >= {AS_OF} - INTERVAL 1200 SECOND) AS live, count(*) FILTER (o_orderstatus = 'F') AS resettable
FROM events LEFT JOIN orders ON o_orderkey = event_id GROUP BY 1""")
def queue_report(t):
    never = F.col("event_id") % 4 == 0
    live = never | ~progress.stale(F.col("ts"), F.col("ts"), F.expr(AS_OF), 1200)
    rows = t.events.join(t.orders.select("o_orderkey", "o_orderstatus"), F.col("event_id") == F.col("o_orderkey"), "left")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(never).alias("never_started"), F.count_if(live).alias("live"), F.count_if(F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))).alias("resettable"))


@query("""
WITH f AS (SELECT l_orderkey, list(least(1.0, l_discount * 10)) AS s, avg(least(1.0, l_discount * 10)) AS m, count(*) FILTER (l_discount > 0) * 1.0 / count(*) AS c FROM lineitem GROUP BY 1)
SELECT o_orderkey, round(CASE WHEN o_orderkey % 3 = 0 AND m IS NOT NULL THEN m WHEN m IS NULL AND o_orderkey % 3 = 0 THEN NULL WHEN m IS NULL THEN w ELSE (w + m) / 2 END, 6) AS confidence, round(c, 6) AS coverage
FROM (SELECT o_orderkey, (o_custkey % 101) / 100.0 AS w FROM orders) LEFT JOIN f ON l_orderkey = o_orderkey""")
def confidence_score(t):
    # The scores of an order are aggregated where they are; only three numbers of it are joined.
    scored = t.lineitem.select("l_orderkey", scoring.field_score((F.col("l_discount") * 10).cast("string")).alias("s"))
    fields = scored.groupBy("l_orderkey").agg(F.avg("s").alias("mean"), (F.count_if(F.col("s") > 0) / F.count("*")).alias("share"))
    rows = t.orders.join(fields, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    got = scoring.confidence_of(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 101), F.col("mean"), F.col("share"))
    return rows.select("o_orderkey", got.alias("g")).select("o_orderkey", F.round("g.confidence", 6).alias("confidence"), F.round("g.coverage", 6).alias("coverage"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '—' ELSE p_brand END AS first, CASE WHEN p_partkey % 4 = 3 THEN p_type || ' x' ELSE '—' END AS middle, CASE WHEN p_partkey % 4 >= 2 THEN 'Bell' || p_size ELSE '—' END AS last FROM part""")
def split_names(t):
    k = F.col("p_partkey") % 4
    last = F.concat(F.lit("Bell"), F.col("p_size").cast("string"))
    name = F.when(k == 0, "  ").when(k == 1, F.concat(F.lit(" "), F.col("p_brand"))).when(k == 2, F.concat_ws("   ", "p_brand", last)).otherwise(F.concat_ws(" ", "p_brand", "p_type", F.lit(" x"), last))
    parts = t.part.select("p_partkey", names.parts(name).alias("p"))
    return parts.select("p_partkey", *[names.cell(F.col(f"p.{c}")).alias(c) for c in ("first", "middle", "last")])


@query("""SELECT * FROM (VALUES ('ok', NULL, NULL), ('refused', 'MODEL_TIMEOUT', true), ('refused_final', 'BAD_FILE', false), ('server', 'EXTRACTION_SERVICE_UNAVAILABLE', true), ('client', 'INVALID_RESPONSE', false),
  ('range', 'INVALID_RESPONSE', false), ('version', 'INVALID_RESPONSE', false), ('no_source', 'INVALID_RESPONSE', false), ('page', 'INVALID_RESPONSE', false), ('not_json', 'INVALID_RESPONSE', false)) v(name, code, retryable)""")
def validate_envelope(t):
    from .fixtures import ENVELOPES

    rows = t.spark.createDataFrame([(k, v, 3, 4) for k, v in ENVELOPES.items()], "name string, payload string, page_from int, page_to int")
    return validated(rows, "payload", "page_from", "page_to").select("name", F.col("error.code").alias("code"), F.col("error.retryable").alias("retryable"))


@query("""SELECT * FROM (VALUES (3, 1, 'Ram Lal', 'Ram', '—', 'Lal', 0.75::DOUBLE, 30, true, ''), (3, 2, '—', '—', '—', '—', 1.0::DOUBLE, 200, false, 'age outside 0–120,confidence outside 0–1,name missing'),
  (4, 1, 'A B C D', 'A', 'B C', 'D', NULL, NULL, false, 'confidence not a number')) v(page_number, source_row_number, name_hi, voter_first_name_hi, voter_middle_name_hi, voter_sur_name_hi, confidence, age, is_valid, errors)""")
def normalize_record(t):
    from .fixtures import ENVELOPES

    rows = t.spark.createDataFrame([("d", "s", "u", ENVELOPES["ok"])], "document_id string, session_id string, unit_id string, payload string")
    out = normalised_records(rows, "payload")
    return out.select(
        "page_number", "source_row_number", "name_hi", "voter_first_name_hi", "voter_middle_name_hi", "voter_sur_name_hi", F.col("confidence").cast("double").alias("confidence"), "age", "is_valid",
        F.array_join("validation_errors", ",").alias("errors"),
    )


@query("SELECT l_orderkey, count(*) AS hits, CASE WHEN count(*) >= 4 OR bool_or(l_linenumber = 1) THEN true ELSE false END AS accepted FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1")
def page_accept(t):
    from ..operators.layout import accepted_pages

    return accepted_pages(t.lineitem.where("l_returnflag <> 'R'"), ["l_orderkey"], F.col("l_linenumber") == 1).select("l_orderkey", "hits", "accepted")


@query("""
WITH w AS (SELECT l_orderkey AS page, (l_linenumber - 1) % 3 AS c, (l_linenumber - 1) // 3 AS r FROM lineitem), g AS (SELECT page, count(*) AS hits, count(DISTINCT c) AS columns, count(DISTINCT r) AS rows FROM w GROUP BY 1)
SELECT page, hits, columns, rows, CASE WHEN hits = 1 THEN 'single' WHEN columns = 1 THEN 'column' WHEN hits >= 6 AND hits / (columns * rows) >= 0.6 THEN 'grid' ELSE 'sparse' END AS kind FROM g""")
def classify_layout(t):
    """Layout kinds of pages of invented ID boxes, which stand so far apart that each place is a cluster."""
    from ..operators.layout import layouts

    words = t.lineitem.select(F.col("l_orderkey").alias("page"), ((F.col("l_linenumber") - 1) % 3 * 190.0 + 40).alias("x"), (F.floor((F.col("l_linenumber") - 1) / 3) * 90.0 + 60).alias("y"))
    return layouts(words, ["page"])
