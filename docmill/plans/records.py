"""File names, agreed readings, changes to tables and cells, over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import scratch
from ..functions import display, geo, names, rolls, scoring, text
from ..operators import browse, changes, header_fill, progress
from ..sources import files
from .registry import query

_FILE = "CASE WHEN o_orderkey % 3 <> 0 THEN concat('2026-EROLLGEN-S', 10 + o_orderkey % 20, '-', o_custkey % 400, '-SIR-FinalRoll-Revision', o_orderkey % 4, '-HIN-', o_orderkey % 500 + 1, '-WI.pdf') ELSE concat('scan-', o_orderkey, '.pdf') END"


@query("SELECT * FROM (VALUES (0, 'p_partkey', 'common', true, false, false), (1, 'p_name_hi', 'hi', false, false, true), (2, 'p_name_en', 'en', false, true, false), (3, 'p_sur_name_en', 'en', true, false, false), (4, 'p_size', 'common', false, true, false)) v(place, name, language, extra, checked, hidden)")
def export_choices(t):
    offered = browse.export_choices(("p_partkey", "p_name_hi", "p_name_en", "p_sur_name_en", "p_size"), "en", ("p_partkey",))
    return t.spark.createDataFrame([(i, *c) for i, c in enumerate(offered)], "place int, name string, language string, extra boolean, checked boolean, hidden boolean")


@query("SELECT p_partkey FROM part WHERE p_name ILIKE '%a%e%' OR p_type ILIKE '%a%e%'")
def name_filter(t):
    return browse.named(t.part, ("p_name", "p_type"), " a%e ").select("p_partkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN concat('S', 10 + o_orderkey % 20) END AS state, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 400 END::INT AS ac, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 4 END::INT AS revision, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 500 + 1 END::INT AS part FROM orders")
def file_name_parts(t):
    return t.orders.select("o_orderkey", rolls.file_name_parts(F.expr(_FILE)).alias("p")).select("o_orderkey", "p.state", "p.ac", "p.revision", "p.part")


_COVER = "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 1000 + o_orderkey % 500 ELSE o_orderkey % 500 + 1 END"


@query(f"""WITH x AS (SELECT o_orderkey, {_COVER} AS c, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 500 + 1 END AS f FROM orders)
SELECT o_orderkey, coalesce(f, c)::INT AS part_number, CASE WHEN f IS NOT NULL AND f IS DISTINCT FROM c THEN 'filename' ELSE 'cover' END AS source, CASE WHEN f IS NOT NULL AND f IS DISTINCT FROM c THEN c END::INT AS on_cover FROM x""")
def part_reconcile(t):
    return t.orders.select("o_orderkey", rolls.part_number(F.expr(_COVER).cast("int"), F.expr(_FILE)).alias("p")).select("o_orderkey", "p.part_number", "p.source", "p.on_cover")


@query("SELECT c_custkey, concat(translate(c_mktsegment, 'ABE', 'अभए'), chr(2306)) AS folded FROM customer")
def lookalike_fold(t):
    read = F.concat(F.translate("c_mktsegment", "ABE", "АБЕ"), F.lit("॑"))
    return t.customer.select("c_custkey", text.fold_stress(text.fold_lookalikes(read)).alias("folded"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 AND l_quantity BETWEEN 18 AND 120 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS age FROM lineitem")
def agreed_ages(t):
    q = F.col("l_quantity").cast("int")
    reads = F.array(q.cast("string"), F.concat(F.lit(" "), F.when(F.col("l_linenumber") % 2 == 0, q).otherwise(q + 1).cast("string")), F.lit(None).cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", rolls.agreed_age(reads).alias("age"))


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 9 OR p_size = 33 THEN p_size::VARCHAR WHEN p_size % 10 BETWEEN 1 AND 9 THEN (p_size % 10)::VARCHAR ELSE '' END AS code FROM part")
def section_codes(t):
    known = F.array(*[F.lit(str(k)) for k in (*range(1, 10), 33)])
    return t.part.select("p_partkey", rolls.section_code(F.array(F.col("p_size").cast("string")), known).alias("code"))


@query("""WITH x AS (SELECT p_partkey, p_size::VARCHAR AS a, (p_size + p_partkey % 2)::VARCHAR AS b, (p_partkey % 100)::VARCHAR AS c FROM part)
SELECT p_partkey, CASE WHEN a IN (b, c) THEN a WHEN b = c THEN b WHEN length(b) = length(a) THEN b WHEN length(c) = length(a) THEN c END AS vote FROM x""")
def number_votes(t):
    a, b, c = (x.cast("string") for x in (F.col("p_size"), F.col("p_size") + F.col("p_partkey") % 2, F.col("p_partkey") % 100))
    return t.part.select("p_partkey", rolls.number_vote(a, F.array(b, c)).alias("vote"))


@query("""WITH e AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'), n AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT (SELECT count(*) FROM lineitem) AS expected, count(*) AS written, (SELECT count(*) FROM lineitem) - count(*) AS skipped FROM n ANTI JOIN e USING (l_orderkey, l_linenumber)""")
def insert_counts(t):
    return changes.insert_counts(t.lineitem, t.lineitem.where("l_returnflag = 'R'"), ["l_orderkey", "l_linenumber"], [F.col("l_partkey"), F.col("l_suppkey")])


@query("SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal < 0")
def update_by_keys(t):
    cut = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), F.lit("X").alias("o_orderstatus"))
    return changes.updated(t.orders, cut, ["o_custkey"], ["o_orderstatus"]).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN c_custkey IS NULL THEN o_totalprice ELSE 0 END AS o_totalprice FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal < 0 AND o_orderstatus <> 'F'")
def rewrite_changed(t):
    """Orders by status, where prices of some customers' orders change; partitions without such orders keep their files."""
    path = scratch.new_path(t.spark, "orders")
    t.orders.write.partitionBy("o_orderstatus").parquet(path)
    cut = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    changed = t.orders.where("o_orderstatus <> 'F'").join(cut, "o_custkey").select("o_orderkey", F.lit(0.0).alias("o_totalprice"))
    changes.rewrite_changed(t.spark, path, changed, ["o_orderkey"], ["o_totalprice"], "o_orderstatus")
    return t.spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""WITH p AS (SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS refused FROM customer WHERE c_nationkey < 5)
SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM p WHERE NOT refused)""")
def delete_children(t):
    chosen = changes.deletable(t.customer.where("c_nationkey < 5"), t.orders, "c_custkey", "o_custkey", F.col("o_orderstatus") == "P")
    return changes.without(t.orders, chosen.where("NOT refused"), "c_custkey", "o_custkey").select("o_orderkey")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'Could not read the PDF' WHEN event_type = 'click' THEN 'Started a batch of pages' ELSE concat(upper(event_type[1]), event_type[2:]) END AS word FROM events")
def code_words(t):
    code = F.when(F.col("event_type") == "error", "EXTRACTION_FAILED").when(F.col("event_type") == "click", "UNIT_STARTED").otherwise(F.upper("event_type"))
    return t.events.select("event_id", display.code_word(code, display.ERRORS | display.EVENTS).alias("word"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS lenient, p_partkey % 5 = 0 AND p_partkey % 2 = 0 AS bad, CASE WHEN p_partkey % 5 <> 0 THEN p_size::VARCHAR WHEN p_partkey % 2 = 0 THEN 'x' || p_size END AS trimmed FROM part")
def whole_numbers(t):
    size = F.col("p_size").cast("string")
    read = F.when(F.col("p_partkey") % 5 != 0, F.concat(F.lit(" "), size, F.lit(" "))).when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("x"), size)).otherwise("  ")
    return t.part.select("p_partkey", text.lenient_int(read).alias("lenient"), text.strict_int(read)["bad"].alias("bad"), text.blank_to_null(read).alias("trimmed"))


@query("SELECT p_partkey, concat(replace(p_name, ' ', '_'), '.pdf') AS file_name, concat_ws(' ', p_brand, CASE WHEN p_partkey % 2 = 0 THEN p_type END) AS joined, p_size = 7 AS labelled FROM part")
def file_names_and_labels(t):
    name = F.concat(F.lit(" ."), F.replace("p_name", F.lit(" "), F.lit("/")), F.lit(".pdf. "))
    have = F.concat(F.col("p_size").cast("string"), F.lit(" - North"))
    return t.part.select(
        "p_partkey", text.safe_file_name(name).alias("file_name"), names.join(F.col("p_brand"), F.lit("  "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type"))).alias("joined"),
        text.label_matches(have, F.lit("7")).alias("labelled"),
    )


@query("SELECT n_nationkey, n_name AS state_name, lpad(n_nationkey::VARCHAR, 2, '0') AS code FROM nation WHERE n_nationkey % 4 <> 1 AND n_nationkey % 7 <> 3")
def active_states(t):
    code = F.when(F.col("n_nationkey") % 7 == 3, "X1").otherwise(F.concat(F.lit("S"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")))
    active = F.when(F.col("n_nationkey") % 4 == 1, "N").when(F.col("n_nationkey") % 4 == 2, "Y")
    rows = t.nation.select(code.alias("state_code"), F.col("n_name").alias("state_name"), active.alias("is_active"))
    return files.active_states(rows).select(F.col("code").cast("int").alias("n_nationkey"), "state_name", "code")


_SECTIONS = "SELECT l_orderkey AS d, l_linenumber AS p, l_partkey AS k, CASE WHEN l_linenumber % 3 <> 2 THEN (l_orderkey + l_linenumber // 4) % 3 END AS c FROM lineitem"


@query(f"""WITH r AS ({_SECTIONS}), g AS (SELECT d, p, max(c) AS hi, min(c) AS lo FROM r GROUP BY 1, 2),
w AS (SELECT d, p, last_value(hi IGNORE NULLS) OVER (PARTITION BY d ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b, first_value(lo IGNORE NULLS) OVER (PARTITION BY d ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a, min(lo) OVER (PARTITION BY d) AS mn, max(hi) OVER (PARTITION BY d) AS mx FROM g)
SELECT r.d, r.p, r.k, coalesce(c, CASE WHEN a = b THEN b END, CASE WHEN mn = mx THEN mn END)::BIGINT AS c, CASE WHEN c IS NOT NULL THEN NULL WHEN a = b THEN 'neighbours' WHEN mn = mx THEN 'only_code' END AS origin FROM r JOIN w USING (d, p)""")
def header_sections(t):
    rows = t.lineitem.selectExpr("l_orderkey AS d", "l_linenumber AS p", "l_partkey AS k", "CASE WHEN l_linenumber % 3 <> 2 THEN (l_orderkey + l_linenumber div 4) % 3 END AS c").withColumn("name", F.lit("x"))
    return header_fill.filled_sections(rows, "d", "p", "c", "name", "परिवर्धन").select("d", "p", "k", F.col("c").cast("long").alias("c"), "origin")


@query("SELECT event_id, CASE WHEN event_type <> 'view' AND event_id % 60 <= 30 AND event_id % 9 BETWEEN 3 AND 6 THEN event_id % 40 ELSE 0 END AS cards FROM events")
def live_counters(t):
    page = (F.col("event_id") % 9).cast("int")
    return t.events.select("event_id", progress.live_cards(page, F.lit(3), F.lit(6), F.col("event_type") == "view", F.col("event_id") % 60, F.col("event_id") % 40).cast("long").alias("cards"))


@query("SELECT c_custkey, abs(c_acctbal) < 0.002 AND abs(c_custkey % 3) < 0.002 AS near, (c_nationkey IS NOT NULL)::INT + (c_acctbal > 0)::INT + (c_mktsegment = 'BUILDING')::INT AS score FROM customer")
def location_gates(t):
    near = geo.near_point(F.col("c_acctbal"), F.col("c_custkey") % 3, 0.0, 0.0)
    return t.customer.select("c_custkey", near.alias("near"), geo.location_score(F.col("c_nationkey").isNotNull(), F.col("c_acctbal") > 0, F.col("c_mktsegment") == "BUILDING").alias("score"))


@query("SELECT a.s AS first, b.s AS second, a.s <> '' AND b.s <> '' AND (a.s = b.s OR (length(a.s) > 1 OR length(b.s) > 1) AND levenshtein(a.s, b.s) <= 1) AS same FROM (SELECT DISTINCT CASE WHEN p_size % 10 = 0 THEN '' ELSE (p_size * 7)::VARCHAR END AS s FROM part) a, (SELECT DISTINCT p_size::VARCHAR AS s FROM part) b")
def same_numbers(t):
    one = t.part.select(F.when(F.col("p_size") % 10 == 0, "").otherwise((F.col("p_size") * 7).cast("string")).alias("first")).distinct()
    two = t.part.select(F.col("p_size").cast("string").alias("second")).distinct()
    # Each side has one row per size, 50 at most.
    return one.join(F.broadcast(two), F.lit(True)).select("first", "second", scoring.same_number(F.col("first"), F.col("second")).alias("same"))
