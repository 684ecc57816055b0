"""Scans, filters, joins, sorts and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import display, text
from ..operators import browse, dedup, joins, progress, windows
from .registry import query

AS_OF = "TIMESTAMP '2024-01-30 18:30:00'"
SPOT = browse.Table(("p_partkey", "p_name", "p_brand", "p_type", "p_size", "no_such_column"), ("p_name", "p_brand", "p_type"))


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def scan_project(t):
    return browse.projected(t.part, SPOT)


@query("SELECT n_nationkey, n_name AS name_en FROM nation")
def lang_project(t):
    both = t.nation.selectExpr("n_nationkey", "n_name AS name_en", "lower(n_name) AS name_hi")
    return browse.projected(both, browse.Table(("n_nationkey", "name_hi", "name_en")), "en")


@query("SELECT lang, count(*) AS n FROM documents WHERE text ILIKE '%the%of%' OR source ILIKE '%the%of%' OR lang ILIKE '%the%of%' GROUP BY lang")
def search_ilike(t):
    return browse.found(t.documents, browse.Table((), ("text", "source", "lang")), "  the%of ").groupBy("lang").agg(F.count("*").alias("n"))


@query("SELECT doc_id, concat('docs:', source, '/', doc_id, '#', sha256(text)) AS identity FROM documents")
def content_identity(t):
    from ..sources.files import source_identity

    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    return t.documents.select("doc_id", source_identity(path, F.sha2("text", 256), F.lit("docs")).alias("identity"))


@query("SELECT p.r AS page, k.k AS row, concat('row-', p.r, '-', k.k) AS name FROM range(1, 51) p(r), range(1, 3) k(k)")
def mock_rows(t):
    from ..sources.mock import mock_records

    return mock_records(t.spark, 1, 50).select("page", "row", "name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def filter_eq(t):
    return t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'").select("o_orderkey", "o_custkey")


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_range(t):
    return t.part.where(browse.age_filter(F.col("p_size"), "10-20")).select("p_partkey", "p_size")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', 'none')")
def filter_in(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "none")).select("o_orderkey")


@query("SELECT o_orderkey, s FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS s FROM orders) WHERE s NOT IN ('F', 'P')")
def filter_notin(t):
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", status.alias("s")).where(~F.col("s").isin("F", "P"))


@query("SELECT c_custkey FROM customer WHERE CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END IS NULL")
def filter_null(t):
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("k")).where("k IS NULL").select("c_custkey")


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-14 18:30:00'")
def local_day_filter(t):
    return t.events.where(F.col("ts") >= display.local_midnight(F.lit("2024-01-15").cast("date"))).select("event_id")


@query(f"SELECT event_id FROM events WHERE event_type = 'signup' OR (event_type = 'error' AND ts + INTERVAL 1 HOUR <= {AS_OF})")
def due_retry(t):
    status = F.when(F.col("event_type") == "signup", "pending").when(F.col("event_type") == "error", "retry").otherwise("done")
    return t.events.where(progress.due(status, progress.later(F.col("ts"), 3600), F.expr(AS_OF))).select("event_id")


@query(f"SELECT event_id FROM events WHERE coalesce(CASE WHEN event_id % 3 = 0 THEN ts END, CASE WHEN event_id % 5 = 0 THEN ts END) < {AS_OF} - INTERVAL 600 SECOND OR (event_id % 3 <> 0 AND event_id % 5 <> 0)")
def stale_rows(t):
    beat, begun = (F.when(F.col("event_id") % k == 0, F.col("ts")) for k in (3, 5))
    return t.events.where(progress.stale(beat, begun, F.expr(AS_OF), 600)).select("event_id")


@query("SELECT p_partkey FROM part WHERE starts_with(p_brand, 'Brand#2')")
def prefix_filter(t):
    return t.part.where(F.col("p_brand").startswith("Brand#2")).select("p_partkey")


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[éèêà]')")
def regex_filter(t):
    return t.documents.where(F.col("text").rlike("[éèêà]")).select("doc_id")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND c_mktsegment = 'BUILDING'")
def join_three_way(t):
    out = t.lineitem.join(t.orders.where("o_orderstatus = 'P'"), F.col("l_orderkey") == F.col("o_orderkey"))
    return out.join(t.customer.where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_custkey")


@query("SELECT c_custkey, coalesce(n_name, c_mktsegment) AS label FROM customer LEFT JOIN nation ON n_nationkey = CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END")
def join_left_label(t):
    keyed = t.customer.withColumn("k", F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")))
    return keyed.join(t.nation, F.col("k") == F.col("n_nationkey"), "left").select("c_custkey", F.coalesce("n_name", "c_mktsegment").alias("label"))


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_totalprice < 20000)")
def join_anti(t):
    done = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return joins.without_or_due(t.customer.select("c_custkey"), done, "c_custkey", (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 20000))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def join_semi(t):
    return t.customer.join(t.orders.where("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT n_nationkey, CASE WHEN count(r_name) = 1 THEN min(r_name) END AS r_name FROM (SELECT n_nationkey, concat(n_name, ' ', CASE WHEN n_nationkey % 5 = 0 THEN 'ASIA EUROPE' WHEN n_nationkey % 2 = 0 THEN 'in ASIA' ELSE '' END) AS note FROM nation) LEFT JOIN region ON contains(note, r_name) GROUP BY n_nationkey")
def join_contains(t):
    note = F.when(F.col("n_nationkey") % 5 == 0, "ASIA EUROPE").when(F.col("n_nationkey") % 2 == 0, "in ASIA").otherwise("")
    return joins.containing_one(t.nation.select("n_nationkey", F.concat("n_name", F.lit(" "), note).alias("note")), "note", t.region, "r_name").select("n_nationkey", "r_name")


@query("SELECT e.event_id, s.event_id AS span_id FROM events e JOIN (SELECT event_id, user_id, ts AS a, ts + INTERVAL 6 HOUR AS b FROM events WHERE event_type = 'signup') s ON e.user_id = s.user_id AND e.ts BETWEEN s.a AND s.b WHERE e.event_type = 'click'")
def join_range(t):
    at = t.events.withColumn("s", F.unix_micros("ts"))
    spans = at.where("event_type = 'signup'").select(F.col("event_id").alias("span_id"), "user_id", F.col("s").alias("a"), (F.col("s") + 21_600_000_000).alias("b"))
    points = at.where("event_type = 'click'").select("event_id", "user_id", "s")
    return joins.points_in_spans(points, spans, "s", "a", "b", 21_600_000_000, ["user_id"]).select("event_id", "span_id")


_COPY = "SELECT l_orderkey AS k, min(l_linenumber) AS a, max(l_suppkey) AS b FROM lineitem GROUP BY 1"


@query(f"""
WITH o AS ({_COPY}), n AS (SELECT k, a, CASE WHEN k % 11 = 0 THEN b + 1 ELSE b END AS b FROM o WHERE k % 13 <> 0 UNION ALL SELECT -k - 1, a, b FROM o WHERE k % 17 = 0)
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'only_new' WHEN n.k IS NULL THEN 'only_old' ELSE 'both' END AS side,
       CASE WHEN o.k IS NOT NULL AND n.k IS NOT NULL AND o.b IS DISTINCT FROM n.b THEN 'b' ELSE '' END AS changed
FROM o FULL JOIN n ON o.k = n.k""")
def diff_full_outer(t):
    old, new = _copies(t)
    return joins.difference(old, new, ["k"], ["a", "b"]).select("k", "side", F.array_join("changed", ",").alias("changed"))


def _copies(t):
    old = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_linenumber").alias("a"), F.max("l_suppkey").alias("b"))
    new = old.where("k % 13 <> 0").withColumn("b", F.when(F.col("k") % 11 == 0, F.col("b") + 1).otherwise(F.col("b")))
    return old, new.unionByName(old.where("k % 17 = 0").withColumn("k", -F.col("k") - 1))


@query("""
WITH l AS (SELECT row_number() OVER (ORDER BY p_partkey) AS position, p_name || p_size AS value FROM part),
r AS (SELECT row_number() OVER (ORDER BY CASE WHEN p_partkey % 9 = 0 THEN p_partkey + 3.5 ELSE p_partkey END, p_partkey) AS at, CASE WHEN p_partkey % 10 = 0 THEN 'x' ELSE p_name || p_size END AS value FROM part),
m AS (SELECT l.position, l.value, min(abs(r.at - l.position)) AS off FROM l LEFT JOIN r ON l.value = r.value AND r.at BETWEEN l.position - 5 AND l.position + 5 GROUP BY 1, 2)
SELECT position, CASE WHEN off = 0 THEN 'MATCH' WHEN off > 0 THEN 'ORDER_SHIFT' ELSE 'TRUE_MISMATCH' END AS verdict FROM m""")
def align_window(t):
    value = F.concat("p_name", F.col("p_size").cast("string"))
    left = windows.numbered(t.part.select("p_partkey", value.alias("value")), "p_partkey", "p_partkey")
    moved = F.when(F.col("p_partkey") % 9 == 0, F.col("p_partkey") + 3.5).otherwise(F.col("p_partkey").cast("double"))
    right = t.part.select("p_partkey", moved.alias("m"), F.when(F.col("p_partkey") % 10 == 0, "x").otherwise(value).alias("value"))
    return joins.aligned(left, windows.numbered(right, "m", "p_partkey"), "position", "value").select(F.col("position").cast("long").alias("position"), "verdict")


@query("SELECT p_partkey, u.s AS supplier FROM part LEFT JOIN (SELECT p_brand AS b, p_type AS ty, p_size AS z, min(p_partkey) AS s FROM part GROUP BY 1, 2, 3 HAVING count(*) = 1) u ON p_brand = b AND p_type = ty AND p_size = z")
def lookup_unique(t):
    catalogue = t.part.withColumn("supplier", F.col("p_partkey"))
    return joins.unique_lookup(t.part, catalogue, ["p_brand", "p_type", "p_size"], ["supplier"]).select("p_partkey", "supplier")


@query("SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1")
def lookup_validate(t):
    return t.part.groupBy("p_brand", "p_type", "p_size").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT k, row_number() OVER (ORDER BY v ASC NULLS LAST, k) AS place FROM (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS v FROM part)")
def sort_nulls(t):
    rows = t.part.select(F.col("p_partkey").alias("k"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_size")).alias("v"))
    return windows.places(rows, "v", "k").select("k", "place")


@query("SELECT p_partkey, p_name, (SELECT greatest(1, ceil(count(*) / 100.0))::BIGINT FROM part) AS pages, 3 < (SELECT ceil(count(*) / 100.0) FROM part) AS has_more FROM part ORDER BY p_size NULLS LAST, p_partkey LIMIT 100 OFFSET 200")
def page_rows(t):
    out = browse.page(t.part.select("p_partkey", "p_name", "p_size"), [F.col("p_size").asc_nulls_last(), F.col("p_partkey")], 3)
    return out.select("p_partkey", "p_name", F.col("pages").cast("long").alias("pages"), "has_more")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT (SELECT greatest(0, least(500, count(*) // 5 * 3 - count(*) FILTER (o_orderstatus = 'O')))::BIGINT FROM orders)")
def bounded_claim(t):
    every, inflight = t.orders.agg(F.count("*"), F.count_if(F.col("o_orderstatus") == "O")).first()
    room = max(0, min(500, every // 5 * 3 - inflight))
    return t.orders.where("o_orderstatus = 'P'").orderBy("o_orderdate", "o_orderkey").limit(room).select("o_orderkey")


@query("""
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P')
SELECT 'union' AS op, k FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'except', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'intersect', k FROM (SELECT k FROM a INTERSECT SELECT k FROM b)""")
def set_ops(t):
    a, b = (t.orders.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in "FP")
    parts = (("union", a.union(b).distinct()), ("except", a.subtract(b)), ("intersect", a.intersect(b)))
    out = None
    for name, df in parts:
        df = df.select(F.lit(name).alias("op"), "k")
        out = df if out is None else out.unionByName(df)
    return out


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_keys(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R')")
def append_new(t):
    key = ["l_orderkey", "l_linenumber"]
    return dedup.new_rows(t.lineitem, t.lineitem.where("l_returnflag = 'R'"), key, [F.col("l_partkey"), F.col("l_suppkey")]).select(*key)


@query("SELECT doc_id FROM documents WHERE regexp_matches(text, '[äöüß]')")
def backfill_needed(t):
    return t.documents.where(F.coalesce(F.col("text").rlike("[äöüß]"), F.lit(False))).select("doc_id")


@query("SELECT doc_id, CASE WHEN length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) > 80 THEN concat(substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 80), '…') ELSE trim(regexp_replace(text, '\\s+', ' ', 'g')) END AS cell FROM documents")
def display_cells(t):
    return t.documents.select("doc_id", text.cut(F.col("text")).alias("cell"))
