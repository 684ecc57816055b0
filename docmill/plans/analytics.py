"""Aggregates, windows and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, progress, windows
from .registry import query
from .relational import AS_OF


@query("SELECT count(*) AS n FROM lineitem")
def count_all(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_quantity > 40) AS large FROM lineitem")
def count_filtered(t):
    return t.lineitem.agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("l_quantity") > 40).alias("large"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def group_count(t):
    return t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END, 'none') AS label, count(*) AS n, round_even(100.0 * count(*) / sum(count(*)) OVER (), 0)::BIGINT AS share FROM customer GROUP BY 1")
def source_share(t):
    from pyspark.sql.window import Window

    label = F.coalesce(F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")), F.lit("none"))
    out = t.customer.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    return out.withColumn("share", aggregates.whole_percent(F.col("n"), F.sum("n").over(Window.partitionBy())))


@query("SELECT o_orderpriority, count(*) FILTER (l_linestatus = 'F' AND l_returnflag <> 'R') AS male, count(*) FILTER (l_linestatus = 'O' AND l_returnflag = 'A') AS female, count(*) FILTER (l_linestatus = 'O' AND l_returnflag = 'N') AS third FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def gender_bucket(t):
    f, s = F.col("l_returnflag"), F.col("l_linestatus")
    out = t.lineitem.join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority")
    return out.agg(F.count_if((s == "F") & (f != "R")).alias("male"), F.count_if((s == "O") & (f == "A")).alias("female"), F.count_if((s == "O") & (f == "N")).alias("third"))


@query("SELECT c_custkey, coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) END), 0)::BIGINT AS cents FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def sum_coalesce(t):
    cents = F.when(F.col("o_orderstatus") == "P", F.round(F.col("o_totalprice") * 100).cast("long"))
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.coalesce(F.sum(cents), F.lit(0)).alias("cents"))


@query("SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM events GROUP BY 1")
def min_max(t):
    return t.events.groupBy("user_id").agg(F.unix_micros(F.min("ts")).alias("first_us"), F.unix_micros(F.max("ts")).alias("last_us"))


@query("SELECT l_suppkey, sum(greatest(0, l_linenumber - CAST(l_quantity AS INT) % 9 + 1))::BIGINT AS pages FROM lineitem GROUP BY 1")
def span_sum(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(progress.span(F.col("l_quantity").cast("int") % 9, F.col("l_linenumber"))).alias("pages"))


_NEXT = "SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events"


def _next(t):
    from pyspark.sql.window import Window

    return t.events.withColumn("nxt", F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))


@query(f"SELECT event_type, round(avg(greatest(0, epoch_us(nxt) - epoch_us(ts))) / 1e6, 3) AS seconds FROM ({_NEXT}) WHERE nxt IS NOT NULL GROUP BY 1")
def wall_avg(t):
    us = F.greatest(F.lit(0), F.unix_micros("nxt") - F.unix_micros("ts"))
    return _next(t).where("nxt IS NOT NULL").groupBy("event_type").agg(F.round(F.avg(us) / 1e6, 3).alias("seconds"))


@query("SELECT user_id, round(sum(CAST(round(value * 100) AS BIGINT)) / 100.0 / nullif(sum(k), 0), 6) AS rate FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type = 'error') WHERE k >= 0 GROUP BY 1")
def weighted_rate(t):
    k = F.get_json_object("props", "$.k").try_cast("long")
    rows = t.events.where("event_type = 'error'").select("user_id", F.round(F.col("value") * 100).cast("long").alias("v"), k.alias("k")).where("k >= 0")
    return rows.groupBy("user_id").agg(F.round(aggregates.weighted_rate(F.col("v") / 100, F.col("k")), 6).alias("rate"))


@query(f"SELECT user_id, floor(sum(CASE WHEN event_type = 'view' THEN epoch_us(ts) - epoch_us(nxt) WHEN epoch_us(nxt) >= epoch_us(ts) THEN epoch_us(nxt) - epoch_us(ts) END) FILTER (event_type <> 'view') / 1000)::BIGINT AS ms FROM ({_NEXT}) GROUP BY 1")
def active_time(t):
    rows = _next(t)
    back = F.col("event_type") == "view"  # their spans run backwards, and don't count
    return rows.groupBy("user_id").agg(progress.active_ms(F.when(back, F.col("nxt")).otherwise(F.col("ts")), F.when(back, F.col("ts") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("nxt"))).alias("ms"))


@query("SELECT user_id, NULLIF(floor(coalesce(sum(us), 0) / 1000), 0)::BIGINT AS ms FROM (SELECT user_id, CASE WHEN epoch_us(nxt) > epoch_us(ts) THEN epoch_us(nxt) - epoch_us(ts) END AS us FROM (" + _NEXT + ")) GROUP BY 1")
def duration_repair(t):
    return _next(t).groupBy("user_id").agg(progress.active_ms(F.col("ts"), F.col("nxt")).alias("ms"))


@query("SELECT l_returnflag, list_sort(list(l_quantity))[count(*) // 2 + 1] AS mid FROM lineitem GROUP BY 1")
def upper_median(t):
    return t.lineitem.groupBy("l_returnflag").agg(aggregates.upper_median("l_quantity").alias("mid"))


@query("SELECT l_returnflag, median(l_quantity) AS mid FROM lineitem GROUP BY 1")
def median_std(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.median("l_quantity").alias("mid"))


_REASONS = "CASE WHEN l_quantity > 45 THEN 'large' END, CASE WHEN l_discount = 0 THEN 'no_discount' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END"


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest([{_REASONS}]) AS reason FROM lineitem) WHERE reason IS NOT NULL GROUP BY 1")
def reason_histogram(t):
    rows = t.lineitem.select(F.to_json(F.array_compact(F.expr(f"array({_REASONS})"))).alias("reasons"))
    return aggregates.value_counts(rows.select(F.from_json("reasons", "array<string>").alias("reasons")), "reasons", "reason")


@query("SELECT l_orderkey, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS l_linestatus FROM lineitem GROUP BY 1")
def single_value(t):
    return aggregates.single_value(t.lineitem, ["l_orderkey"], "l_linestatus")


@query("""
WITH c AS (SELECT l_orderkey, l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY 1, 2), m AS (SELECT l_orderkey, max(n) AS votes FROM c GROUP BY 1)
SELECT m.l_orderkey, CASE WHEN votes >= 2 AND count(*) FILTER (n = votes) = 1 THEN max(f) FILTER (n = votes) END AS l_returnflag, votes FROM m JOIN c ON c.l_orderkey = m.l_orderkey GROUP BY m.l_orderkey, votes""")
def majority_vote(t):
    return aggregates.majority(t.lineitem, ["l_orderkey"], "l_returnflag")


@query("""
SELECT l_orderkey, CASE WHEN count(DISTINCT l_linestatus) = 1 AND count(DISTINCT l_linenumber) >= 2 THEN min(l_linestatus) END AS l_linestatus, count(DISTINCT l_linenumber) AS pages,
  CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'conflict' WHEN count(DISTINCT l_linenumber) < 2 THEN 'too_few_pages' END AS reason FROM lineitem GROUP BY 1""")
def consensus(t):
    return aggregates.consensus(t.lineitem, ["l_orderkey"], "l_linenumber", "l_linestatus", 2)


@query("SELECT c_nationkey, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, round_even(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 0)::BIGINT AS percent FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def progress_buckets(t):
    out = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey")
    out = out.agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    return out.withColumn("percent", aggregates.whole_percent(F.col("done"), F.col("total")))


@query("""
WITH b AS (SELECT c_nationkey, o_orderstatus, row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) AS i FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_nationkey, (i - 1) // 100 + 1 AS chunk, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, round_even(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 0)::BIGINT AS percent FROM b GROUP BY 1, 2""")
def chunk_progress(t):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = progress.chunked(rows, ["c_nationkey"], [F.col("o_orderkey")], 100).withColumn("chunk", F.col("chunk").cast("long"))
    out = rows.groupBy("c_nationkey", "chunk").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    return out.withColumn("percent", aggregates.whole_percent(F.col("done"), F.col("total")))


_STATE = "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 0 THEN 'mismatched' WHEN o_orderstatus = 'F' THEN 'matched' WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'progress' ELSE 'pending' END"


@query(f"""SELECT o_custkey, CASE WHEN bool_or(s = 'mismatched') THEN 'mismatched' WHEN bool_and(s = 'matched') THEN 'matched' WHEN bool_or(s IN ('progress', 'matched')) THEN 'progress' ELSE 'pending' END AS state
FROM (SELECT o_custkey, {_STATE} AS s FROM orders) GROUP BY 1""")
def rollup_state(t):
    return aggregates.rolled_up(t.orders.select("o_custkey", F.expr(_STATE).alias("s")), ["o_custkey"], "s")


@query("SELECT p_brand, p_type, p_size, l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def group_multi(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", "p_type", "p_size", "l_returnflag", "l_linestatus", "l_linenumber").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (l_quantity > 25 AND l_returnflag = 'R') AS tp, count(*) FILTER (l_quantity > 25 AND l_returnflag <> 'R') AS fp, count(*) FILTER (l_quantity <= 25 AND l_returnflag = 'R') AS fn, count(*) FILTER (l_quantity <= 25 AND l_returnflag <> 'R') AS tn FROM lineitem")
def confusion(t):
    return t.lineitem.agg(*aggregates.confusion(F.col("l_quantity") > 25, F.col("l_returnflag") == "R"))


@query(f"""
WITH g AS (SELECT date_trunc('hour', {AS_OF} + INTERVAL 330 MINUTE) - INTERVAL 1 HOUR * i AS h FROM range(12) r(i)),
c AS (SELECT date_trunc('hour', ts + INTERVAL 330 MINUTE) AS h, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1),
x AS (SELECT strftime(g.h, '%Y-%m-%d %H:%M') AS hour, coalesce(n, 0) AS n FROM g LEFT JOIN c ON g.h = c.h)
SELECT hour, n, CASE WHEN max(n) OVER () > 0 THEN greatest(4, round_even(100.0 * n / max(n) OVER (), 0))::INT ELSE 4 END AS height FROM x""")
def hourly_velocity(t):
    out = progress.hourly(t.events.where("event_type = 'purchase'"), "ts", F.expr(AS_OF))
    return out.select(F.date_format("hour", "yyyy-MM-dd HH:mm").alias("hour"), "n", "height")


@query(f"SELECT count(*) AS n, round(coalesce(count(*) / least(12, greatest((epoch_us({AS_OF}) - min(epoch_us(ts))) / 3600000000.0, 1 / 60.0)), 0), 6) AS per_hour FROM events WHERE ts > {AS_OF} - INTERVAL 12 HOUR AND ts <= {AS_OF}")
def throughput(t):
    return progress.per_hour(t.events, "ts", F.expr(AS_OF)).select("n", F.round("per_hour", 6).alias("per_hour"))


@query("SELECT date_trunc('hour', ts)::VARCHAR AS hour, event_type, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents FROM events GROUP BY 1, 2")
def window_tumbling(t):
    out = t.events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n", "cents")


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS carried FROM events")
def fill_forward(t):
    rows = t.events.withColumn("v", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return rows.select("event_id", "user_id", windows.carried_forward("v", ["user_id"], [F.col("ts"), F.col("event_id")]).alias("carried"))


@query("""
WITH x AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN event_type END AS v FROM events),
y AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM x)
SELECT event_id, coalesce(v, CASE WHEN a = b THEN b END) AS v FROM y""")
def fill_neighbour(t):
    rows = t.events.withColumn("v", F.when(F.col("event_id") % 3 == 0, F.col("event_type")))
    return rows.select("event_id", windows.between_equal_neighbours("v", ["user_id"], [F.col("ts"), F.col("event_id")]).alias("v"))


@query("SELECT p_partkey, count(*) OVER (PARTITION BY p_brand ORDER BY p_size) AS place FROM part")
def rank_le(t):
    return t.part.select("p_partkey", windows.rank_with_ties_low("p_size", ["p_brand"]).alias("place"))


@query("""
WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), i AS (SELECT *, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM d)
SELECT l_orderkey, min(l_linenumber) AS start, max(l_linenumber) AS "end", count(*) AS length FROM i GROUP BY l_orderkey, g""")
def islands(t):
    return windows.runs(t.lineitem, ["l_orderkey"], "l_linenumber")


@query("""
WITH u AS (SELECT l_orderkey, l_linenumber - 1 AS s, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem WHERE l_linenumber > 1),
m AS (SELECT *, lag(s) OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, s) AS b FROM u)
SELECT l_orderkey, count(*) AS usable, CASE WHEN count(*) >= 2 THEN NOT bool_or(coalesce(b >= s, false)) END AS rising FROM m GROUP BY 1""")
def serial_run(t):
    rows = t.lineitem.withColumn("s", F.col("l_linenumber") - 1)
    return windows.rises(rows, ["l_orderkey"], "s", [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "s")])


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS running FROM orders")
def running_number(t):
    from ..operators.dedup import positions

    return positions(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], "running").select("o_custkey", "o_orderkey", F.col("running").cast("long").alias("running"))


@query("SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS batch_index, ceil(row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) / 50.0)::BIGINT AS chunk FROM part")
def batch_number(t):
    from ..operators.dedup import positions

    out = positions(t.part, ["p_brand"], [F.col("p_name"), F.col("p_partkey")], "batch_index")
    return out.select("p_partkey", "p_brand", F.col("batch_index").cast("long").alias("batch_index"), F.ceil(F.col("batch_index") / 50).cast("long").alias("chunk"))


@query("""WITH RECURSIVE s AS (SELECT s_nationkey, CAST(s_acctbal AS DOUBLE) AS v FROM supplier),
  c AS (SELECT s_nationkey, 0 AS cluster, min(v) AS first FROM s GROUP BY 1
    UNION ALL SELECT c.s_nationkey, c.cluster + 1, min(v) FROM c JOIN s ON s.s_nationkey = c.s_nationkey AND v - c.first > 1500 GROUP BY c.s_nationkey, c.cluster)
  SELECT c.s_nationkey, cluster, first, max(v) AS last, CAST(count(*) AS INTEGER) AS size
  FROM c JOIN s ON s.s_nationkey = c.s_nationkey AND v >= c.first AND v - c.first <= 1500 GROUP BY 1, 2, 3""")
def cluster_rows(t):
    """Clusters of supplier balances per nation; they depend on each cluster's first value, which SQL's windows can't carry."""
    return windows.clustered(t.supplier, ["s_nationkey"], "s_acctbal", 1500.0)


@query(f"""SELECT (SELECT count(*) FROM orders) AS documents, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS completed, (SELECT count(*) FROM lineitem) AS records,
  (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS deleted, (SELECT count(DISTINCT user_id) FROM events WHERE ts > {AS_OF} - INTERVAL 1 HOUR AND ts <= {AS_OF}) AS active_users,
  (SELECT epoch_us(max(ts)) FROM events WHERE event_type = 'error') AS last_error_us""")
def dashboard_metrics(t):
    orders = t.orders.agg(F.count("*").alias("documents"), F.count_if(F.col("o_orderstatus") == "F").alias("completed"))
    items = t.lineitem.agg(F.count("*").alias("records"), F.count_if(F.col("l_returnflag") == "R").alias("deleted"))
    as_of = F.expr(AS_OF)
    recent = (F.col("ts") > progress.later(as_of, -3600)) & (F.col("ts") <= as_of)
    events = t.events.agg(F.countDistinct(F.when(recent, F.col("user_id"))).alias("active_users"), F.unix_micros(F.max(F.when(F.col("event_type") == "error", F.col("ts")))).alias("last_error_us"))
    return orders.join(F.broadcast(items), F.lit(True)).join(F.broadcast(events), F.lit(True))  # three single rows
