"""Queries that are written as SQL text over registered functions, and map pins placed from landmarks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql, tables
from ..operators import georeference
from .registry import query


def _view(t, name: str) -> str:
    getattr(t, name).createOrReplaceTempView(f"docmill_{name}")
    return f"docmill_{name}"


@query("""
WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 11 <> 0), e AS (SELECT k, list_concat([k % 7 + 1], range(k % 5 + 2, k % 5 + 5)) AS pages FROM o),
u AS (SELECT k, unnest(pages) AS page, generate_subscripts(pages, 1) AS i FROM e), f AS (SELECT k, page, min(i) AS i FROM u GROUP BY 1, 2)
SELECT k AS o_orderkey, row_number() OVER (PARTITION BY k ORDER BY i)::INTEGER AS position, page::INTEGER AS page FROM f""")
def page_list_lateral(t):
    tables.register(t.spark)
    return t.spark.sql(f"""
      SELECT o_orderkey, p.position, p.page FROM (
        SELECT o_orderkey, concat_ws(',', o_orderkey % 7 + 1, concat(o_orderkey % 5 + 2, ' - ', o_orderkey % 5 + 4), if(o_orderkey % 11 = 0, '3-1', ' ')) AS pages FROM {_view(t, 'orders')}
      ), LATERAL page_list(pages) AS p""")


@query("""
SELECT p_partkey, 'name' AS label, p_name AS value FROM part UNION ALL SELECT p_partkey, 'age', p_size::VARCHAR FROM part
UNION ALL SELECT p_partkey, 'house', p_brand FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 'father', p_type FROM part WHERE p_partkey % 2 = 0""")
def card_fields_lateral(t):
    tables.register(t.spark)
    return t.spark.sql(f"""
      SELECT p_partkey, f.label, f.value FROM (
        SELECT p_partkey, array(concat('Name : ', p_name, if(p_partkey % 2 = 0, concat('  Father''s Name: ', p_type), '')), concat('Age: ', p_size, if(p_partkey % 3 = 0, concat(' | House Number: ', p_brand), '')), 'नाम: -', NULL) AS lines
        FROM {_view(t, 'part')}
      ), LATERAL card_fields(lines) AS f""")


@query("""
SELECT p_partkey, p_name || ' x' AS collapsed,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS number, p_partkey % 3 = 0 AS bad, CASE WHEN p_size % 2 = 0 THEN 'female' ELSE 'male' END AS bucket,
  CASE WHEN p_partkey BETWEEN 1 AND 1023 THEN p_partkey || ' bytes' END AS size, 30.0 * 2 ** (p_size % 5) AS wait, levenshtein(p_brand, 'Brand#23') AS edits,
  CASE WHEN p_size % 3 = 0 THEN 'Failed' ELSE 'Finished' END AS state, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS kind
FROM part""")
def sql_functions(t):
    sql.register(t.spark)
    return t.spark.sql(f"""
      SELECT p_partkey, collapse_space(concat('  ', replace(p_name, ' ', ' \t '), '  x ')) AS collapsed, lenient_int(concat(' ', if(p_partkey % 3 = 0, 'x', ''), p_size, ' ')) AS number, is_bad_int(concat(if(p_partkey % 3 = 0, 'x', ''), p_size)) AS bad,
        gender_bucket(if(p_size % 2 = 0, ' Female', 'M')) AS bucket, if(p_partkey < 1024, file_size(p_partkey), NULL) AS size, backoff_seconds(p_size % 5 + 1) AS wait,
        coalesce(edits_up_to_4(p_brand, 'Brand#23'), 99) AS edits, state_word(if(p_size % 3 = 0, 'failed', 'completed')) AS state, trim_or_null(if(p_size % 4 = 0, '  ', concat(p_type, ' '))) AS kind
      FROM {_view(t, 'part')}""")


_LANDMARKS = """SELECT o_custkey AS map, (o_orderkey * 7919) % 1009 AS x, (o_orderkey * 104729) % 797 AS y, o_orderkey % 9 = 4 AS wrong, o_orderkey AS k FROM orders"""


@query(f"""
WITH c AS ({_LANDMARKS}), g AS (SELECT map, count(*) AS controls, count(*) FILTER (NOT wrong) AS good, avg(x) + 0.1234 AS px, avg(y) AS py FROM c GROUP BY 1)
SELECT map, CASE WHEN map % 7 = 3 THEN 'red_pin_not_detected' WHEN controls < 4 THEN 'fewer_than_four_landmarks' WHEN good < 4 THEN 'landmarks_not_geometrically_consistent' WHEN map % 5 = 0 THEN 'pin_outside_landmark_coverage' END AS reason,
  controls::INTEGER AS controls, CASE WHEN map % 7 <> 3 AND map % 5 <> 0 AND good >= 4 THEN good END::INTEGER AS inliers,
  CASE WHEN map % 7 <> 3 AND map % 5 <> 0 AND good >= 4 THEN round(26 + 0.00002 * px - 0.00003 * py, 6) END AS lat,
  CASE WHEN map % 7 <> 3 AND map % 5 <> 0 AND good >= 4 THEN round(75 + 0.00003 * px + 0.00001 * py, 6) END AS lon FROM g""")
def map_pins(t):
    rows = t.orders.select(F.col("o_custkey").alias("map"), (F.col("o_orderkey") * 7919 % 1009).cast("double").alias("x"), (F.col("o_orderkey") * 104729 % 797).cast("double").alias("y"), "o_orderkey")
    # One landmark in nine is far from where it should be.
    off = F.when(F.col("o_orderkey") % 9 == 4, 1.0 + F.col("o_orderkey") % 97).otherwise(0.0)
    controls = rows.select("map", "x", "y", (26 + 0.00002 * F.col("x") - 0.00003 * F.col("y") + off).alias("lat"), (75 + 0.00003 * F.col("x") + 0.00001 * F.col("y")).alias("lon"))
    at = lambda c, off: F.when(F.col("map") % 5 == 0, -50.0).otherwise(F.avg(c) + off)
    pins = rows.groupBy("map").agg(at("x", 0.1234).alias("x"), at("y", 0).alias("y")).where("map % 7 <> 3")
    return georeference.placed_pins(controls, pins, "map").select("map", "reason", "controls", "inliers", "lat", "lon")
