"""Layout gates, card boxes and card lines of pages of words that are made from the rows of lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import placed
from .registry import query

# Each row of an order is a card of the order's page: an ID and four words, a little off their places; some pages have one column only.
_CARDS = """SELECT l_orderkey AS page, 40.0 + (l_linenumber - 1) % (CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 3 END) * 190.0 + l_partkey % 5 AS x,
  60.0 + floor((l_linenumber - 1) / (CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 3 END)) * 90.0 + l_suppkey % 3 AS y,
  lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS k, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS r, l_linestatus AS s FROM lineitem"""
_PLACES = [
    ("x", "y", "x + 70", "y + 10", "CASE WHEN p % 11 = 0 THEN 'x' ELSE ' abc' END || k || '.'"), ("x + 5", "y + 20 + q % 4", "x + 35", "y + 30 + q % 4", "'q' || q"),
    ("x + 60", "y + 22", "x + 90", "y + 32", "r"), ("x + 5", "y + 45", "x + 35", "y + 55", "s || p % 7"), ("x + 60", "y + 300", "x + 90", "y + 310", "'low'"),
]
_NAMES = ("x0", "y0", "x1", "y1", "word")
_FIRST = "SELECT page, " + ", ".join(f"{v} AS {n}" for v, n in zip(_PLACES[0], _NAMES)) + " FROM c"
_WORDS = f"""
WITH c AS ({_CARDS}),
w AS ({_FIRST}
  {chr(10).join(f"  UNION ALL SELECT page, {', '.join(p)} FROM c" for p in _PLACES[1:]).strip()})
"""
_SIZES = "SELECT DISTINCT l_orderkey AS page, CAST(600 AS DOUBLE) AS page_width, CAST(800 AS DOUBLE) AS page_height FROM lineitem"


def _pages(t):
    t.lineitem.createOrReplaceTempView("placed_lineitem")
    sql = lambda text: t.spark.sql(text.replace("FROM lineitem", "FROM placed_lineitem").replace("VARCHAR", "STRING").replace("40.0", "40D").replace("190.0", "190D").replace("60.0", "60D").replace("90.0", "90D"))
    # All words of a row are made in one pass over it, so they are together in what is shuffled.
    each = ", ".join(f"named_struct({', '.join(f"'{n}', {v}" for n, v in zip(_NAMES, p))})" for p in _PLACES)
    words = sql(f"WITH c AS ({_CARDS}) SELECT page, w.* FROM c LATERAL VIEW inline(array({each})) w AS {', '.join(_NAMES)}")
    return words, sql(_SIZES)


_IDS = f"""{_WORDS}, i AS (SELECT *, upper(trim(trim(word), '.')) AS id FROM w WHERE regexp_full_match(upper(trim(trim(word), '.')), '[A-Z]{{3}}[0-9]{{6,8}}'))"""


@query(f"""{_IDS}, h AS (
  SELECT page, CASE WHEN (x0 + x1) / 2 / 600 BETWEEN -0.009 AND 0.351 THEN 0 WHEN (x0 + x1) / 2 / 600 BETWEEN 0.3165 AND 0.6765 THEN 1 WHEN (x0 + x1) / 2 / 600 BETWEEN 0.642 AND 1.001 THEN 2 END AS c,
         len(list_filter([{', '.join(f'[{a}, {b}]' for a, b in placed.ROWS)}], lambda b: (y0 + y1) / 2 / 800 BETWEEN b[1] - 0.02 AND b[2] + 0.02)) > 0 AS r FROM i),
g AS (SELECT page, count(*) AS ids, count(*) FILTER (c IS NOT NULL AND r) AS hits, count(DISTINCT c) FILTER (r) AS columns FROM h GROUP BY 1)
SELECT p.page, coalesce(ids, 0) AS ids, coalesce(hits, 0) AS hits, coalesce(columns, 0) AS columns,
       CASE WHEN ids IS NULL THEN 'none' WHEN ids < 4 THEN 'few' WHEN hits >= 6 AND hits >= 0.6 * ids AND columns >= 2 THEN 'known' ELSE 'other' END AS kind
FROM ({_SIZES}) p LEFT JOIN g USING (page)""")
def layout_gate(t):
    words, sizes = _pages(t)
    return placed.layout_kinds(words, ["page"], sizes)


_BOXES = f"""{_IDS}, b AS (SELECT *, floor((y0 - 55) / 90) AS band FROM i),
sx AS (SELECT page, x0 - lag(x0) OVER (PARTITION BY page, band ORDER BY x0, y0, id) AS d FROM b),
px AS (SELECT page, list_sort(list(d) FILTER (d > 40)) AS ds FROM sx GROUP BY 1),
t AS (SELECT page, band, min(y0) AS top FROM b GROUP BY 1, 2), sy AS (SELECT page, top - lag(top) OVER (PARTITION BY page ORDER BY band) AS d FROM t),
py AS (SELECT page, list_sort(list(d) FILTER (d > 24)) AS ds FROM sy GROUP BY 1), n AS (SELECT page FROM b GROUP BY 1 HAVING count(*) >= 4),
x AS (SELECT page, id, x0, y0, CASE WHEN len(px.ds) > 0 THEN round_even(px.ds[len(px.ds) // 2 + 1] * 0.92, 1) ELSE round_even(greatest(160.0, 600 - x0 - 12), 1) END::DOUBLE AS width,
  CASE WHEN len(py.ds) > 0 THEN round_even(py.ds[len(py.ds) // 2 + 1] * 0.90, 1) ELSE 140 END::DOUBLE AS height FROM b JOIN n USING (page) JOIN px USING (page) JOIN py USING (page)),
boxes AS (SELECT page, id, round_even(greatest(0.0, x0 - least(40.0, width * 0.25)), 1)::DOUBLE AS "left", round_even(greatest(0.0, y0 - 6), 1)::DOUBLE AS top, width, height FROM x)"""


@query(f"{_BOXES} SELECT * FROM boxes")
def card_boxes(t):
    words, sizes = _pages(t)
    return placed.card_boxes(words, ["page"], sizes)


@query(f"""{_BOXES}, m AS (SELECT DISTINCT page, id, "left", top FROM boxes),
h AS (SELECT m.*, w.x0, w.y0, trim(w.word) AS word FROM m JOIN (SELECT DISTINCT ON (page, id, "left", top) * FROM boxes) o USING (page, id, "left", top)
  JOIN w ON w.page = m.page AND (x0 + x1) / 2 BETWEEN o."left" AND o."left" + o.width AND (y0 + y1) / 2 BETWEEN o.top AND o.top + o.height),
a AS (SELECT page, id, "left", top, list_reduce(list(DISTINCT [y0] ORDER BY [y0]), lambda f, y: CASE WHEN y[1] > f[-1] + 8 THEN list_concat(f, y) ELSE f END) AS firsts FROM h GROUP BY ALL),
l AS (SELECT page, id, "left", top, len(list_filter(firsts, lambda f: f <= y0)) AS line, string_agg(word, ' ' ORDER BY x0, y0, word) AS text FROM h JOIN a USING (page, id, "left", top) GROUP BY ALL)
SELECT page, id, "left", top, string_agg(text, '|' ORDER BY line) AS lines FROM l GROUP BY ALL""")
def placed_card_lines(t):
    words, sizes = _pages(t)
    out = placed.card_lines(words, placed.card_boxes(words, ["page"], sizes), ["page"])
    return out.withColumn("lines", F.array_join("lines", "|"))
