"""DuckDB oracle text shared by the registered queries.

``ASSETS_CTE`` is the asset derivation of FIXTURES.md section 4 written as SQL;
the Spark side builds the same table with the DataFrame API
(:func:`terracheck.sources.assets.tpch_assets`).  Each oracle appends its own
CTEs after it with ``, name AS (...)`` and ends with a SELECT.
"""

ASSETS_CTE = """
WITH base AS (
  SELECT o_orderkey AS k, o_totalprice AS cap0, CAST(c_nationkey AS BIGINT) AS n, o_orderpriority AS fuel
  FROM orders JOIN customer ON o_custkey = c_custkey
), placed AS (
  SELECT k, n, cap0, fuel, CASE WHEN k % 20 = 0 THEN (n + 7) % 25 ELSE n END AS cell FROM base
), assets AS (
  SELECT k * 2 AS row_id,
         concat('WRI', lpad(CAST(k AS VARCHAR(20)), 8, '0')) AS gppd_idnr,
         concat('Plant_', CAST(k AS VARCHAR(20))) AS name,
         CASE WHEN k % 12 = 5 THEN NULL WHEN k % 50 = 9 THEN -1 * cap0 / 100 ELSE cap0 / 100 END AS capacity_mw,
         CASE WHEN k % 333 = 1 THEN CAST(95.5 AS DOUBLE)
              WHEN k % 20 = 7 THEN -90 + ((cell - cell % 5) / 5) * 36 + 18 + CAST((k * 104729) % 100 AS DOUBLE) / 100
              ELSE -90 + ((cell - cell % 5) / 5) * 36 + 2 + CAST((k * 104729) % 1600 AS DOUBLE) / 100 END AS latitude,
         CASE WHEN k % 20 = 7 THEN -180 + (cell % 5) * 72 + 40 + CAST((k * 7919) % 2000 AS DOUBLE) / 100
              ELSE -180 + (cell % 5) * 72 + 4 + CAST((k * 7919) % 6400 AS DOUBLE) / 100 END AS longitude,
         CASE WHEN k % 501 = 2 THEN 'XX' ELSE concat('C', lpad(CAST(n AS VARCHAR(20)), 2, '0')) END AS country,
         fuel AS primary_fuel,
         CAST(CASE WHEN k % 2 = 0 THEN NULL WHEN k % 97 = 1 THEN 2150 ELSE 1900 + k % 121 END AS INTEGER) AS commissioning_year
  FROM placed
  UNION ALL
  SELECT k * 2 + 1, concat('WRI', lpad(CAST(k AS VARCHAR(20)), 8, '0')), concat('Plant_', CAST(k AS VARCHAR(20))), cap0 / 100,
         -90 + ((n - n % 5) / 5) * 36 + 2 + CAST((k * 104729) % 1600 AS DOUBLE) / 100,
         -180 + (n % 5) * 72 + 4 + CAST((k * 7919) % 6400 AS DOUBLE) / 100,
         concat('C', lpad(CAST(n AS VARCHAR(20)), 2, '0')), fuel, CAST(1900 + k % 121 AS INTEGER)
  FROM placed WHERE k % 25 = 3
)
"""

# Country polygons: each nation is a concave L inside its own grid cell.
EDGES_CTE = """
, verts(seq, dx, dy) AS (VALUES (0,4.0,2.0),(1,68.0,2.0),(2,68.0,18.0),(3,36.0,18.0),(4,36.0,34.0),(5,4.0,34.0)),
cells AS (SELECT CAST(n_nationkey AS BIGINT) AS c FROM nation),
pts AS (SELECT concat('C', lpad(CAST(c AS VARCHAR(20)), 2, '0')) AS iso_a3, seq,
   CAST(-180 + (c % 5) * 72 + dx AS DOUBLE) AS x, CAST(-90 + ((c - c % 5) / 5) * 36 + dy AS DOUBLE) AS y
   FROM cells CROSS JOIN verts),
edges AS (SELECT a.iso_a3, a.seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
   FROM pts a JOIN pts b ON a.iso_a3 = b.iso_a3 AND b.seq = (a.seq + 1) % 6)
"""

# The same polygons with a jagged coast: every edge in COAST_PIECES pieces.
COAST_PIECES = 1700
COAST_CTE = f"""
, coast_pts AS (SELECT iso_a3, seq * {COAST_PIECES} + k AS seq,
   x1 + (x2 - x1) * k / {COAST_PIECES} + CASE WHEN y1 = y2 THEN 0.0 ELSE off END AS x,
   y1 + (y2 - y1) * k / {COAST_PIECES} + CASE WHEN y1 = y2 THEN off ELSE 0.0 END AS y
   FROM (SELECT *, CASE WHEN k = 0 THEN 0.0::DOUBLE ELSE CAST(((seq + 1) * k * 7919) % 101 - 50 AS DOUBLE) / 250 END AS off
         FROM edges, (SELECT unnest(range({COAST_PIECES})) AS k))),
coast AS (SELECT iso_a3, seq, x AS x1, y AS y1,
   coalesce(lead(x) OVER r, first(x) OVER r) AS x2, coalesce(lead(y) OVER r, first(y) OVER r) AS y2
   FROM coast_pts WINDOW r AS (PARTITION BY iso_a3 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
"""

OCEAN_BOX_SQL = """((latitude BETWEEN -10 AND 10 AND longitude BETWEEN -170 AND -120)
   OR (latitude BETWEEN 5 AND 20 AND longitude BETWEEN -40 AND -20)
   OR (latitude BETWEEN -30 AND -10 AND longitude BETWEEN 60 AND 90))"""


def with_assets(tail: str) -> str:
    return ASSETS_CTE + tail


def with_edges(tail: str) -> str:
    return ASSETS_CTE + EDGES_CTE + tail


def with_coast(tail: str) -> str:
    return ASSETS_CTE + EDGES_CTE + COAST_CTE + tail
