"""Registered queries: exact-k sampling, error injection, synthetic source."""

from __future__ import annotations

from pyspark.sql import functions as F

from terracheck.functions.rand import sql_uniform
from terracheck.operators import inject
from terracheck.operators.sampling import sample_exact_n
from terracheck.plans.catalog import register
from terracheck.plans.oracle_sql import with_assets
from terracheck.sources.assets import load_assets, read_table
from terracheck.sources.synthetic import COUNTRIES, FUELS, synthetic_assets

SEED = 99


def _rank_sql(step: str, src: str, alias: str) -> str:
    return (
        f"row_number() OVER (ORDER BY md5(concat_ws('|', '{SEED}', '{step}', CAST({src}.row_id AS VARCHAR))), {src}.row_id) AS {alias}"
    )


def _zone_sql(axis: int, rank: str) -> str:
    # zones (lon range, lat range): Central Pacific, Mid-Atlantic, Indian Ocean
    zones = [((-170.0, -120.0), (-10.0, 10.0)), ((-40.0, -20.0), (5.0, 20.0)), ((60.0, 90.0), (-30.0, -10.0))]
    step = "ocean_lon" if axis == 0 else "ocean_lat"
    u = sql_uniform(SEED, step, "row_id")
    parts = []
    for i, z in enumerate(zones):
        lo, hi = z[axis]
        parts.append(f"WHEN ({rank} - 1) % 3 = {i} THEN round(CAST({lo} AS DOUBLE) + {u} * CAST({hi - lo} AS DOUBLE), 4)")
    return "CASE " + " ".join(parts) + " END"


K = """, n AS (SELECT COUNT(*) AS n FROM assets),
kk AS (SELECT CAST(floor(n * CAST(0.05 AS DOUBLE)) AS BIGINT) AS k1, CAST(floor(n * CAST(0.04 AS DOUBLE)) AS BIGINT) AS k2,
              CAST(floor((n + CAST(floor(n * CAST(0.04 AS DOUBLE)) AS BIGINT)) * CAST(0.08 AS DOUBLE)) AS BIGINT) AS k3,
              (SELECT MAX(row_id) FROM assets) AS max_id FROM n)
"""

E1 = f"""
, r1 AS (SELECT a.*, {_rank_sql('ocean', 'a', 'rk1')} FROM assets a),
e1 AS (SELECT row_id, gppd_idnr, name, capacity_mw,
         CASE WHEN rk1 <= k1 THEN {_zone_sql(1, 'rk1')} ELSE latitude END AS latitude,
         CASE WHEN rk1 <= k1 THEN {_zone_sql(0, 'rk1')} ELSE longitude END AS longitude,
         country, primary_fuel, commissioning_year, rk1 <= k1 AS ocean FROM r1, kk)
"""

E2 = f"""
, r2 AS (SELECT e1.*, {_rank_sql('duplicate', 'e1', 'rk2')} FROM e1),
e2 AS (SELECT row_id, gppd_idnr, name, capacity_mw, latitude, longitude, country, primary_fuel, commissioning_year, ocean,
              false AS dup FROM e1
       UNION ALL
       SELECT max_id + rk2, gppd_idnr, name, capacity_mw, latitude, longitude, country, primary_fuel, commissioning_year, ocean,
              true FROM r2, kk WHERE rk2 <= k2)
"""

E3 = f"""
, r3 AS (SELECT e2.*, {_rank_sql('missing', 'e2', 'rk3')} FROM e2),
e3 AS (SELECT row_id, gppd_idnr, name, CASE WHEN rk3 <= k3 THEN NULL ELSE capacity_mw END AS capacity_mw, latitude, longitude,
              country, primary_fuel, commissioning_year,
              concat_ws('|', CASE WHEN ocean THEN 'OCEAN_COORDS' END, CASE WHEN dup THEN 'DUPLICATE_ID' END,
                        CASE WHEN rk3 <= k3 THEN 'MISSING_CAPACITY' END) AS error_flags FROM r3, kk)
"""


@register(
    "inject_ocean",
    with_assets(K + E1 + "SELECT row_id, latitude, longitude, ocean AS ocean_flag FROM e1"),
)
def q_inject_ocean(spark, sf):
    a = load_assets(spark, sf)
    n = a.count()
    return inject.inject_ocean(a, int(n * 0.05), SEED).select("row_id", "latitude", "longitude", F.col("_ocean").alias("ocean_flag"))


@register(
    "inject_duplicates",
    with_assets(
        K
        + f""", r2 AS (SELECT a.*, {_rank_sql('duplicate', 'a', 'rk2')} FROM assets a)
SELECT row_id, gppd_idnr, false AS is_copy FROM assets
UNION ALL SELECT max_id + rk2, gppd_idnr, true FROM r2, kk WHERE rk2 <= k2"""
    ),
)
def q_inject_duplicates(spark, sf):
    a = load_assets(spark, sf)
    n = a.count()
    return inject.inject_duplicates(a, int(n * 0.04), SEED).select("row_id", "gppd_idnr", F.col("_dup").alias("is_copy"))


@register(
    "inject_missing",
    with_assets(
        K
        + f""", r3 AS (SELECT a.*, {_rank_sql('missing', 'a', 'rk3')} FROM assets a)
SELECT row_id, CASE WHEN rk3 <= CAST(floor(n * CAST(0.08 AS DOUBLE)) AS BIGINT) THEN NULL ELSE capacity_mw END AS capacity_mw,
       rk3 <= CAST(floor(n * CAST(0.08 AS DOUBLE)) AS BIGINT) AS missing_flag FROM r3, n"""
    ),
)
def q_inject_missing(spark, sf):
    a = load_assets(spark, sf)
    n = a.count()
    return inject.inject_missing(a, int(n * 0.08), SEED).select("row_id", "capacity_mw", F.col("_missing").alias("missing_flag"))


INJECT_SQL = K + E1 + E2 + E3


@register(
    "inject_errors",
    with_assets(INJECT_SQL + "SELECT row_id, gppd_idnr, latitude, longitude, capacity_mw, error_flags FROM e3"),
)
def q_inject_errors(spark, sf):
    d = inject.inject_errors(load_assets(spark, sf), seed=SEED)
    return d.select("row_id", "gppd_idnr", "latitude", "longitude", "capacity_mw", "error_flags")


@register(
    "sample_exact_n",
    with_assets(
        f"""SELECT row_id, sample_rank FROM (SELECT row_id, {_rank_sql('ocean', 'assets', 'sample_rank')} FROM assets)
WHERE sample_rank <= 100"""
    ),
)
def q_sample_exact_n(spark, sf):
    return sample_exact_n(load_assets(spark, sf), 100, seed=SEED, step="ocean").select("row_id", "sample_rank")


def _pick_sql(values, step):
    arr = "[" + ", ".join(f"'{v}'" for v in values) + "]"
    return f"{arr}[CAST(floor({sql_uniform(0, step, 'o_orderkey')} * {len(values)}) AS INTEGER) + 1]"


@register(
    "synthetic_assets",
    f"""SELECT o_orderkey AS row_id, concat('WRI', lpad(CAST(o_orderkey AS VARCHAR), 6, '0')) AS gppd_idnr,
  concat('Plant_', CAST(o_orderkey AS VARCHAR)) AS name,
  round(10.0 + {sql_uniform(0, 'capacity', 'o_orderkey')} * 2990.0, 1) AS capacity_mw,
  round(-60.0 + {sql_uniform(0, 'latitude', 'o_orderkey')} * 135.0, 4) AS latitude,
  round(-180.0 + {sql_uniform(0, 'longitude', 'o_orderkey')} * 360.0, 4) AS longitude,
  {_pick_sql(COUNTRIES, 'country')} AS country, {_pick_sql(FUELS, 'fuel')} AS primary_fuel,
  CAST(1950 + floor({sql_uniform(0, 'year', 'o_orderkey')} * 73) AS INTEGER) AS commissioning_year
FROM orders""",
)
def q_synthetic_assets(spark, sf):
    return synthetic_assets(read_table(spark, sf, "orders"), "o_orderkey", seed=0)
