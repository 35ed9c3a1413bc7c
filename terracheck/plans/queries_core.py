"""Registered queries: sources, QA report."""

from __future__ import annotations

from pyspark.sql import functions as F

from terracheck.operators import qa
from terracheck.plans.catalog import register
from terracheck.plans.oracle_sql import OCEAN_BOX_SQL, with_assets
from terracheck.sources.assets import load_assets, normalise_nulls, point_wkt

ASSET_COLUMNS = "row_id, gppd_idnr, name, capacity_mw, latitude, longitude, country, primary_fuel, commissioning_year"


@register("scan_project", with_assets(f"SELECT {ASSET_COLUMNS} FROM assets"))
def q_scan_project(spark, sf):
    return load_assets(spark, sf)


@register(
    "normalise_nulls",
    with_assets(
        """SELECT row_id, gppd_idnr, name,
  CASE WHEN isnan(capacity_mw) THEN NULL ELSE capacity_mw END AS capacity_mw,
  CASE WHEN isnan(latitude) THEN NULL ELSE latitude END AS latitude,
  CASE WHEN isnan(longitude) THEN NULL ELSE longitude END AS longitude,
  country, primary_fuel, commissioning_year FROM assets"""
    ),
)
def q_normalise_nulls(spark, sf):
    return normalise_nulls(load_assets(spark, sf))


_QA_SQL = f"""
, dup AS (SELECT gppd_idnr, COUNT(*) AS id_count FROM assets WHERE gppd_idnr IS NOT NULL
          GROUP BY gppd_idnr HAVING COUNT(*) > 1),
j AS (SELECT a.*, d.id_count FROM assets a LEFT JOIN dup d ON a.gppd_idnr = d.gppd_idnr),
issues AS (
  SELECT row_id, gppd_idnr, coalesce(name, '') AS plant_name, 'OCEAN_COORDS' AS issue_type,
         concat('lat=', CAST(latitude AS VARCHAR), ', lon=', CAST(longitude AS VARCHAR)) AS detail, capacity_mw
  FROM j WHERE {OCEAN_BOX_SQL}
  UNION ALL
  SELECT row_id, gppd_idnr, coalesce(name, ''), 'DUPLICATE_ID', concat('appears ', CAST(id_count AS VARCHAR), 'x'), capacity_mw
  FROM j WHERE id_count IS NOT NULL
  UNION ALL
  SELECT row_id, gppd_idnr, coalesce(name, ''), 'MISSING_CAPACITY', 'capacity_mw is NaN', capacity_mw
  FROM j WHERE capacity_mw IS NULL)
"""


@register("qa_report", with_assets(_QA_SQL + "SELECT * FROM issues"))
def q_qa_report(spark, sf):
    return qa.detect_qa_errors(load_assets(spark, sf))


@register("qa_ocean", with_assets(_QA_SQL + "SELECT * FROM issues WHERE issue_type = 'OCEAN_COORDS'"))
def q_qa_ocean(spark, sf):
    return qa.qa_issue_type(load_assets(spark, sf), qa.OCEAN)


@register("qa_duplicates", with_assets(_QA_SQL + "SELECT * FROM issues WHERE issue_type = 'DUPLICATE_ID'"))
def q_qa_duplicates(spark, sf):
    return qa.qa_issue_type(load_assets(spark, sf), qa.DUPLICATE)


@register("qa_missing", with_assets(_QA_SQL + "SELECT * FROM issues WHERE issue_type = 'MISSING_CAPACITY'"))
def q_qa_missing(spark, sf):
    return qa.qa_issue_type(load_assets(spark, sf), qa.MISSING)


@register(
    "qa_issue_counts",
    with_assets(
        _QA_SQL
        + "SELECT issue_type, COUNT(*) AS n_rows, COUNT(DISTINCT gppd_idnr) AS n_ids FROM issues GROUP BY issue_type"
    ),
)
def q_qa_issue_counts(spark, sf):
    return qa.qa_issue_counts(qa.detect_qa_errors(load_assets(spark, sf)))


@register(
    "ocean_bbox",
    with_assets(f"SELECT row_id, latitude, longitude FROM assets WHERE {OCEAN_BOX_SQL}"),
)
def q_ocean_bbox(spark, sf):
    a = qa.with_ocean_flag(load_assets(spark, sf), mode="bbox")
    return a.where(F.col("in_ocean")).select("row_id", "latitude", "longitude")


@register(
    "duplicate_ids",
    with_assets(
        """, dup AS (SELECT gppd_idnr, COUNT(*) AS id_count FROM assets WHERE gppd_idnr IS NOT NULL
          GROUP BY gppd_idnr HAVING COUNT(*) > 1)
SELECT a.row_id, a.gppd_idnr, d.id_count FROM assets a JOIN dup d ON a.gppd_idnr = d.gppd_idnr"""
    ),
)
def q_duplicate_ids(spark, sf):
    return qa.duplicate_ids(load_assets(spark, sf)).select("row_id", "gppd_idnr", "id_count")


@register(
    "point_wkt",
    with_assets(
        "SELECT row_id, longitude AS x, latitude AS y, "
        "CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN "
        "'POINT (' || printf('%.4f', longitude) || ' ' || printf('%.4f', latitude) || ')' END AS wkt FROM assets"
    ),
)
def q_point_wkt(spark, sf):
    p = point_wkt(load_assets(spark, sf))
    return p.select("row_id", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"), "wkt")
