"""Registered queries: the row rules on a damaged copy of the derived assets, so that every rule has
rows that break it. Damage goes by row id and is the same in Spark and in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS as C
from terracheck.operators import expectations as X
from terracheck.operators import features as FE
from terracheck.operators import forest as FO
from terracheck.operators import geo, validate
from terracheck.plans.catalog import register
from terracheck.plans.oracle_sql import with_assets, with_edges
from terracheck.plans.queries_ml import FIXED_NODES, FIXED_SQL
from terracheck.plans.queries_rules import ASSET_VALID_SQL, VALIDATE_SQL, country_edges
from terracheck.session import attach_row, ensure_checkpoint_dir
from terracheck.sources.assets import load_assets, normalise_nulls, scan_assets

NAN = float("nan")


def _damage(column: str, every: int, values: dict):
    """``column`` with other values where ``row_id % every`` is one of the given remainders."""
    out = F.col(column)
    for k, v in values.items():
        out = F.when(F.col("row_id") % every == k, v if hasattr(v, "isNull") else F.lit(v)).otherwise(out)
    return out


def damaged_assets(spark, sf) -> DataFrame:
    a = load_assets(spark, sf)
    return a.withColumns(
        {
            "gppd_idnr": _damage("gppd_idnr", 13, {1: None, 2: "", 3: "\t ", 4: F.concat(F.lit("  "), "gppd_idnr", F.lit("\t"))}),
            "name": _damage("name", 17, {1: None}),
            "primary_fuel": _damage("primary_fuel", 29, {1: None}),
            "capacity_mw": _damage("capacity_mw", 11, {1: NAN, 2: -4.5}),
            "latitude": _damage("latitude", 19, {1: -90.5, 2: 90.25, 3: None}),
            "longitude": _damage("longitude", 23, {1: 180.25, 2: -181.0, 3: None}),
            "country": _damage("country", 7, {1: F.concat("country", F.lit(" ")), 2: F.lower("country"), 3: "C", 4: None}),
        }
    )


DAMAGED_SQL = """, damaged AS (SELECT * REPLACE (
  CASE row_id % 13 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN chr(9) || ' ' WHEN 4 THEN '  ' || gppd_idnr || chr(9) ELSE gppd_idnr END AS gppd_idnr,
  CASE row_id % 17 WHEN 1 THEN NULL ELSE name END AS name,
  CASE row_id % 29 WHEN 1 THEN NULL ELSE primary_fuel END AS primary_fuel,
  CASE row_id % 11 WHEN 1 THEN NULL WHEN 2 THEN -4.5 ELSE capacity_mw END AS capacity_mw,
  CASE row_id % 19 WHEN 1 THEN -90.5 WHEN 2 THEN 90.25 WHEN 3 THEN NULL ELSE latitude END AS latitude,
  CASE row_id % 23 WHEN 1 THEN 180.25 WHEN 2 THEN -181.0 WHEN 3 THEN NULL ELSE longitude END AS longitude,
  CASE row_id % 7 WHEN 1 THEN country || ' ' WHEN 2 THEN lower(country) WHEN 3 THEN 'C' WHEN 4 THEN NULL ELSE country END AS country)
  FROM assets)
"""


def _on_damaged(sql: str) -> str:
    return sql.replace("assets", "damaged")


@register("damaged_validate_records", with_assets(DAMAGED_SQL + _on_damaged(VALIDATE_SQL) + "SELECT row_id, pydantic_errors = '' AS pydantic_valid, pydantic_errors FROM v"))
def q_damaged_validate_records(spark, sf):
    """V1-V9 with rows that break each of them; NaN is a missing capacity."""
    return validate.validate_records(damaged_assets(spark, sf)).select("row_id", "pydantic_valid", "pydantic_errors")


@register(
    "damaged_validate_assets",
    with_edges(DAMAGED_SQL + ", old AS (SELECT * REPLACE (coalesce(gppd_idnr, 'nan') AS gppd_idnr, coalesce(country, 'nan') AS country) FROM damaged)"
               + ASSET_VALID_SQL.replace("assets", "old") + "SELECT row_id, asset_valid, asset_errors, geometry_consistent FROM va"),
)
def q_damaged_validate_assets(spark, sf):
    """A3-A5: missing keys as the text ``nan``."""
    out = validate.validate_assets(damaged_assets(spark, sf), country_edges(spark, sf), legacy_nulls=True)
    return out.select("row_id", "asset_valid", "asset_errors", "geometry_consistent")


@register(
    "damaged_normalise",
    with_assets(DAMAGED_SQL + "SELECT row_id, upper(trim(country)) AS country_code, capacity_mw, latitude FROM damaged"),
)
def q_damaged_normalise(spark, sf):
    """S3 and A4: NaN becomes NULL, codes are stripped and upper-cased."""
    return normalise_nulls(damaged_assets(spark, sf)).select("row_id", geo.normalised_country(C).alias("country_code"), "capacity_mw", "latitude")


@register(
    "scan_text_assets",
    with_assets(
        """SELECT gppd_idnr, CASE row_id % 11 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE capacity_mw END AS capacity_mw,
  CASE row_id % 5 WHEN 1 THEN NULL ELSE commissioning_year END AS commissioning_year FROM assets"""
    ),
)
def q_scan_text_assets(spark, sf):
    """The assets written as CSV text with ``NaN``, junk, ``2013.0`` and ``2005.5`` and read back by the scan."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scan-{uuid.uuid4().hex}"
    a = load_assets(spark, sf)
    capacity = F.when(F.col("row_id") % 11 == 1, "NaN").when(F.col("row_id") % 11 == 2, "n/a").otherwise(F.col("capacity_mw").cast("string"))
    year = F.when(F.col("row_id") % 5 == 1, "2005.5").when(F.col("row_id") % 5 == 2, F.concat(F.col("commissioning_year").cast("string"), F.lit(".0"))).otherwise(F.col("commissioning_year").cast("string"))
    a.withColumns({"capacity_mw": capacity, "commissioning_year": year, "extra": F.lit("x")}).write.option("header", True).csv(path)
    return scan_assets(spark, path).select("gppd_idnr", "capacity_mw", "commissioning_year")


@register("fill_zero", with_assets(DAMAGED_SQL + "SELECT row_id, coalesce(capacity_mw, 0) AS capacity_mw, coalesce(latitude, 0) AS latitude FROM damaged"))
def q_fill_zero(spark, sf):
    """F7 after S3."""
    return FE.fill_zero(normalise_nulls(damaged_assets(spark, sf)), ["capacity_mw", "latitude"]).select("row_id", "capacity_mw", "latitude")


@register(
    "expect_missing_column",
    with_assets(
        "SELECT count(*) AS total, 'no_such_column' AS \"column\", false AS success, 'column missing' AS observed, "
        "'Column ''no_such_column'' does not exist in the dataset.' AS detail FROM assets"
    ),
)
def q_expect_missing_column(spark, sf):
    """X7, next to a check of the same suite that counts rows."""
    checks = [X.Check("unique", "no_such_column"), X.Check("row_count", lo=0, hi=10**12)]
    suite = X.run_expectation_suite(load_assets(spark, sf), checks)
    total = suite.where("check_order = 2").select(F.col("observed_value").cast("long").alias("total"))
    return attach_row(suite.where("check_order = 1").select("column", "success", "observed", "detail"), total)


@register("saved_forest_scores", FIXED_SQL)
def q_saved_forest_scores(spark, sf):
    """A forest written, read back and applied."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    offsets = spark.createDataFrame([("fixed", 256, 1000, -0.5)], "model_key string, psi int, n_train long, offset double")
    FO.ForestModel(spark.createDataFrame(FIXED_NODES), offsets, ("latitude", "longitude"), None, 0.1, 1).save(path)
    scored = FO.score_forest(load_assets(spark, sf), FO.ForestModel.load(spark, path))
    return scored.select("row_id", F.round("_raw", 6).alias("fixed_score"))
