"""Registered queries: row rules, asset validation, polygons and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS as C
from terracheck.functions import rules as R
from terracheck.operators import geo, validate
from terracheck.plans.catalog import register
from terracheck.plans.oracle_sql import COAST_PIECES, with_assets, with_coast, with_edges
from terracheck.session import cut_lineage
from terracheck.sources.assets import load_assets, read_table
from terracheck.sources.polygons import grid_country_edges, roughened_edges


def country_edges(spark, sf):
    return grid_country_edges(read_table(spark, sf, "nation"))


def _rule_query(rule_col):
    def q(spark, sf):
        a = load_assets(spark, sf)
        return a.select("row_id", rule_col(a).alias("message")).where(F.col("message").isNotNull())

    return q


# --- DuckDB text of the same rules --------------------------------------------------
SQL_ID = """CASE WHEN gppd_idnr IS NULL THEN 'gppd_idnr: Input should be a valid string'
  WHEN regexp_matches(gppd_idnr, '^\\s*$') THEN 'gppd_idnr: Value error, gppd_idnr must not be blank.' END"""
SQL_NAME = "CASE WHEN name IS NULL THEN 'name: Input should be a valid string' END"
SQL_CAP = "CASE WHEN capacity_mw < 0 THEN 'capacity_mw: Input should be greater than or equal to 0' END"
SQL_LAT = """CASE WHEN latitude IS NULL THEN 'latitude: Input should be a valid number'
  WHEN latitude > 90 THEN 'latitude: Input should be less than or equal to 90'
  WHEN latitude < -90 THEN 'latitude: Input should be greater than or equal to -90' END"""
SQL_LON = """CASE WHEN longitude IS NULL THEN 'longitude: Input should be a valid number'
  WHEN longitude > 180 THEN 'longitude: Input should be less than or equal to 180'
  WHEN longitude < -180 THEN 'longitude: Input should be greater than or equal to -180' END"""
SQL_COUNTRY = """CASE WHEN country IS NULL THEN 'country: Input should be a valid string'
  WHEN length(country) < 3 THEN 'country: String should have at least 3 characters'
  WHEN length(country) > 3 THEN 'country: String should have at most 3 characters' END"""
SQL_FUEL = "CASE WHEN primary_fuel IS NULL THEN 'primary_fuel: Input should be a valid string' END"
SQL_YEAR = """CASE WHEN commissioning_year IS NULL THEN 'commissioning_year: Input should be a finite number'
  WHEN commissioning_year < 1900 THEN 'commissioning_year: Input should be greater than or equal to 1900'
  WHEN commissioning_year > 2100 THEN 'commissioning_year: Input should be less than or equal to 2100' END"""


def _rule_sql(expr: str) -> str:
    return with_assets(f"SELECT row_id, message FROM (SELECT row_id, {expr} AS message FROM assets) WHERE message IS NOT NULL")


register("rule_id_blank", _rule_sql(SQL_ID))(_rule_query(lambda a: R.id_rule(C.id, F.col(C.id))))
register("rule_capacity_nonneg", _rule_sql(SQL_CAP))(
    _rule_query(lambda a: R.nonneg_optional(C.capacity, R.coerce_double(F.col(C.capacity), a.schema[C.capacity].dataType)))
)
register("rule_lat_range", _rule_sql(SQL_LAT))(_rule_query(lambda a: R.bounded_number(C.lat, F.col(C.lat), -90, 90)))
register("rule_lon_range", _rule_sql(SQL_LON))(_rule_query(lambda a: R.bounded_number(C.lon, F.col(C.lon), -180, 180)))
register("rule_country_len", _rule_sql(SQL_COUNTRY))(_rule_query(lambda a: R.exact_length(C.country, F.col(C.country), 3)))
register("rule_year_range", _rule_sql(SQL_YEAR))(
    _rule_query(lambda a: R.optional_int_range(C.year, F.col(C.year), a.schema[C.year].dataType, 1900, 2100))
)


@register(
    "coerce_capacity",
    with_assets(
        """SELECT row_id, CASE WHEN isnan(TRY_CAST(CAST(capacity_mw AS VARCHAR) AS DOUBLE)) THEN NULL
       ELSE TRY_CAST(CAST(capacity_mw AS VARCHAR) AS DOUBLE) END AS capacity_coerced FROM assets"""
    ),
)
def q_coerce_capacity(spark, sf):
    # the capacity as text (as a CSV hands it over), coerced back: numeric text parses, junk is NULL
    from pyspark.sql import types as T

    a = load_assets(spark, sf)
    return a.select("row_id", R.coerce_double(F.col(C.capacity).cast("string"), T.StringType()).alias("capacity_coerced"))


VALIDATE_SQL = f"""
, v AS (SELECT row_id, concat_ws(', ', {SQL_ID}, {SQL_NAME}, {SQL_CAP}, {SQL_LAT}, {SQL_LON}, {SQL_COUNTRY}, {SQL_FUEL}, {SQL_YEAR}) AS pydantic_errors
        FROM assets)
"""


@register("validate_records", with_assets(VALIDATE_SQL + "SELECT row_id, pydantic_errors = '' AS pydantic_valid, pydantic_errors FROM v"))
def q_validate_records(spark, sf):
    return validate.validate_records(load_assets(spark, sf)).select("row_id", "pydantic_valid", "pydantic_errors")


@register(
    "validate_summary",
    with_assets(VALIDATE_SQL + "SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE pydantic_errors <> '') AS n_invalid FROM v"),
)
def q_validate_summary(spark, sf):
    return validate.validate_summary(validate.validate_records(load_assets(spark, sf)))


@register(
    "asset_normalise",
    with_assets("SELECT row_id, upper(regexp_replace(country, '^\\s+|\\s+$', '', 'g')) AS country_code, "
                "regexp_replace(gppd_idnr, '^\\s+|\\s+$', '', 'g') AS asset_id FROM assets"),
)
def q_asset_normalise(spark, sf):
    a = load_assets(spark, sf)
    return a.select("row_id", geo.normalised_country(C).alias("country_code"),
                    F.regexp_replace(F.col(C.id), r"^\s+|\s+$", "").alias("asset_id"))


@register(
    "asset_null_keys",
    with_assets(
        "SELECT row_id, coalesce(CAST(gppd_idnr AS VARCHAR), 'nan') AS legacy_id, "
        "coalesce(CAST(country AS VARCHAR), 'nan') AS legacy_country FROM assets"
    ),
)
def q_asset_null_keys(spark, sf):
    a = load_assets(spark, sf)
    return a.select("row_id", F.coalesce(F.col(C.id).cast("string"), F.lit("nan")).alias("legacy_id"),
                    F.coalesce(F.col(C.country).cast("string"), F.lit("nan")).alias("legacy_country"))


@register("polygon_edges", with_edges("SELECT iso_a3, 0 AS part, 0 AS ring, seq, x1, y1, x2, y2 FROM edges"))
def q_polygon_edges(spark, sf):
    return country_edges(spark, sf)


_BORDER_SQL = """
, d AS (
  SELECT row_id,
    SUM(CASE WHEN (y1 > latitude) <> (y2 > latitude)
              AND longitude < (x2-x1)*(latitude-y1)/CASE WHEN y2=y1 THEN 1 ELSE y2-y1 END + x1 THEN 1 ELSE 0 END) % 2 AS inside,
    MIN(sqrt(power(longitude-(x1+t*(x2-x1)),2)+power(latitude-(y1+t*(y2-y1)),2))) AS dist
  FROM (SELECT assets.*, e.*, greatest(0.0, least(1.0,
          ((longitude-x1)*(x2-x1)+(latitude-y1)*(y2-y1))/((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))) AS t
        FROM assets JOIN edges e ON upper(regexp_replace(assets.country, '^\\s+|\\s+$', '', 'g')) = e.iso_a3) q
  GROUP BY row_id),
pic AS (SELECT a.row_id, a.country, coalesce(d.inside = 1 OR d.dist < 0.5, true) AS in_country
        FROM assets a LEFT JOIN d ON a.row_id = d.row_id)
"""


@register("point_in_country", with_edges(_BORDER_SQL + "SELECT row_id, country, in_country FROM pic"))
def q_point_in_country(spark, sf):
    a = load_assets(spark, sf)
    return geo.point_in_country(a, country_edges(spark, sf)).select("row_id", "country", "in_country")


@register("point_in_country_cells", with_edges(_BORDER_SQL + "SELECT row_id, country, in_country FROM pic"))
def q_point_in_country_cells(spark, sf):
    # the grid-cell index path that detailed coastlines take, forced on the fixture polygons
    a = load_assets(spark, sf)
    return geo.point_in_country(a, country_edges(spark, sf), method="cells", cell_deg=3.0).select(
        "row_id", "country", "in_country"
    )


#: Only edges that a point's height or the buffer can meet are paired with it.
_COAST_SQL = """
, pairs AS (
  SELECT a.row_id, e.*, longitude, latitude FROM assets a JOIN coast e ON upper(regexp_replace(a.country, '^\\s+|\\s+$', '', 'g')) = e.iso_a3
  WHERE (y1 > latitude) <> (y2 > latitude) OR (latitude BETWEEN least(y1, y2) - 0.6 AND greatest(y1, y2) + 0.6
    AND longitude BETWEEN least(x1, x2) - 0.6 AND greatest(x1, x2) + 0.6)),
d AS (
  SELECT row_id,
    SUM(CASE WHEN (y1 > latitude) <> (y2 > latitude)
              AND longitude < (x2-x1)*(latitude-y1)/CASE WHEN y2=y1 THEN 1 ELSE y2-y1 END + x1 THEN 1 ELSE 0 END) % 2 AS inside,
    MIN(sqrt(power(longitude-(x1+t*(x2-x1)),2)+power(latitude-(y1+t*(y2-y1)),2))) AS dist
  FROM (SELECT *, greatest(0.0, least(1.0,
          ((longitude-x1)*(x2-x1)+(latitude-y1)*(y2-y1))/((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)))) AS t FROM pairs) q
  GROUP BY row_id)
SELECT row_id, country, CASE WHEN known.iso_a3 IS NULL THEN true ELSE coalesce(d.inside = 1 OR d.dist < 0.5, false) END AS in_country
FROM assets a LEFT JOIN d USING (row_id)
LEFT JOIN (SELECT DISTINCT iso_a3 FROM edges) known ON upper(regexp_replace(a.country, '^\\s+|\\s+$', '', 'g')) = known.iso_a3
"""


@register("point_in_country_coast", with_coast(_COAST_SQL))
def q_point_in_country_coast(spark, sf):
    """G1 on coasts of 10,200 edges a country."""
    coast = cut_lineage(roughened_edges(country_edges(spark, sf), COAST_PIECES))  # read several times
    return geo.point_in_country(load_assets(spark, sf), coast).select("row_id", "country", "in_country")


@register(
    "ocean_spatial_coast",
    with_coast(
        """
, land AS (SELECT row_id, MAX(inside) AS on_land FROM (
    SELECT a.row_id, e.iso_a3, SUM(CASE WHEN longitude < (x2-x1)*(latitude-y1)/(y2-y1) + x1 THEN 1 ELSE 0 END) % 2 AS inside
    FROM assets a JOIN (SELECT *, unnest(range(CAST(floor(least(y1, y2)) AS BIGINT), CAST(floor(greatest(y1, y2)) AS BIGINT) + 1)) AS band FROM coast) e
      ON CAST(floor(a.latitude) AS BIGINT) = e.band
    WHERE (y1 > latitude) <> (y2 > latitude) GROUP BY a.row_id, e.iso_a3) GROUP BY row_id)
SELECT a.row_id, a.latitude, a.longitude FROM assets a LEFT JOIN land l ON a.row_id = l.row_id WHERE coalesce(l.on_land, 0) = 0"""
    ),
)
def q_ocean_spatial_coast(spark, sf):
    """G2 on the same coasts."""
    coast = cut_lineage(roughened_edges(country_edges(spark, sf), COAST_PIECES))  # read several times
    return geo.ocean_by_land(load_assets(spark, sf), coast).where("in_ocean").select("row_id", "latitude", "longitude")


_ASSET_FIELDS_SQL = """concat_ws(' | ',
   CASE WHEN gppd_idnr IS NULL THEN 'id: Input should be a valid string'
        WHEN regexp_matches(gppd_idnr, '^\\s*$') THEN 'id: Value error, Asset id must not be blank or whitespace.' END,
   CASE WHEN latitude IS NULL THEN 'latitude: Input should be a valid number'
        WHEN latitude > 90 THEN 'latitude: Input should be less than or equal to 90'
        WHEN latitude < -90 THEN 'latitude: Input should be greater than or equal to -90' END,
   CASE WHEN longitude IS NULL THEN 'longitude: Input should be a valid number'
        WHEN longitude > 180 THEN 'longitude: Input should be less than or equal to 180'
        WHEN longitude < -180 THEN 'longitude: Input should be greater than or equal to -180' END,
   CASE WHEN capacity_mw < 0 THEN 'capacity_mw: Input should be greater than or equal to 0' END,
   CASE WHEN country IS NULL THEN 'country: Input should be a valid string'
        WHEN length(country) < 3 THEN 'country: String should have at least 3 characters'
        WHEN length(country) > 3 THEN 'country: String should have at most 3 characters' END)"""

ASSET_VALID_SQL = (
    _BORDER_SQL
    + f"""
, f AS (SELECT a.row_id, a.gppd_idnr, a.latitude, a.longitude, a.country, a.capacity_mw, p.in_country
        FROM assets a JOIN (SELECT row_id AS pid, in_country FROM pic) p ON a.row_id = p.pid),
f2 AS (SELECT *, {_ASSET_FIELDS_SQL} AS ferr FROM f),
va AS (SELECT row_id, gppd_idnr, latitude, longitude, country,
  (ferr = '' AND in_country) AS asset_valid,
  CASE WHEN ferr = '' AND NOT in_country THEN concat('Value error, Coordinates (', CAST(latitude AS VARCHAR), ', ',
       CAST(longitude AS VARCHAR), ') do not fall within the borders of ''', upper(regexp_replace(country, '^\\s+|\\s+$', '', 'g')),
       '''. Possible country mis-assignment or coordinate error.') ELSE ferr END AS asset_errors,
  NOT (ferr = '' AND NOT in_country) AS geometry_consistent
  FROM f2)
"""
)


@register("validate_assets", with_edges(ASSET_VALID_SQL + "SELECT row_id, asset_valid, asset_errors, geometry_consistent FROM va"))
def q_validate_assets(spark, sf):
    a = load_assets(spark, sf)
    return validate.validate_assets(a, country_edges(spark, sf)).select(
        "row_id", "asset_valid", "asset_errors", "geometry_consistent"
    )


@register(
    "ocean_spatial_join",
    with_edges(
        """
, par AS (SELECT a.row_id, e.iso_a3,
    SUM(CASE WHEN (y1 > latitude) <> (y2 > latitude)
              AND longitude < (x2-x1)*(latitude-y1)/CASE WHEN y2=y1 THEN 1 ELSE y2-y1 END + x1 THEN 1 ELSE 0 END) % 2 AS inside
    FROM assets a CROSS JOIN edges e GROUP BY a.row_id, e.iso_a3),
land AS (SELECT row_id, MAX(inside) AS on_land FROM par GROUP BY row_id)
SELECT a.row_id, a.latitude, a.longitude FROM assets a JOIN land l ON a.row_id = l.row_id WHERE l.on_land = 0"""
    ),
)
def q_ocean_spatial_join(spark, sf):
    a = load_assets(spark, sf)
    return geo.ocean_by_land(a, country_edges(spark, sf)).where("in_ocean").select("row_id", "latitude", "longitude")


_LAND_SQL = """
, par AS (SELECT a.row_id, e.iso_a3,
    SUM(CASE WHEN (y1 > latitude) <> (y2 > latitude)
              AND longitude < (x2-x1)*(latitude-y1)/CASE WHEN y2=y1 THEN 1 ELSE y2-y1 END + x1 THEN 1 ELSE 0 END) % 2 AS inside
    FROM assets a CROSS JOIN edges e GROUP BY a.row_id, e.iso_a3),
land AS (SELECT row_id, MAX(inside) AS on_land FROM par GROUP BY row_id),
dup AS (SELECT gppd_idnr, COUNT(*) AS id_count FROM assets WHERE gppd_idnr IS NOT NULL GROUP BY gppd_idnr HAVING COUNT(*) > 1),
j AS (SELECT a.*, d.id_count, l.on_land FROM assets a LEFT JOIN dup d ON a.gppd_idnr = d.gppd_idnr
      LEFT JOIN land l ON a.row_id = l.row_id)
SELECT row_id, gppd_idnr, coalesce(name, '') AS plant_name, 'OCEAN_COORDS' AS issue_type,
       concat('lat=', CAST(latitude AS VARCHAR), ', lon=', CAST(longitude AS VARCHAR)) AS detail, capacity_mw
FROM j WHERE coalesce(on_land, 0) = 0
UNION ALL
SELECT row_id, gppd_idnr, coalesce(name, ''), 'DUPLICATE_ID', concat('appears ', CAST(id_count AS VARCHAR), 'x'), capacity_mw
FROM j WHERE id_count IS NOT NULL
UNION ALL
SELECT row_id, gppd_idnr, coalesce(name, ''), 'MISSING_CAPACITY', 'capacity_mw is NaN', capacity_mw FROM j WHERE capacity_mw IS NULL
"""


@register("qa_report_land", with_edges(_LAND_SQL))
def q_qa_report_land(spark, sf):
    from terracheck.operators import qa

    return qa.detect_qa_errors(load_assets(spark, sf), mode="land", land=country_edges(spark, sf))
