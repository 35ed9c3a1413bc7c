"""Registered queries: expectation suite and DQ dimension report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS as C
from terracheck.operators import dq, validate
from terracheck.operators import expectations as X
from terracheck.plans.catalog import register
from terracheck.plans.oracle_sql import with_assets, with_edges
from terracheck.plans.queries_rules import ASSET_VALID_SQL, country_edges
from terracheck.sources.assets import load_assets

SUITE_COLS = "check_order, expectation, dimension, \"column\", success, observed, observed_value, n_bad, n_checked, threshold, detail"

_STATS = """
, s AS (SELECT COUNT(*) AS total, COUNT(capacity_mw) AS nn_cap, COUNT(commissioning_year) AS nn_year,
    COUNT(latitude) AS n_lat, MIN(latitude) AS min_lat, MAX(latitude) AS max_lat,
    COUNT(*) FILTER (WHERE latitude < -90 OR latitude > 90) AS out_lat,
    COUNT(longitude) AS n_lon, MIN(longitude) AS min_lon, MAX(longitude) AS max_lon,
    COUNT(*) FILTER (WHERE longitude < -180 OR longitude > 180) AS out_lon,
    COUNT(capacity_mw) AS n_cap, MIN(capacity_mw) AS min_cap, MAX(capacity_mw) AS max_cap,
    COUNT(*) FILTER (WHERE capacity_mw < 0 OR capacity_mw > 25000) AS out_cap,
    COUNT(commissioning_year) AS n_year, CAST(MIN(commissioning_year) AS DOUBLE) AS min_year,
    CAST(MAX(commissioning_year) AS DOUBLE) AS max_year,
    COUNT(*) FILTER (WHERE commissioning_year < 1900 OR commissioning_year > 2100) AS out_year
  FROM assets),
ids AS (SELECT gppd_idnr, COUNT(*) AS cnt FROM assets GROUP BY gppd_idnr),
u AS (SELECT CAST(COALESCE(SUM(CASE WHEN cnt > 1 THEN cnt END), 0) AS BIGINT) AS dupes, COUNT(gppd_idnr) AS nuniq FROM ids),
top5 AS (SELECT gppd_idnr, cnt FROM ids WHERE gppd_idnr IS NOT NULL AND cnt > 1 ORDER BY cnt DESC, gppd_idnr LIMIT 5),
smp AS (SELECT CASE WHEN COUNT(*) > 0 THEN '{' || string_agg('''' || gppd_idnr || ''': ' || CAST(cnt AS VARCHAR), ', '
               ORDER BY cnt DESC, gppd_idnr) || '}' END AS sample FROM top5),
st AS (SELECT * FROM s, u, smp),
suite AS (
  SELECT 1 AS check_order, 'expect_column_values_to_not_be_null' AS expectation, 'Completeness' AS dimension,
    'capacity_mw' AS "column", (CASE WHEN total > 0 THEN nn_cap / total ELSE 0.0 END) >= 1.0 AS success,
    CAST(round(CASE WHEN total > 0 THEN nn_cap / total ELSE 0.0 END, 4) AS VARCHAR) AS observed,
    round(CASE WHEN total > 0 THEN nn_cap / total ELSE 0.0 END, 4) AS observed_value,
    total - nn_cap AS n_bad, total AS n_checked, '1.0' AS threshold,
    format('{:,}', total - nn_cap) || ' / ' || format('{:,}', total) || ' values are null (' ||
      printf('%.1f', 100 * (1 - CASE WHEN total > 0 THEN nn_cap / total ELSE 0.0 END)) || '% missing).' AS detail
  FROM st
  UNION ALL
  SELECT 2, 'expect_column_values_to_not_be_null', 'Completeness', 'commissioning_year',
    (CASE WHEN total > 0 THEN nn_year / total ELSE 0.0 END) >= 0.95,
    CAST(round(CASE WHEN total > 0 THEN nn_year / total ELSE 0.0 END, 4) AS VARCHAR),
    round(CASE WHEN total > 0 THEN nn_year / total ELSE 0.0 END, 4), total - nn_year, total, '0.95',
    'Required ≥ 95% complete. ' || format('{:,}', total - nn_year) || ' / ' || format('{:,}', total) || ' values are null (' ||
      printf('%.1f', 100 * (1 - CASE WHEN total > 0 THEN nn_year / total ELSE 0.0 END)) || '% missing).'
  FROM st
  UNION ALL
  SELECT 3, 'expect_table_row_count_to_be_between', 'Completeness', '(table)', total BETWEEN 1 AND 10000000,
    CAST(total AS VARCHAR), CAST(total AS DOUBLE), 0, total, '[1, 10000000]', 'Dataset contains ' || format('{:,}', total) || ' rows.'
  FROM st
  UNION ALL
  SELECT 4, 'expect_column_values_to_be_unique', 'Uniqueness', 'gppd_idnr', dupes = 0,
    CAST(round(CASE WHEN total > 0 THEN 1 - dupes / total ELSE 1.0 END, 4) AS VARCHAR),
    round(CASE WHEN total > 0 THEN 1 - dupes / total ELSE 1.0 END, 4), dupes, total, '1.0',
    format('{:,}', dupes) || ' duplicate rows across ' || format('{:,}', total - nuniq) || ' non-unique values.' ||
      CASE WHEN sample IS NOT NULL THEN ' Sample duplicates: ' || sample ELSE '' END
  FROM st
  UNION ALL
  SELECT 5, 'expect_column_values_to_be_between', 'Validity', 'latitude', out_lat = 0,
    'min=' || coalesce(printf('%.2f', min_lat), 'nan') || ', max=' || coalesce(printf('%.2f', max_lat), 'nan'), NULL, out_lat, n_lat,
    '[-90, 90]', CASE WHEN out_lat > 0 THEN format('{:,}', out_lat) || ' values outside [-90, 90].'
                 ELSE 'All ' || format('{:,}', n_lat) || ' values within range.' END
  FROM st
  UNION ALL
  SELECT 6, 'expect_column_values_to_be_between', 'Validity', 'longitude', out_lon = 0,
    'min=' || coalesce(printf('%.2f', min_lon), 'nan') || ', max=' || coalesce(printf('%.2f', max_lon), 'nan'), NULL, out_lon, n_lon,
    '[-180, 180]', CASE WHEN out_lon > 0 THEN format('{:,}', out_lon) || ' values outside [-180, 180].'
                 ELSE 'All ' || format('{:,}', n_lon) || ' values within range.' END
  FROM st
  UNION ALL
  SELECT 7, 'expect_column_values_to_be_between', 'Consistency', 'capacity_mw', out_cap = 0,
    'min=' || coalesce(printf('%.2f', min_cap), 'nan') || ', max=' || coalesce(printf('%.2f', max_cap), 'nan'), NULL, out_cap, n_cap,
    '[0, 25000]', CASE WHEN out_cap > 0 THEN format('{:,}', out_cap) || ' values outside [0, 25000].'
                 ELSE 'All ' || format('{:,}', n_cap) || ' values within range.' END
  FROM st
  UNION ALL
  SELECT 8, 'expect_column_values_to_be_between', 'Consistency', 'commissioning_year', out_year = 0,
    'min=' || coalesce(printf('%.2f', min_year), 'nan') || ', max=' || coalesce(printf('%.2f', max_year), 'nan'), NULL, out_year, n_year,
    '[1900, 2100]', CASE WHEN out_year > 0 THEN format('{:,}', out_year) || ' values outside [1900, 2100].'
                 ELSE 'All ' || format('{:,}', n_year) || ' values within range.' END
  FROM st)
"""
SUITE_SQL = _STATS


def suite(spark, sf):
    return X.run_expectation_suite(load_assets(spark, sf))


register("expectation_suite", with_assets(SUITE_SQL + f"SELECT {SUITE_COLS} FROM suite"))(suite)


def _numbered(result, first: int):
    """A single check's result with the number that it has in the default suite."""
    return result.withColumn("check_order", (F.col("check_order") + first - 1).cast("int"))


SUITE = X.default_suite()


def _expect_between(spark, sf):
    a = load_assets(spark, sf)
    parts = [_numbered(X.expect_between(a, ch.column, ch.lo, ch.hi, ch.dimension), k) for k, ch in enumerate(SUITE, 1) if ch.kind == "between"]
    return reduce(lambda x, y: x.unionByName(y), parts)


register("expect_not_null", with_assets(SUITE_SQL + f"SELECT {SUITE_COLS} FROM suite WHERE check_order = 1"))(
    lambda spark, sf: X.expect_not_null(load_assets(spark, sf), SUITE[0].column, SUITE[0].threshold)
)
register("expect_not_null_mostly", with_assets(SUITE_SQL + f"SELECT {SUITE_COLS} FROM suite WHERE check_order = 2"))(
    lambda spark, sf: _numbered(X.expect_not_null_mostly(load_assets(spark, sf), SUITE[1].column, SUITE[1].threshold), 2)
)
register("expect_row_count", with_assets(SUITE_SQL + f"SELECT {SUITE_COLS} FROM suite WHERE check_order = 3"))(
    lambda spark, sf: _numbered(X.expect_row_count(load_assets(spark, sf), SUITE[2].lo, SUITE[2].hi), 3)
)
register("expect_unique", with_assets(SUITE_SQL + f"SELECT {SUITE_COLS} FROM suite WHERE check_order = 4"))(
    lambda spark, sf: _numbered(X.expect_unique(load_assets(spark, sf), SUITE[3].column), 4)
)
register("expect_between", with_assets(SUITE_SQL + f"SELECT {SUITE_COLS} FROM suite WHERE check_order >= 5"))(_expect_between)
register(
    "top_duplicate_values",
    with_assets(
        "SELECT gppd_idnr, COUNT(*) AS count FROM assets WHERE gppd_idnr IS NOT NULL GROUP BY gppd_idnr "
        "HAVING COUNT(*) > 1 ORDER BY count DESC, gppd_idnr LIMIT 5"
    ),
)(lambda spark, sf: X.top_duplicate_values(load_assets(spark, sf), C.id))
register(
    "suite_summary",
    with_assets(
        SUITE_SQL
        + "SELECT COUNT(*) AS checks, COUNT(*) FILTER (WHERE success) AS passed, COUNT(*) FILTER (WHERE NOT success) AS failed, "
        "round(AVG(CASE WHEN success THEN 1.0 ELSE 0.0 END), 6) AS pass_rate FROM suite"
    ),
)(lambda spark, sf: X.suite_summary(suite(spark, sf)))
register(
    "suite_by_dimension",
    with_assets(
        SUITE_SQL
        + "SELECT dimension, COUNT(*) AS checks, COUNT(*) FILTER (WHERE success) AS passed, "
        "COUNT(*) FILTER (WHERE NOT success) AS failed, round(AVG(CASE WHEN success THEN 1.0 ELSE 0.0 END), 6) AS score "
        "FROM suite GROUP BY dimension"
    ),
)(lambda spark, sf: X.suite_by_dimension(suite(spark, sf)))

# --- DQ dimension report ----------------------------------------------------------------
_DQ_SQL = (
    ASSET_VALID_SQL.replace("\n, d AS (", ", d AS (", 1)
    + SUITE_SQL
    + """
, acc AS (SELECT COALESCE(AVG(CASE WHEN geometry_consistent THEN 1.0 ELSE 0.0 END), 1.0) AS raw FROM va),
bydim AS (SELECT dimension, AVG(CASE WHEN success THEN 1.0 ELSE 0.0 END) AS sc FROM suite GROUP BY dimension),
dims(dim_order, dimension, suite_dimension, thr) AS (VALUES (1, 'ACCURACY', NULL, 0.95), (2, 'COMPLETENESS', 'Completeness', 0.95),
     (3, 'CONSISTENCY', 'Consistency', 0.95), (4, 'UNIQUENESS', 'Uniqueness', 0.99)),
dq AS (SELECT d.dim_order, d.dimension,
         CASE WHEN d.dimension = 'ACCURACY' THEN (SELECT raw FROM acc) ELSE COALESCE(b.sc, 1.0) END AS raw_score, d.thr
       FROM dims d LEFT JOIN bydim b ON d.suite_dimension = b.dimension)
"""
)


@register(
    "dq_dimensions",
    with_edges(
        _DQ_SQL
        + """SELECT dim_order, dimension, round(raw_score, 4) AS score, printf('%.1f', raw_score * 100) || '%' AS pct,
  CASE WHEN raw_score >= thr THEN '✅ PASS' ELSE '❌ FAIL' END AS status FROM dq"""
    ),
)
def q_dq_dimensions(spark, sf):
    a = load_assets(spark, sf)
    rep = dq.build_dq_report(a, country_edges=country_edges(spark, sf))
    return rep.dimensions.select("dim_order", "dimension", "score", "pct", "status")


@register(
    "dq_accuracy",
    with_edges(
        ASSET_VALID_SQL
        + """SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE geometry_consistent) AS n_consistent,
  round(COALESCE(AVG(CASE WHEN geometry_consistent THEN 1.0 ELSE 0.0 END), 1.0), 6) AS accuracy FROM va"""
    ),
)
def q_dq_accuracy(spark, sf):
    a = load_assets(spark, sf)
    return dq.accuracy(validate.validate_assets(a, country_edges(spark, sf))).withColumn(
        "accuracy", F.round("accuracy", 6)
    )


@register(
    "dq_accuracy_issues",
    with_edges(
        ASSET_VALID_SQL
        + """SELECT row_id, gppd_idnr, latitude, longitude, country, asset_errors FROM va
  WHERE NOT geometry_consistent ORDER BY row_id LIMIT 20"""
    ),
)
def q_dq_accuracy_issues(spark, sf):
    a = load_assets(spark, sf)
    return dq.accuracy_issues(validate.validate_assets(a, country_edges(spark, sf)))


@register(
    "dq_overall",
    with_edges(
        _DQ_SQL
        + """, meta AS (SELECT COUNT(*) AS gx_checks, COUNT(*) FILTER (WHERE success) AS gx_passed,
      COUNT(*) FILTER (WHERE NOT success) AS gx_failed FROM suite)
SELECT (SELECT COUNT(*) FROM va) AS total_rows, gx_checks, gx_passed, gx_failed, round(AVG(raw_score), 4) AS overall_score,
  printf('%.1f', AVG(raw_score) * 100) || '%' AS overall_pct,
  CASE WHEN AVG(raw_score) >= 0.90 THEN '✅ PASS' ELSE '❌ FAIL' END AS overall_status
FROM dq, meta GROUP BY gx_checks, gx_passed, gx_failed"""
    ),
)
def q_dq_overall(spark, sf):
    a = load_assets(spark, sf)
    rep = dq.build_dq_report(a, country_edges=country_edges(spark, sf))
    return rep.summary


@register(
    "dq_checks",
    with_assets(
        SUITE_SQL
        + """SELECT upper(dimension) AS dq_dimension, check_order, expectation, "column", success, observed, threshold, detail
FROM suite WHERE dimension IN ('Completeness', 'Consistency', 'Uniqueness')"""
    ),
)
def q_dq_checks(spark, sf):
    return dq.dimension_checks(suite(spark, sf))


@register(
    "dq_report",
    with_edges(
        _DQ_SQL
        + """, meta AS (SELECT COUNT(*) AS gx_checks, COUNT(*) FILTER (WHERE success) AS gx_passed FROM suite),
ov AS (SELECT AVG(raw_score) AS o FROM dq)
SELECT dq.dimension, round(raw_score, 4) AS score, printf('%.1f', raw_score * 100) || '%' AS pct,
  CASE WHEN raw_score >= thr THEN '✅ PASS' ELSE '❌ FAIL' END AS status,
  (SELECT COUNT(*) FROM va) AS total_rows, gx_checks, gx_passed, round(o, 4) AS overall_score,
  CASE WHEN o >= 0.90 THEN '✅ PASS' ELSE '❌ FAIL' END AS overall_status
FROM dq, meta, ov"""
    ),
)
def q_dq_report(spark, sf):
    """The report bundle flattened: every dimension row with the run summary."""
    from terracheck.session import attach_row

    a = load_assets(spark, sf)
    rep = dq.build_dq_report(a, country_edges=country_edges(spark, sf))
    summary = rep.summary.select("total_rows", "gx_checks", "gx_passed", "overall_score", "overall_status")
    return attach_row(rep.dimensions.select("dimension", "score", "pct", "status"), summary)
