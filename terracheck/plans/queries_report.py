"""Registered queries: run summary, recall, coverage, top-k and chart tables.

They read one fixture: the injected asset table with deterministic stand-in
model scores blended by the real :func:`compute_final_score`, so each consumer
has an exact SQL oracle (the forests themselves are checked by properties).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from terracheck.operators import charts as CH
from terracheck.operators import evaluate as EV
from terracheck.operators import inject
from terracheck.operators.scoring import compute_final_score
from terracheck.plans.catalog import register
from terracheck.plans.oracle_sql import with_assets
from terracheck.plans.queries_inject import INJECT_SQL, SEED
from terracheck.session import cut_lineage
from terracheck.sources.assets import load_assets


def standin_sql(src: str) -> str:
    return f"""
, s AS (SELECT {src}.*,
    round(CAST((row_id * 7919) % 1000 AS DOUBLE) / 2000 - 0.1, 4) AS global_score,
    CASE WHEN row_id % 10 = 0 THEN NULL ELSE round(CAST((row_id * 104729) % 1000 AS DOUBLE) / 2000 - 0.1, 4) END AS country_score
  FROM {src}),
s2 AS (SELECT *, coalesce(country_score, global_score) AS cg, global_score < 0 AS global_anomaly,
   coalesce(country_score < 0, false) AS country_anomaly,
   CASE WHEN country_score IS NULL THEN 'global_fallback' ELSE 'country' END AS model_used FROM s),
med AS (SELECT quantile_cont(global_score, 0.5) AS gm, quantile_cont(cg, 0.5) AS cm FROM s2),
inv AS (SELECT s2.*, -coalesce(global_score, gm) AS gi, -coalesce(cg, cm) AS ci FROM s2, med),
mm AS (SELECT min(gi) AS gmn, max(gi) AS gmx, min(ci) AS cmn, max(ci) AS cmx FROM inv),
fs AS (SELECT inv.*, round(0.4 * ((gi - gmn) / (gmx - gmn + 1e-9)) + 0.6 * ((ci - cmn) / (cmx - cmn + 1e-9)), 4) AS ANOMALY_SCORE
  FROM inv, mm),
scored AS (SELECT *, ANOMALY_SCORE > 0.6 OR global_anomaly OR country_anomaly AS IS_ANOMALY FROM fs)
"""


SCORED_SQL = INJECT_SQL + standin_sql("e3")


def scored_fixture(spark, sf):
    """The injected table with stand-in scores; it is stored, as the blend and the consumers scan it several times."""
    d = cut_lineage(inject.inject_errors(load_assets(spark, sf), seed=SEED))
    rid = F.col("row_id")
    g = F.round((rid * 7919 % 1000).cast("double") / 2000 - 0.1, 4)
    c = F.when(rid % 10 == 0, F.lit(None).cast("double")).otherwise(F.round((rid * 104729 % 1000).cast("double") / 2000 - 0.1, 4))
    s = d.withColumns({"global_score": g, "country_score": c}).withColumns(
        {
            "global_anomaly": F.col("global_score") < 0,
            "country_anomaly": F.coalesce(F.col("country_score") < 0, F.lit(False)),
            "model_used": F.when(F.col("country_score").isNull(), F.lit("global_fallback")).otherwise(F.lit("country")),
        }
    )
    return compute_final_score(s)


def q(name, tail):
    def deco(fn):
        register(name, with_assets(SCORED_SQL + tail))(fn)
        return fn

    return deco


@q(
    "anomaly_summary",
    """SELECT COUNT(*) AS total, COUNT(*) - COUNT(*) FILTER (WHERE IS_ANOMALY) AS clean,
  COUNT(*) FILTER (WHERE IS_ANOMALY) AS anomalous,
  round(100 * (COUNT(*) - COUNT(*) FILTER (WHERE IS_ANOMALY)) / COUNT(*), 6) AS pct_clean,
  round(100 * COUNT(*) FILTER (WHERE IS_ANOMALY) / COUNT(*), 6) AS pct_anomalous,
  round(AVG(ANOMALY_SCORE), 6) AS avg_score FROM scored""",
)
def q_anomaly_summary(spark, sf):
    return EV.anomaly_summary(scored_fixture(spark, sf))


@q(
    "detection_recall",
    """SELECT COUNT(*) FILTER (WHERE length(error_flags) > 0) AS known,
  COUNT(*) FILTER (WHERE length(error_flags) > 0 AND IS_ANOMALY) AS caught,
  round(CASE WHEN COUNT(*) FILTER (WHERE length(error_flags) > 0) > 0
        THEN COUNT(*) FILTER (WHERE length(error_flags) > 0 AND IS_ANOMALY) / COUNT(*) FILTER (WHERE length(error_flags) > 0)
        ELSE 0.0 END, 6) AS recall FROM scored""",
)
def q_detection_recall(spark, sf):
    return EV.detection_recall(scored_fixture(spark, sf))


@q(
    "recall_by_error_type",
    """SELECT error_type, COUNT(*) AS known, COUNT(*) FILTER (WHERE IS_ANOMALY) AS caught,
  round(COUNT(*) FILTER (WHERE IS_ANOMALY) / COUNT(*), 6) AS recall
FROM (SELECT unnest(string_split(error_flags, '|')) AS error_type, IS_ANOMALY FROM scored WHERE length(error_flags) > 0)
GROUP BY error_type""",
)
def q_recall_by_error_type(spark, sf):
    return EV.recall_by_error_type(scored_fixture(spark, sf))


@q(
    "model_coverage",
    """SELECT model_used, COUNT(*) AS count, round(100 * COUNT(*) / (SELECT COUNT(*) FROM scored), 6) AS pct
FROM scored GROUP BY model_used""",
)
def q_model_coverage(spark, sf):
    return EV.model_coverage(scored_fixture(spark, sf))


@q(
    "top_anomalies",
    """SELECT row_id, gppd_idnr, country, latitude, longitude, capacity_mw, ANOMALY_SCORE, IS_ANOMALY FROM scored
ORDER BY ANOMALY_SCORE DESC, row_id LIMIT 5""",
)
def q_top_anomalies(spark, sf):
    return EV.top_anomalies(scored_fixture(spark, sf))


@q(
    "map_centre",
    "SELECT round(quantile_cont(latitude, 0.5), 6) AS centre_lat, round(quantile_cont(longitude, 0.5), 6) AS centre_lon FROM scored",
)
def q_map_centre(spark, sf):
    c = CH.map_centre(scored_fixture(spark, sf))
    return c.select(F.round("centre_lat", 6).alias("centre_lat"), F.round("centre_lon", 6).alias("centre_lon"))


_RADIUS = """, rr AS (SELECT scored.*, CASE WHEN coalesce(capacity_mw, 100.0) > -1 THEN ln(1 + coalesce(capacity_mw, 100.0)) END AS r
  FROM scored),
rm AS (SELECT min(r) AS rmin, max(r) AS rmax FROM rr),
rad AS (SELECT rr.*, 4.0 + 14.0 * (r - rmin) / (rmax - rmin + 1e-9) AS radius FROM rr, rm)
"""


@q("marker_radius", _RADIUS + "SELECT row_id, round(radius, 6) AS radius FROM rad")
def q_marker_radius(spark, sf):
    return CH.marker_radius(scored_fixture(spark, sf)).select("row_id", F.round("radius", 6).alias("radius"))


@q(
    "marker_table",
    _RADIUS
    + """SELECT row_id, CASE WHEN IS_ANOMALY THEN 'anomalous' ELSE 'clean' END AS layer,
  CASE WHEN IS_ANOMALY THEN '#e74c3c' ELSE '#2980b9' END AS color,
  CASE WHEN IS_ANOMALY THEN '#ff6b6b' ELSE '#5dade2' END AS fill_color,
  CAST(CASE WHEN IS_ANOMALY THEN 0.85 ELSE 0.55 END AS DOUBLE) AS fill_opacity, round(radius, 6) AS radius, latitude, longitude,
  (CASE WHEN IS_ANOMALY THEN '⚠ ' ELSE '' END) || coalesce(name, gppd_idnr) || ' | Score: ' || printf('%.2f', ANOMALY_SCORE) AS tooltip,
  coalesce(name, gppd_idnr) AS popup_name, gppd_idnr AS popup_id, country AS popup_country, primary_fuel AS popup_fuel,
  CASE WHEN IS_ANOMALY THEN '🔴 ANOMALY' ELSE '✅ CLEAN' END AS popup_status,
  coalesce(CAST(capacity_mw AS VARCHAR), 'nan') || ' MW' AS popup_capacity, CASE WHEN IS_ANOMALY THEN '#e74c3c' ELSE '#27ae60' END AS popup_score_color,
  model_used AS popup_model, printf('%.3f', ANOMALY_SCORE) AS popup_score,
  printf('%.4f', latitude) || ', ' || printf('%.4f', longitude) AS popup_latlon FROM rad""",
)
def q_marker_table(spark, sf):
    return CH.marker_table(scored_fixture(spark, sf)).withColumn("radius", F.round("radius", 6))


@q(
    "marker_pyramid",
    """, spots AS (SELECT *, CAST(least(255, greatest(0, floor((longitude + 180) / 360 * 256))) AS BIGINT) AS x,
    CAST(least(255, greatest(0, floor((90 - latitude) / 180 * 256))) AS BIGINT) AS y FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
tiled AS (SELECT CAST(zoom AS INTEGER) AS zoom, x >> (8 - zoom) AS tile_x, y >> (8 - zoom) AS tile_y,
    CASE WHEN IS_ANOMALY THEN 'anomalous' ELSE 'clean' END AS layer, CAST(round(ANOMALY_SCORE * 10000) AS BIGINT) AS units
  FROM spots, (SELECT unnest([0, 2, 4, 6, 8]) AS zoom)),
coded AS (SELECT *, CAST(list_sum(list_transform(range(8), lambda i: (((tile_x >> i) & 1) << (2 * i)) + (((tile_y >> i) & 1) << (2 * i + 1)))) AS BIGINT) AS tile FROM tiled)
SELECT zoom, tile, tile_x, tile_y, layer, count(*) AS markers, CAST(sum(units) AS DOUBLE) / count(units) / 10000 AS mean_score,
  (tile_x + 0.5) * 360 / power(2.0, zoom) - 180 AS centre_lon, 90 - (tile_y + 0.5) * 180 / power(2.0, zoom) AS centre_lat
FROM coded GROUP BY zoom, tile, tile_x, tile_y, layer""",
)
def q_marker_pyramid(spark, sf):
    """C3 at five zoom levels."""
    return CH.marker_pyramid(scored_fixture(spark, sf))


@q(
    "layer_counts",
    "SELECT CASE WHEN IS_ANOMALY THEN 'anomalous' ELSE 'clean' END AS layer, COUNT(*) AS count FROM scored GROUP BY 1",
)
def q_layer_counts(spark, sf):
    return CH.layer_counts(scored_fixture(spark, sf))


@q(
    "score_histogram",
    """SELECT CAST(least(greatest(floor(ANOMALY_SCORE * 40), 0), 39) AS INTEGER) AS bin, IS_ANOMALY AS is_anomaly,
  COUNT(*) AS count, CAST(least(greatest(floor(ANOMALY_SCORE * 40), 0), 39) AS INTEGER) / 40 AS bin_start,
  (CAST(least(greatest(floor(ANOMALY_SCORE * 40), 0), 39) AS INTEGER) + 1) / 40 AS bin_end, CAST(0.6 AS DOUBLE) AS threshold
FROM scored GROUP BY 1, 2""",
)
def q_score_histogram(spark, sf):
    return CH.score_histogram(scored_fixture(spark, sf))


@q(
    "scatter_series",
    """SELECT row_id, IS_ANOMALY AS is_anomaly, latitude, coalesce(capacity_mw, 0.0) AS capacity_y, longitude, country
FROM scored""",
)
def q_scatter_series(spark, sf):
    return CH.scatter_series(scored_fixture(spark, sf))


@q(
    "country_anomaly_rate",
    """SELECT * FROM (SELECT country, COUNT(*) FILTER (WHERE IS_ANOMALY) AS anomalies, COUNT(*) AS total,
  round(COUNT(*) FILTER (WHERE IS_ANOMALY) / COUNT(*), 6) AS rate FROM scored WHERE country IS NOT NULL
  GROUP BY country ORDER BY anomalies DESC, country LIMIT 20) ORDER BY rate, country""",
)
def q_country_anomaly_rate(spark, sf):
    return CH.country_anomaly_rate(scored_fixture(spark, sf))


@q(
    "marker_density",
    """SELECT CAST(floor(longitude / 1.0) AS BIGINT) AS cell_x, CAST(floor(latitude / 1.0) AS BIGINT) AS cell_y,
  CASE WHEN IS_ANOMALY THEN 'anomalous' ELSE 'clean' END AS layer, COUNT(*) AS markers,
  round(AVG(ANOMALY_SCORE), 6) AS mean_score,
  CAST((CAST(floor(longitude / 1.0) AS BIGINT) + 0.5) * 1.0 AS DOUBLE) AS centre_lon,
  CAST((CAST(floor(latitude / 1.0) AS BIGINT) + 0.5) * 1.0 AS DOUBLE) AS centre_lat
FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3""",
)
def q_marker_density(spark, sf):
    return CH.marker_density(scored_fixture(spark, sf))
