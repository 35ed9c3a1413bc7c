"""Registered queries: features, thresholds, forests and blended scores."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from terracheck.operators import features as FE
from terracheck.operators import forest as FO
from terracheck.operators import scoring as SC
from terracheck.operators.bundle import AnomalyBundle, fit_bundle
from terracheck.operators.quantiles import exact_quantile
from terracheck.plans.catalog import register
from terracheck.plans.forest_sql import forest_sql
from terracheck.plans.oracle_sql import with_assets
from terracheck.session import cut_lineage, ensure_checkpoint_dir
from terracheck.sources.assets import load_assets, load_supplier_assets

SUPPLIER_ASSETS_SQL = """
WITH sup AS (SELECT s_suppkey AS row_id, concat('SUP', lpad(CAST(s_suppkey AS VARCHAR), 8, '0')) AS gppd_idnr,
  s_name AS name, s_acctbal AS capacity_mw,
  -90 + ((CAST(s_nationkey AS BIGINT) - CAST(s_nationkey AS BIGINT) % 5) / 5) * 36 + 2 + CAST((s_suppkey * 104729) % 1600 AS DOUBLE) / 100 AS latitude,
  -180 + (CAST(s_nationkey AS BIGINT) % 5) * 72 + 4 + CAST((s_suppkey * 7919) % 6400 AS DOUBLE) / 100 AS longitude,
  concat('C', lpad(CAST(s_nationkey AS VARCHAR), 2, '0')) AS country
  FROM supplier)
"""

FEATURES_SQL = """
, cm AS (SELECT country, quantile_cont(capacity_mw, 0.5) AS country_cap_median FROM assets GROUP BY country),
gm AS (SELECT quantile_cont(capacity_mw, 0.5) AS gmed FROM assets),
f1 AS (SELECT a.*, cm.country_cap_median, coalesce(a.capacity_mw, cm.country_cap_median, gm.gmed) AS cap_filled
       FROM assets a LEFT JOIN cm ON a.country = cm.country CROSS JOIN gm),
zs AS (SELECT country, AVG(cap_filled) AS mu, STDDEV_SAMP(cap_filled) AS sd FROM f1 GROUP BY country),
feat AS (SELECT f1.*, CASE WHEN cap_filled > -1 THEN ln(1 + cap_filled) END AS cap_log,
   latitude / (abs(longitude) + 1e-6) AS lat_lon_ratio,
   coalesce(CASE WHEN f1.country IS NOT NULL AND zs.sd > 0 THEN (cap_filled - zs.mu) / zs.sd END, 0.0) AS country_cap_zscore
   FROM f1 LEFT JOIN zs ON f1.country = zs.country)
"""


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


@register(
    "engineer_features",
    with_assets(
        FEATURES_SQL
        + """SELECT row_id, round(country_cap_median, 6) AS country_cap_median, round(cap_filled, 6) AS cap_filled,
  round(cap_log, 6) AS cap_log, round(lat_lon_ratio, 6) AS lat_lon_ratio, round(country_cap_zscore, 6) AS country_cap_zscore
FROM feat"""
    ),
)
def q_engineer_features(spark, sf):
    f = FE.engineer_features(load_assets(spark, sf))
    return f.select("row_id", *[_r(c) for c in ("country_cap_median", "cap_filled", "cap_log", "lat_lon_ratio", "country_cap_zscore")])


@register("feat_cap_filled", with_assets(FEATURES_SQL + "SELECT row_id, round(cap_filled, 6) AS cap_filled FROM feat"))
def q_feat_cap_filled(spark, sf):
    return FE.cap_filled(load_assets(spark, sf)).select("row_id", _r("cap_filled"))


@register("feat_cap_log", with_assets(FEATURES_SQL + "SELECT row_id, round(cap_log, 6) AS cap_log FROM feat"))
def q_feat_cap_log(spark, sf):
    return FE.add_cap_log(FE.cap_filled(load_assets(spark, sf))).select("row_id", _r("cap_log"))


@register(
    "feat_lat_lon_ratio",
    with_assets("SELECT row_id, round(latitude / (abs(longitude) + 1e-6), 6) AS lat_lon_ratio FROM assets"),
)
def q_feat_lat_lon_ratio(spark, sf):
    return FE.add_lat_lon_ratio(load_assets(spark, sf)).select("row_id", _r("lat_lon_ratio"))


@register("feat_country_zscore", with_assets(FEATURES_SQL + "SELECT row_id, round(country_cap_zscore, 6) AS country_cap_zscore FROM feat"))
def q_feat_country_zscore(spark, sf):
    return FE.engineer_features(load_assets(spark, sf)).select("row_id", _r("country_cap_zscore"))


@register(
    "basic_features",
    with_assets(
        """, m AS (SELECT quantile_cont(capacity_mw, 0.5) AS med FROM assets)
SELECT row_id, latitude, longitude, round(coalesce(capacity_mw, med), 6) AS capacity_filled FROM assets, m"""
    ),
)
def q_basic_features(spark, sf):
    return FE.basic_features(load_assets(spark, sf)).select("row_id", "latitude", "longitude", _r("capacity_filled"))


@register(
    "standard_scale",
    with_assets(
        """, st AS (SELECT country, AVG(capacity_mw) AS mu, STDDEV_POP(capacity_mw) AS sd, AVG(latitude) AS mu2,
                 STDDEV_POP(latitude) AS sd2 FROM assets GROUP BY country)
SELECT row_id, round((capacity_mw - mu) / CASE WHEN sd = 0 OR sd IS NULL THEN 1 ELSE sd END, 6) AS capacity_mw_scaled,
       round((latitude - mu2) / CASE WHEN sd2 = 0 OR sd2 IS NULL THEN 1 ELSE sd2 END, 6) AS latitude_scaled
FROM assets a LEFT JOIN st ON a.country = st.country"""
    ),
)
def q_standard_scale(spark, sf):
    s = FE.standard_scale(load_assets(spark, sf), ["capacity_mw", "latitude"], keys=["country"])
    return s.select("row_id", _r("capacity_mw_scaled"), _r("latitude_scaled"))


@register(
    "country_eligibility",
    SUPPLIER_ASSETS_SQL + "SELECT country, COUNT(*) AS n_rows, COUNT(*) >= 10 AS eligible FROM sup GROUP BY country",
)
def q_country_eligibility(spark, sf):
    return SC.country_eligibility(load_supplier_assets(spark, sf))


@register(
    "contamination_threshold",
    with_assets(
        "SELECT country, round(quantile_cont(capacity_mw, 0.08), 6) AS threshold FROM assets "
        "WHERE capacity_mw IS NOT NULL GROUP BY country"
    ),
)
def q_contamination_threshold(spark, sf):
    q = exact_quantile(load_assets(spark, sf), "capacity_mw", 0.08, ["country"], "threshold")
    return q.select("country", _r("threshold"))


@register(
    "exact_median_ranked",
    with_assets(
        "SELECT country, round(quantile_cont(capacity_mw, 0.5), 6) AS median FROM assets "
        "WHERE capacity_mw IS NOT NULL GROUP BY country"
    ),
)
def q_exact_median_ranked(spark, sf):
    # a second quantile of the one range-partitioned path
    q = exact_quantile(load_assets(spark, sf), "capacity_mw", 0.5, ["country"], "median")
    return q.select("country", _r("median"))


STANDIN_SQL = """
, s AS (SELECT row_id, country, latitude, longitude, capacity_mw,
    round(CAST((row_id * 7919) % 1000 AS DOUBLE) / 2000 - 0.1, 4) AS global_score,
    CASE WHEN row_id % 10 = 0 THEN NULL ELSE round(CAST((row_id * 104729) % 1000 AS DOUBLE) / 2000 - 0.1, 4) END AS country_score
  FROM assets),
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


def standin_scores(spark, sf):
    """Assets with deterministic stand-in model scores (for the SQL-checkable consumers)."""
    a = load_assets(spark, sf)
    g = F.round((F.col("row_id") * 7919 % 1000).cast("double") / 2000 - 0.1, 4)
    c = F.when(F.col("row_id") % 10 == 0, F.lit(None).cast("double")).otherwise(
        F.round((F.col("row_id") * 104729 % 1000).cast("double") / 2000 - 0.1, 4)
    )
    return a.withColumns({"global_score": g, "country_score": c}).withColumns(
        {
            "global_anomaly": F.col("global_score") < 0,
            "country_anomaly": F.coalesce(F.col("country_score") < 0, F.lit(False)),
            "model_used": F.when(F.col("country_score").isNull(), F.lit("global_fallback")).otherwise(F.lit("country")),
        }
    )


def standin_final(spark, sf):
    return SC.compute_final_score(standin_scores(spark, sf))


@register("final_score", with_assets(STANDIN_SQL + "SELECT row_id, ANOMALY_SCORE, IS_ANOMALY FROM scored"))
def q_final_score(spark, sf):
    return standin_final(spark, sf).select("row_id", "ANOMALY_SCORE", "IS_ANOMALY")


@register(
    "invert_minmax",
    with_assets(
        """, s AS (SELECT row_id, CASE WHEN row_id % 10 = 0 THEN NULL
                 ELSE round(CAST((row_id * 104729) % 1000 AS DOUBLE) / 2000 - 0.1, 4) END AS country_score FROM assets),
m AS (SELECT quantile_cont(country_score, 0.5) AS med FROM s),
i AS (SELECT row_id, -coalesce(country_score, med) AS inv FROM s, m),
mm AS (SELECT min(inv) AS mn, max(inv) AS mx FROM i)
SELECT row_id, round((inv - mn) / (mx - mn + 1e-9), 6) AS country_norm FROM i, mm"""
    ),
)
def q_invert_minmax(spark, sf):
    s = standin_scores(spark, sf).select("row_id", "country_score")
    return SC.invert_minmax(s, {"country_score": "country_norm"}).select("row_id", _r("country_norm"))


# --- a fixed two-tree forest over (latitude, longitude); psi = 256 -----------------------------
_C = FO.c_factor
FIXED_NODES = pd.DataFrame(
    {
        "model_key": ["fixed"] * 8,
        "tree_id": [0, 0, 0, 0, 0, 1, 1, 1],
        "node_id": [0, 1, 2, 3, 4, 0, 1, 2],
        "left": [1, -1, 3, -1, -1, 1, -1, -1],
        "right": [2, -1, 4, -1, -1, 2, -1, -1],
        "feature": [0, -1, 1, -1, -1, 1, -1, -1],
        "threshold": [0.0, 0.0, 0.0, 0.0, 0.0, 50.0, 0.0, 0.0],
        "path_len": [0.0, 1 + float(_C(100)), 0.0, 2.0, 2 + float(_C(5)), 0.0, 1 + float(_C(30)), 2.0],
    }
)


def _fixed_sql() -> str:
    p0 = f"CASE WHEN latitude <= 0 THEN {1 + float(_C(100))!r} WHEN longitude <= 0 THEN 2.0 ELSE {2 + float(_C(5))!r} END"
    p1 = f"CASE WHEN longitude <= 50 THEN {1 + float(_C(30))!r} ELSE 2.0 END"
    c256 = repr(float(_C(256)))
    return with_assets(f"SELECT row_id, round(-power(2.0, -(({p0}) + ({p1})) / 2 / {c256}), 6) AS fixed_score FROM assets")


FIXED_SQL = _fixed_sql()


@register("score_fixed_forest", FIXED_SQL)
def q_score_fixed_forest(spark, sf):
    a = load_assets(spark, sf).select("row_id", "latitude", "longitude")
    s = FO.score_single(a, FIXED_NODES, 256, ["latitude", "longitude"], out="fixed_score")
    return s.select("row_id", _r("fixed_score"))


def _per_country_sql() -> str:
    """Even countries use the fixed forest, odd ones its first tree alone; unknown ones have none."""
    p0 = f"CASE WHEN latitude <= 0 THEN {1 + float(_C(100))!r} WHEN longitude <= 0 THEN 2.0 ELSE {2 + float(_C(5))!r} END"
    p1 = f"CASE WHEN longitude <= 50 THEN {1 + float(_C(30))!r} ELSE 2.0 END"
    c256 = repr(float(_C(256)))
    return with_assets(
        f""", n AS (SELECT *, CASE WHEN country = 'XX' THEN NULL ELSE CAST(substr(country, 2) AS INTEGER) % 2 END AS odd FROM assets)
SELECT row_id, 9007199254740993 + row_id AS big, round(CASE odd WHEN 0 THEN -power(2.0, -(({p0}) + ({p1})) / 2 / {c256})
  WHEN 1 THEN -power(2.0, -({p0}) / {c256}) END, 6) AS fixed_score FROM n"""
    )


@register("score_fixed_per_country", _per_country_sql())
def q_score_fixed_per_country(spark, sf):
    """M7's scorer, salted cogroup included, on a fixed forest per country; ``big`` stays outside Python."""
    a = load_assets(spark, sf).withColumn("big", F.col("row_id") + F.lit(9007199254740993))
    sizes = a.where("country <> 'XX'").groupBy(F.col("country").alias("model_key")).agg(F.count(F.lit(1)).alias("n_train")).withColumn("psi", F.lit(256))
    fixed = spark.createDataFrame(FIXED_NODES.drop(columns="model_key"))
    nodes = sizes.select("model_key", (F.substring("model_key", 2, 2).cast("int") % 2).alias("_odd")).join(fixed, (F.col("_odd") == 0) | (F.col("tree_id") == 0)).drop("_odd")
    scored = FO.score_per_key(a, nodes, sizes, "country", ["latitude", "longitude"], out="fixed_score", rows_per_task=100)
    return scored.select("row_id", "big", _r("fixed_score"))


# --- forests: drawn, grown and walked from md5 counters, which SQL replays ----------------------
_MODELS_SQL = "c AS (SELECT country, count(*) AS n FROM assets WHERE country IS NOT NULL GROUP BY country HAVING count(*) >= 10)"
_GLOBAL_SQL = with_assets(FEATURES_SQL + forest_sql("g", "feat", None, list(FE.GLOBAL_FEATURES), 300, 42))
_COUNTRY_SQL = forest_sql("c", "feat", "country", list(FE.COUNTRY_FEATURES), 100, 42, min_rows=10)
_COUNTRY_COLUMNS = """round(c.decision, 4) AS country_score, coalesce(c.decision < 0, false) AS country_anomaly,
  CASE WHEN c.row_id IS NULL THEN 'global_fallback' ELSE 'country' END AS model_used"""
#: Two trees of one table overlap by chance alone: id sums tell the rows drawn.
_SAMPLE_COLUMNS = """CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(row_id) AS BIGINT) AS id_sum"""


@register(
    "forest_subsample",
    with_assets(
        forest_sql("c", "assets", "country", ["latitude"], 100, 42, min_rows=10)
        + f" SELECT model_key, t AS tree_id, {_SAMPLE_COLUMNS}, any_value(psi) AS psi FROM c_sample GROUP BY model_key, t"
    ),
)
def q_forest_subsample(spark, sf):
    """M1: the rows that every tree of every country draws."""
    a = load_assets(spark, sf)
    sizes = FO.model_sizes(a, "country", 10)
    s = FO.subsample(a.select("row_id", "country"), sizes, "country", 100, 42)
    return s.groupBy("model_key", "tree_id").agg(F.count_distinct("row_id").alias("n_rows"), F.sum("row_id").alias("id_sum"), F.first("psi").alias("psi"))


@register(
    "forest_growth",
    with_assets(
        f""", {_MODELS_SQL} SELECT country AS model_key, CAST(t AS INTEGER) AS tree_id, CAST(least(256, n) AS INTEGER) AS psi, n AS n_train,
  true AS full_binary, true AS depth_bounded, true AS has_offset FROM c, range(100) r(t)"""
    ),
)
def q_forest_growth(spark, sf):
    """M2, M4, M7: every tree of every country's forest, what it was grown on, and its shape."""
    model, _ = SC.train_and_score_per_country(featured(spark, sf))
    leaf = F.col("feature") < 0
    per_tree = model.nodes.groupBy("model_key", "tree_id").agg(F.count_if(leaf).alias("leaves"), F.count_if(~leaf).alias("inner"))
    joined = per_tree.join(model.offsets, "model_key")
    return joined.select(
        "model_key", "tree_id", "psi", "n_train", (F.col("leaves") == F.col("inner") + 1).alias("full_binary"),
        (F.col("leaves") <= F.least("psi", F.pow(F.lit(2), F.ceil(F.log2("psi"))))).alias("depth_bounded"), F.col("offset").isNotNull().alias("has_offset"),
    )


@register(
    "ml_run_invariants",
    with_assets(
        """, c AS (SELECT country, count(*) AS n FROM assets GROUP BY country)
SELECT a.row_id, a.capacity_mw, CASE WHEN c.country IS NOT NULL AND c.n >= 10 THEN 'country' ELSE 'global_fallback' END AS model_used,
  true AS scored, true AS flagged_by_rule FROM assets a LEFT JOIN c ON a.country IS NOT DISTINCT FROM c.country"""
    ),
)
def q_ml_run_invariants(spark, sf):
    """Every row has scores in range, its model, and a flag that follows from them."""
    out = SC.run_ml_anomaly_detection(load_assets(spark, sf))
    ranged = F.col("ANOMALY_SCORE").between(0, 1) & F.col("global_score").between(-1, 1) & (F.col("country_score").isNotNull() == (F.col("model_used") == "country"))
    rule = (F.col("ANOMALY_SCORE") > SC.SCORE_THRESHOLD) | F.col("global_anomaly") | F.col("country_anomaly")
    return out.select("row_id", "capacity_mw", "model_used", F.coalesce(ranged, F.lit(False)).alias("scored"), (F.col("IS_ANOMALY") == rule).alias("flagged_by_rule"))


def featured(spark, sf, supplier: bool = False):
    """Engineered features, materialised once (every forest makes several passes over them)."""
    src = load_supplier_assets(spark, sf) if supplier else load_assets(spark, sf)
    return cut_lineage(FE.engineer_features(src))


@register(
    "forest_nodes",
    _GLOBAL_SQL + 'SELECT model_key, tree_id, node_id, "left", "right", feature, round(threshold, 6) AS threshold, round(path_len, 6) AS path_len FROM g_nodes',
)
def q_forest_nodes(spark, sf):
    f = FE.fill_zero(featured(spark, sf), FE.GLOBAL_FEATURES)
    sample = FO.subsample(f, FO.model_sizes(f, None), None, 300, 42)
    nodes = FO.grow_forest(sample, FE.GLOBAL_FEATURES, 42)
    return nodes.withColumns({"threshold": _r("threshold"), "path_len": _r("path_len")})


@register(
    "score_basic",
    with_assets(
        ", m AS (SELECT quantile_cont(capacity_mw, 0.5) AS med FROM assets), basic AS (SELECT *, coalesce(capacity_mw, med) AS capacity_filled FROM assets, m)"
        + forest_sql("b", "basic", None, ["latitude", "longitude", "capacity_filled"], 200, 42)
        + "SELECT row_id, round(decision, 4) AS anomaly_score, decision < 0 AS is_anomaly FROM b_decided"
    ),
)
def q_score_basic(spark, sf):
    _, scored = SC.train_isolation_forest(load_assets(spark, sf), 0.08, 200, 42)
    return scored.select("row_id", "anomaly_score", "is_anomaly")


@register(
    "train_global",
    _GLOBAL_SQL
    + """SELECT model_key, tree_id, count(*) AS n_nodes, count(*) FILTER (feature < 0) AS n_leaves, round(max(path_len), 6) AS max_path_len,
  any_value(psi) AS psi, any_value(n_train) AS n_train, round(any_value("offset"), 6) AS "offset"
FROM g_nodes JOIN g_offsets USING (model_key) GROUP BY model_key, tree_id""",
)
def q_train_global(spark, sf):
    """M4: the fitted global forest summarised per tree (nodes, leaves, depth bound) with its offset."""
    model, _ = SC.train_global_model(featured(spark, sf))
    per_tree = model.nodes.groupBy("model_key", "tree_id").agg(
        F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("feature") < 0).alias("n_leaves"),
        F.round(F.max("path_len"), 6).alias("max_path_len"),
    )
    return per_tree.join(model.offsets.select("model_key", "psi", "n_train", _r("offset")), "model_key")


@register("score_global", _GLOBAL_SQL + "SELECT row_id, round(decision, 4) AS global_score, decision < 0 AS global_anomaly FROM g_decided")
def q_score_global(spark, sf):
    _, g = SC.train_global_model(featured(spark, sf))
    return g.select("row_id", "global_score", "global_anomaly")


@register("score_per_country", with_assets(FEATURES_SQL + _COUNTRY_SQL + f"SELECT f.row_id, f.country, {_COUNTRY_COLUMNS} FROM feat f LEFT JOIN c_decided c USING (row_id)"))
def q_score_per_country(spark, sf):
    _, c = SC.train_and_score_per_country(featured(spark, sf))
    return c.select("row_id", "country", "country_score", "country_anomaly", "model_used")


@register(
    "score_per_country_suppliers",
    SUPPLIER_ASSETS_SQL
    + FEATURES_SQL.replace("FROM assets", "FROM sup")
    + _COUNTRY_SQL
    + f"SELECT f.row_id, f.country, {_COUNTRY_COLUMNS} FROM feat f LEFT JOIN c_decided c USING (row_id)",
)
def q_score_per_country_suppliers(spark, sf):
    _, c = SC.train_and_score_per_country(featured(spark, sf, supplier=True))
    return c.select("row_id", "country", "country_score", "country_anomaly", "model_used")


_RUN_SQL = (
    _GLOBAL_SQL
    + _COUNTRY_SQL
    + f""", two AS (SELECT g.row_id, round(g.decision, 4) AS global_score, g.decision < 0 AS global_anomaly, {_COUNTRY_COLUMNS}
  FROM g_decided g LEFT JOIN c_decided c USING (row_id)),
blend AS (SELECT *, -global_score AS gi, -coalesce(country_score, global_score) AS ci FROM two),
mm AS (SELECT min(gi) AS gmn, max(gi) AS gmx, min(ci) AS cmn, max(ci) AS cmx FROM blend),
fin AS (SELECT blend.*, round(0.4 * ((gi - gmn) / (gmx - gmn + 1e-9)) + 0.6 * ((ci - cmn) / (cmx - cmn + 1e-9)), 4) AS ANOMALY_SCORE FROM blend, mm)
SELECT row_id, global_score, global_anomaly, country_score, country_anomaly, model_used, ANOMALY_SCORE,
  ANOMALY_SCORE > 0.6 OR global_anomaly OR country_anomaly AS IS_ANOMALY FROM fin"""
)
_RUN_COLUMNS = ("row_id", "global_score", "global_anomaly", "country_score", "country_anomaly", "model_used", "ANOMALY_SCORE", "IS_ANOMALY")


@register("ml_anomaly_run", _RUN_SQL)
def q_ml_anomaly_run(spark, sf):
    return SC.run_ml_anomaly_detection(load_assets(spark, sf)).select(*_RUN_COLUMNS)


@register("saved_bundle_scores", _RUN_SQL)
def q_saved_bundle_scores(spark, sf):
    """The two-layer model fitted, written, read back and applied."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundle-{uuid.uuid4().hex}"
    a = load_assets(spark, sf)
    fit_bundle(a)[0].save(path)
    return AnomalyBundle.load(spark, path).score(a).select(*_RUN_COLUMNS)


@register(
    "scored_output_projection",
    with_assets(
        STANDIN_SQL
        + """SELECT s.gppd_idnr, s.name, x.country, s.primary_fuel, x.latitude, x.longitude, x.capacity_mw, ANOMALY_SCORE, IS_ANOMALY,
  global_score, country_score, model_used FROM scored x JOIN assets s USING (row_id)"""
    ),
)
def q_scored_output_projection(spark, sf):
    """S9 on the stand-in scores: the wanted columns that exist, in order."""
    from terracheck.sources.assets import project_existing

    return project_existing(standin_final(spark, sf), SC.SCORED_OUTPUT_COLUMNS)
