"""Blending and the two-layer anomaly run.

Scores are normalised with one-row aggregates (median, min, max) broadcast back
to the rows; the forests come from :mod:`terracheck.operators.forest`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.operators import forest as FO
from terracheck.operators.features import COUNTRY_FEATURES, GLOBAL_FEATURES, basic_features
from terracheck.operators.quantiles import exact_quantiles

MIN_COUNTRY_ASSETS = 10
SCORE_THRESHOLD = 0.60
GLOBAL_WEIGHT = 0.4
COUNTRY_WEIGHT = 0.6
EPS = 1e-9


def country_eligibility(df: DataFrame, cols: AssetCols = DEFAULT_COLS, min_rows: int = MIN_COUNTRY_ASSETS) -> DataFrame:
    """M6: rows per (non-null) country and whether a country model is trained for it."""
    return (
        df.where(F.col(cols.country).isNotNull())
        .groupBy(cols.country)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("eligible", F.col("n_rows") >= min_rows)
    )


def minmax_stats(df: DataFrame, columns) -> dict[str, tuple]:
    """(minimum, exact median, maximum) of each column without its NULLs, from the same scans."""
    columns = list(columns)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("double").alias("_value")) for c in columns]))
    each = exact_quantiles(df.select(pairs.alias("_p")).select("_p.*"), ["_name"], "_value", [0.0, 0.5, 1.0]).collect()  # a row per column
    return {c: (None, None, None) for c in columns} | {r["_name"]: (r["q0"], r["q1"], r["q2"]) for r in each}


def invert_minmax(df: DataFrame, columns: dict[str, str], stats: dict[str, tuple] | None = None) -> DataFrame:
    """M10 for several columns at once: fill NULL with the column median, negate, then
    (x - min) / (max - min + 1e-9).  ``columns`` maps input column -> output column.

    The median lies between the bounds, so filling with it leaves them as they are. The statistics
    are read first (one row per column) unless ``stats`` has them; the result is a projection of
    ``df``."""
    out = {}
    for c, (low, median, high) in (minmax_stats(df, columns) if stats is None else stats).items():
        low, median, high = (F.lit(x).cast("double") for x in (low, median, high))
        out[columns[c]] = (-F.coalesce(F.col(c), median) + high) / (-low + high + F.lit(EPS))
    return df.withColumns(out)


BLENDED = {"global_score": "_gn", "_country_or_global": "_cn"}


def with_blend_input(df: DataFrame) -> DataFrame:
    return df.withColumn("_country_or_global", F.coalesce(F.col("country_score"), F.col("global_score")))


def compute_final_score(df: DataFrame, stats: dict[str, tuple] | None = None) -> DataFrame:
    """ANOMALY_SCORE = round(0.4 norm(global) + 0.6 norm(country else global), 4);
    IS_ANOMALY = score > 0.60 or either model flags the row.  ``stats``, the
    :func:`minmax_stats` of another table, keeps its scale."""
    x = invert_minmax(with_blend_input(df), BLENDED, stats)
    score = F.round(GLOBAL_WEIGHT * F.col("_gn") + COUNTRY_WEIGHT * F.col("_cn"), 4)
    return (
        x.withColumn("ANOMALY_SCORE", score)
        .withColumn(
            "IS_ANOMALY",
            (F.col("ANOMALY_SCORE") > SCORE_THRESHOLD)
            | F.coalesce(F.col("global_anomaly"), F.lit(False))
            | F.coalesce(F.col("country_anomaly"), F.lit(False)),
        )
        .drop("_gn", "_cn", "_country_or_global")
    )


def _filled(df: DataFrame, features) -> tuple[DataFrame, list[str]]:
    names = [f"_x_{f}" for f in features]
    return df.withColumns({n: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for n, f in zip(names, features)}), names


def train_isolation_forest(df: DataFrame, contamination=0.08, n_estimators=200, random_state=42, cols: AssetCols = DEFAULT_COLS):
    """M2: single forest on latitude, longitude and median-filled capacity.
    Returns ``(model, scored)`` with ``anomaly_score`` (decision, round 4) and ``is_anomaly``."""
    x = basic_features(df, cols)
    feats = [cols.lat, cols.lon, "capacity_filled"]
    x, names = _filled(x, feats)
    model, scored = FO.fit_forest(x, names, None, n_estimators, contamination, random_state, row_id=cols.row_id)
    return model, _label_basic(scored, names)


def _label_basic(scored: DataFrame, names) -> DataFrame:
    return (
        scored.withColumn("anomaly_score", F.round("_decision", 4))
        .withColumn("is_anomaly", F.col("_decision") < 0)
        .drop("_raw", "_decision", "capacity_filled", *names)
    )


def score_anomalies(df: DataFrame, model: FO.ForestModel, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """M3: score (new) rows with a fitted or loaded basic model."""
    x = basic_features(df, cols)
    x, names = _filled(x, [cols.lat, cols.lon, "capacity_filled"])
    return _label_basic(FO.score_forest(x, model, cols.row_id), names)


def train_global_model(featured: DataFrame, contamination=0.08, random_state=42, n_trees=300, row_id="row_id"):
    """M4 + M5: 300 trees on the five global features; adds global_score / global_anomaly."""
    x, names = _filled(featured, GLOBAL_FEATURES)
    model, scored = FO.fit_forest(x, names, None, n_trees, contamination, random_state, row_id=row_id)
    return model, _label_global(scored, names)


def _label_global(scored: DataFrame, names) -> DataFrame:
    return (
        scored.withColumn("global_score", F.round("_decision", 4))
        .withColumn("global_anomaly", F.col("_decision") < 0)
        .drop("_raw", "_decision", *names)
    )


def score_global(featured: DataFrame, model: FO.ForestModel, row_id="row_id") -> DataFrame:
    """M5: new rows under a fitted or loaded global model."""
    x, names = _filled(featured, GLOBAL_FEATURES)
    return _label_global(FO.score_forest(x, model, row_id), names)


def train_and_score_per_country(
    df: DataFrame, contamination=0.08, random_state=42, n_trees=100, cols: AssetCols = DEFAULT_COLS,
    min_rows: int = MIN_COUNTRY_ASSETS,
):
    """M7: one 100-tree forest per country with >= 10 rows on four features, own offset per
    country; other rows fall back (country_score NULL, country_anomaly false)."""
    x, names = _filled(df, COUNTRY_FEATURES)
    model, scored = FO.fit_forest(x, names, cols.country, n_trees, contamination, random_state, min_rows=min_rows,
                                  row_id=cols.row_id)
    return model, _label_country(scored, names)


def score_per_country(featured: DataFrame, model: FO.ForestModel, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """M7's scores of new rows under fitted or loaded country models."""
    x, names = _filled(featured, COUNTRY_FEATURES)
    return _label_country(FO.score_forest(x, model, cols.row_id), names)


def _label_country(scored: DataFrame, names) -> DataFrame:
    raw = F.nullif(F.col("_raw"), F.lit(float("nan")))
    return (
        scored.withColumn("country_score", F.when(raw.isNotNull(), F.round("_decision", 4)))
        .withColumn("country_anomaly", F.coalesce(raw.isNotNull() & (F.col("_decision") < 0), F.lit(False)))
        .withColumn("model_used", F.when(raw.isNotNull(), F.lit("country")).otherwise(F.lit("global_fallback")))
        .drop("_raw", "_decision", *names)
    )


def run_ml_anomaly_detection(df: DataFrame, contamination=0.08, random_state=42, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """Features -> global forest -> per-country forests -> blended score; rows unchanged."""
    from terracheck.operators.bundle import fit_bundle

    return fit_bundle(df, contamination, random_state, cols)[1]


SCORED_OUTPUT_COLUMNS = (
    "gppd_idnr", "name", "country", "primary_fuel", "latitude", "longitude", "capacity_mw",
    "ANOMALY_SCORE", "IS_ANOMALY", "global_score", "country_score", "model_used",
    "cap_log", "country_cap_zscore", "error_flags",
)
