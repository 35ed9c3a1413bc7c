"""Run summary, recall against planted errors, model coverage and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.session import attach_row

TOP_COLUMNS = ("row_id", "gppd_idnr", "country", "latitude", "longitude", "capacity_mw", "ANOMALY_SCORE", "IS_ANOMALY")


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """Total, clean, anomalous, their shares (%) and the mean score, in one aggregate."""
    total = F.count(F.lit(1))
    anom = F.count_if(F.col("IS_ANOMALY"))
    return scored.agg(
        total.alias("total"),
        (total - anom).alias("clean"),
        anom.alias("anomalous"),
        F.round(F.when(total > 0, 100 * (total - anom) / total), 6).alias("pct_clean"),
        F.round(F.when(total > 0, 100 * anom / total), 6).alias("pct_anomalous"),
        F.round(F.avg("ANOMALY_SCORE"), 6).alias("avg_score"),
    )


def detection_recall(scored: DataFrame, flags: str = "error_flags") -> DataFrame:
    """R2: flagged-and-known over known (error_flags not empty); 0 when nothing is known.
    NULL flags count as not known.  Without the flags column every figure is NULL."""
    if flags not in scored.columns:
        return scored.sparkSession.createDataFrame([(None, None, None)], "known bigint, caught bigint, recall double")
    known = F.coalesce(F.length(F.col(flags)) > 0, F.lit(False))
    n_known = F.count_if(known)
    n_caught = F.count_if(known & F.col("IS_ANOMALY"))
    return scored.agg(
        n_known.alias("known"),
        n_caught.alias("caught"),
        F.round(F.when(n_known > 0, n_caught / n_known).otherwise(F.lit(0.0)), 6).alias("recall"),
    )


def recall_by_error_type(scored: DataFrame, flags: str = "error_flags") -> DataFrame:
    """R2 per planted error type (a row with two flags counts once for each)."""
    kinds = scored.where(F.coalesce(F.length(F.col(flags)) > 0, F.lit(False))).select(
        F.explode(F.split(F.col(flags), r"\|")).alias("error_type"), "IS_ANOMALY"
    )
    return kinds.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("known"),
        F.count_if("IS_ANOMALY").alias("caught"),
        F.round(F.count_if("IS_ANOMALY") / F.count(F.lit(1)), 6).alias("recall"),
    )


def model_coverage(scored: DataFrame) -> DataFrame:
    """Rows and share (%) per model_used, largest first."""
    counts = scored.groupBy("model_used").agg(F.count(F.lit(1)).alias("count"))
    total = scored.agg(F.count(F.lit(1)).alias("_total"))
    out = attach_row(counts, total).select("model_used", "count", F.round(100 * F.col("count") / F.col("_total"), 6).alias("pct"))
    return out.orderBy(F.desc("count"), "model_used")


def top_anomalies(scored: DataFrame, k: int = 5) -> DataFrame:
    """The k highest ANOMALY_SCORE rows (ties by row_id), bounded top-k."""
    cols = [c for c in TOP_COLUMNS if c in scored.columns]
    return scored.select(*cols).orderBy(F.desc("ANOMALY_SCORE"), "row_id").limit(k)
