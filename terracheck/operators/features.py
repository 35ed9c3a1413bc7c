"""Feature engineering for the anomaly layers (F1-F8).

Group statistics are aggregates joined back on the group key (AQE turns the
join into a broadcast at runtime since there is one row per country; a hot
country is split by AQE's skew join otherwise).  Medians are exact
(:func:`exact_quantile`).  No window over rows, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.operators.quantiles import exact_quantile, quantile_by_and_overall
from terracheck.session import attach_row, cut_lineage

GLOBAL_FEATURES = ("latitude", "longitude", "cap_log", "lat_lon_ratio", "country_cap_zscore")
COUNTRY_FEATURES = ("latitude", "longitude", "cap_log", "country_cap_zscore")
BASIC_FEATURES = ("latitude", "longitude", "capacity_mw")


def cap_filled(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """adds ``country_cap_median`` and ``cap_filled`` = capacity, else country median, else global
    median. A NaN capacity counts as missing."""
    by_country, overall = quantile_by_and_overall(df, cols.capacity, 0.5, cols.country)
    by_country, overall = by_country.withColumnRenamed("quantile", "country_cap_median"), overall.withColumnRenamed("quantile", "_global_median")
    joined = attach_row(df.join(by_country, cols.country, "left"), overall)
    known = F.nullif(F.col(cols.capacity), F.lit(float("nan")))
    return joined.withColumn("cap_filled", F.coalesce(known, F.col("country_cap_median"), F.col("_global_median"))).drop("_global_median")


def add_cap_log(df: DataFrame) -> DataFrame:
    """log1p(cap_filled); NULL at or below -1."""
    return df.withColumn("cap_log", F.log1p("cap_filled"))


def add_lat_lon_ratio(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """lat / (|lon| + 1e-6)."""
    return df.withColumn("lat_lon_ratio", F.col(cols.lat) / (F.abs(F.col(cols.lon)) + F.lit(1e-6)))


def _zscore(cols: AssetCols) -> Column:
    # NaN sorts above every number in Spark, so "std > 0" alone would pass a NaN std (an infinite
    # capacity in the group); like pandas, such a group gets z = 0.
    ok = F.col(cols.country).isNotNull() & (F.col("_std") > 0) & ~F.isnan("_std")
    return F.coalesce(F.when(ok, (F.col("cap_filled") - F.col("_mean")) / F.col("_std")), F.lit(0.0))


def add_country_zscore(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """(cap_filled - country mean) / country sample std; 0 when std is 0 or undefined
    (one row) and for rows without a country."""
    stats = df.groupBy(cols.country).agg(F.avg("cap_filled").alias("_mean"), F.stddev_samp("cap_filled").alias("_std"))
    return df.join(stats, cols.country, "left").withColumn("country_cap_zscore", _zscore(cols)).drop("_mean", "_std")


@dataclass(frozen=True)
class FeatureStatistics:
    """What the features of a row need to know of the table: per country ``(country,
    country_cap_median, _mean, _std)``, and the overall median (None without any capacity)."""

    countries: DataFrame
    overall_median: float | None


def feature_statistics(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> FeatureStatistics:
    """The statistics of ``df``; the table of countries is stored."""
    medians, overall = quantile_by_and_overall(df, cols.capacity, 0.5, cols.country)
    medians, overall = medians.withColumnRenamed("quantile", "country_cap_median"), overall.first()["quantile"]
    filled = _with_cap_filled(df.select(cols.country, cols.capacity), medians, overall, cols)
    spread = filled.where(F.col(cols.country).isNotNull()).groupBy(cols.country).agg(F.avg("cap_filled").alias("_mean"), F.stddev_samp("cap_filled").alias("_std"))
    return FeatureStatistics(cut_lineage(spread.join(medians, cols.country, "left").select(cols.country, "country_cap_median", "_mean", "_std")), overall)


def _with_cap_filled(df: DataFrame, medians: DataFrame, overall: float | None, cols: AssetCols) -> DataFrame:
    known = F.nullif(F.col(cols.capacity), F.lit(float("nan")))
    filled = F.coalesce(known, F.col("country_cap_median"), F.lit(overall).cast("double"))
    return df.join(medians, cols.country, "left").withColumn("cap_filled", filled)


def with_features(df: DataFrame, stats: FeatureStatistics, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """F1-F4 of every row from statistics that are known already, of this table or of another: one
    join with a table of countries, no aggregate."""
    out = _with_cap_filled(df, stats.countries, stats.overall_median, cols)
    out = add_lat_lon_ratio(add_cap_log(out), cols)
    return out.withColumn("country_cap_zscore", _zscore(cols)).drop("_mean", "_std")


def engineer_features(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """F1-F4; the row count is unchanged."""
    return with_features(df, feature_statistics(df, cols), cols)


def basic_features(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """lat, lon and capacity with missing capacity filled by the table median."""
    med = exact_quantile(df, cols.capacity, 0.5, [], "_median")
    known = F.nullif(F.col(cols.capacity), F.lit(float("nan")))
    out = attach_row(df, med).withColumn("capacity_filled", F.coalesce(known, F.col("_median")))
    return out.drop("_median")


def fill_zero(df: DataFrame, features) -> DataFrame:
    """NULL -> 0 in the feature columns (forest input)."""
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})


def standard_scale(df: DataFrame, features, keys=(), suffix: str = "_scaled") -> DataFrame:
    """F8: (x - mean) / population std, std 0 -> 1, over the table or per key."""
    keys = list(keys)
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"_m_{f}"), F.stddev_pop(f).alias(f"_s_{f}")]
    stats = (df.groupBy(*keys) if keys else df.groupBy()).agg(*aggs)
    joined = df.join(stats, keys, "left") if keys else attach_row(df, stats)
    scaled = {}
    for f in features:
        s = F.col(f"_s_{f}")
        scaled[f + suffix] = (F.col(f) - F.col(f"_m_{f}")) / F.when((s == 0) | s.isNull(), F.lit(1.0)).otherwise(s)
    return joined.withColumns(scaled).drop(*[c for f in features for c in (f"_m_{f}", f"_s_{f}")])
