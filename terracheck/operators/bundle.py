"""The two-layer anomaly model as one versioned set of tables.

A bundle holds all that a row's final score depends on besides the row: the feature statistics
(country medians, means and deviations, the overall median), both forests with their offsets, and
the bounds that scale the two scores.  ``save`` writes the tables of a new version and then its line
in the manifest; a version without a line was never finished and is not seen.  ``score`` joins new
rows with the stored tables, so a row's score does not depend on the rows around it: a batch, a
stream's micro-batch and the training table give the same."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.operators import scoring as SC
from terracheck.operators.features import GLOBAL_FEATURES, FeatureStatistics, feature_statistics, with_features
from terracheck.operators.forest import ForestModel
from terracheck.session import cut_lineage

_BOUNDS = "name string, low double, median double, high double"
_MANIFEST = "version long, overall_median double"


@dataclass
class AnomalyBundle:
    statistics: FeatureStatistics
    everywhere: ForestModel
    by_country: ForestModel
    bounds: dict[str, tuple]

    def score(self, df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
        """``df`` with features, scores and flags; rows of a country without a model fall back."""
        featured = with_features(df, self.statistics, cols)
        narrow = featured.select(cols.row_id, cols.country, *GLOBAL_FEATURES)
        layers = _both_layers(SC.score_global(narrow, self.everywhere, cols.row_id), SC.score_per_country(narrow, self.by_country, cols), cols)
        return featured.join(SC.compute_final_score(layers, self.bounds), cols.row_id, "left")

    def save(self, path: str) -> int:
        """Write the next version under ``path``; its number."""
        spark = self.statistics.countries.sparkSession
        version = (_latest(spark, path) or (0, None))[0] + 1
        root = f"{path}/v{version}"
        self.statistics.countries.write.mode("overwrite").parquet(f"{root}/countries")
        self.everywhere.save(f"{root}/everywhere")
        self.by_country.save(f"{root}/by_country")
        spark.createDataFrame([(k, *v) for k, v in self.bounds.items()], _BOUNDS).coalesce(1).write.mode("overwrite").parquet(f"{root}/bounds")
        line = spark.createDataFrame([(version, self.statistics.overall_median)], _MANIFEST)
        line.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
        return version

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> AnomalyBundle:
        """The latest finished version, or the one asked for."""
        found = _latest(spark, path, version)
        if found is None:
            raise FileNotFoundError(f"No saved bundle{'' if version is None else f' of version {version}'} at {path}; fit one first.")
        number, overall = found
        root = f"{path}/v{number}"
        bounds = {r["name"]: (r["low"], r["median"], r["high"]) for r in spark.read.parquet(f"{root}/bounds").collect()}  # two rows
        statistics = FeatureStatistics(spark.read.parquet(f"{root}/countries"), overall)
        return AnomalyBundle(statistics, ForestModel.load(spark, f"{root}/everywhere"), ForestModel.load(spark, f"{root}/by_country"), bounds)


def _latest(spark: SparkSession, path: str, version: int | None = None) -> tuple | None:
    try:
        lines = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except Exception as error:  # AnalysisException: no version was ever finished
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    if version is not None:
        lines = lines.where(F.col("version") == version)
    last = lines.orderBy(F.desc("version")).first()
    return last and tuple(last)


def _both_layers(everywhere: DataFrame, by_country: DataFrame, cols: AssetCols) -> DataFrame:
    theirs = by_country.select(cols.row_id, "country_score", "country_anomaly", "model_used")
    return everywhere.select(cols.row_id, "global_score", "global_anomaly").join(theirs, cols.row_id)


def fit_bundle(df: DataFrame, contamination=0.08, random_state=42, cols: AssetCols = DEFAULT_COLS) -> tuple[AnomalyBundle, DataFrame]:
    """The bundle of ``df`` and ``df`` with features, scores and flags (M12); rows unchanged."""
    statistics = feature_statistics(df, cols)
    featured = with_features(df, statistics, cols)
    narrow = cut_lineage(featured.select(cols.row_id, cols.country, *GLOBAL_FEATURES))
    everywhere, g = SC.train_global_model(narrow, contamination, random_state, row_id=cols.row_id)
    by_country, c = SC.train_and_score_per_country(narrow, contamination, random_state, cols=cols)
    layers = cut_lineage(_both_layers(g, c, cols))
    bounds = SC.minmax_stats(SC.with_blend_input(layers), SC.BLENDED)
    scored = featured.join(SC.compute_final_score(layers, bounds), cols.row_id, "left")
    return AnomalyBundle(statistics, everywhere, by_country, bounds), scored
