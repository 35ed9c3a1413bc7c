"""Edge-case inputs of FIXTURES.md section 6."""

import math

import pytest
from pyspark.sql import functions as F

from terracheck.operators import features as FE
from terracheck.operators import scoring as SC
from terracheck.operators.expectations import run_expectation_suite
from terracheck.operators.qa import detect_qa_errors
from terracheck.operators.validate import validate_records
from terracheck.sources.assets import normalise_nulls

SCHEMA = (
    "row_id long, gppd_idnr string, name string, capacity_mw double, latitude double, longitude double, "
    "country string, primary_fuel string, commissioning_year double"
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_all_null_capacity(spark):
    df = frame(spark, [(i, f"A{i}", "n", None, 10.0 + i, 20.0, "USA", "Coal", 2000.0) for i in range(12)])
    f = FE.engineer_features(df).collect()
    assert all(r.cap_filled is None and r.country_cap_zscore == 0.0 for r in f)
    out = SC.run_ml_anomaly_detection(df)
    assert out.count() == 12 and out.where(F.col("ANOMALY_SCORE").isNull()).count() == 0
    suite = {r.check_order: r for r in run_expectation_suite(df).collect()}
    assert suite[1].observed_value == 0.0 and suite[7].observed == "min=nan, max=nan"


def test_infinite_capacity_and_nan_doubles(spark):
    df = frame(
        spark,
        [
            (1, "A", "n", float("inf"), 10.0, 20.0, "USA", "Coal", 2000.0),
            (2, "B", "n", 5.0, 11.0, 21.0, "USA", "Coal", 2000.0),
            (3, "C", "n", float("nan"), float("nan"), float("nan"), "USA", "Coal", 2005.5),
        ],
    )
    v = {r.row_id: r.pydantic_errors for r in validate_records(df).collect()}
    assert v[1] == ""  # +inf passes ge=0
    assert v[3] == (
        "latitude: Input should be less than or equal to 90, longitude: Input should be less than or equal to 180, "
        "commissioning_year: Input should be a valid integer, got a number with a fractional part"
    )
    n = {r.row_id: r for r in normalise_nulls(df).collect()}
    assert n[3].capacity_mw is None and n[3].latitude is None
    z = {r.row_id: r.country_cap_zscore for r in FE.engineer_features(normalise_nulls(df)).collect()}
    assert all(not math.isnan(x) for x in z.values())


def test_null_country_and_one_row_country(spark):
    df = frame(spark, [(i, f"A{i}", "n", float(i), 10.0, 20.0, "USA", "Coal", 2000.0) for i in range(11)]
               + [(20, "B", "n", 3.0, 1.0, 1.0, None, "Gas", 1999.0), (21, "C", "n", 7.0, 1.0, 1.0, "DEU", "Gas", 1999.0)])
    _, c = SC.train_and_score_per_country(FE.engineer_features(df))
    used = {r.row_id: r.model_used for r in c.collect()}
    assert used[20] == "global_fallback" and used[21] == "global_fallback" and used[0] == "country"
    f = {r.row_id: r for r in FE.engineer_features(df).collect()}
    assert f[20].country_cap_zscore == 0.0 and f[21].country_cap_zscore == 0.0
    assert f[20].cap_filled == 3.0


def test_empty_table_everywhere(spark):
    df = frame(spark, [])
    assert validate_records(df).count() == 0
    assert detect_qa_errors(df).count() == 0
    assert run_expectation_suite(df).count() == 8
    assert FE.engineer_features(df).count() == 0
    with pytest.raises(ValueError):
        SC.train_global_model(FE.engineer_features(df))


def test_summary_of_empty_scored_table(spark):
    from terracheck.operators.evaluate import anomaly_summary, detection_recall

    empty = spark.createDataFrame([], "row_id long, ANOMALY_SCORE double, IS_ANOMALY boolean, error_flags string")
    s = anomaly_summary(empty).first()
    assert s.total == 0 and s.pct_anomalous is None
    assert detection_recall(empty).first().recall == 0.0
