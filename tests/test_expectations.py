"""Expectation suite and DQ report on edge cases."""

import pytest
from pyspark.sql import functions as F

from terracheck.operators import dq
from terracheck.operators import expectations as X

SCHEMA = "row_id long, gppd_idnr string, capacity_mw double, latitude double, longitude double, commissioning_year int"


def suite_rows(df, checks=None):
    return {r.check_order: r for r in X.run_expectation_suite(df, checks).collect()}


def test_empty_table(spark):
    r = suite_rows(spark.createDataFrame([], SCHEMA))
    assert r[1].observed_value == 0.0 and not r[1].success  # completeness 0.0 on empty
    assert not r[3].success and r[3].detail == "Dataset contains 0 rows."
    assert r[4].observed_value == 1.0 and r[4].success  # uniqueness 1.0 on empty
    assert r[5].observed == "min=nan, max=nan" and r[5].detail == "All 0 values within range."


def test_column_missing(spark):
    df = spark.createDataFrame([(1, "A", 1.0, 1.0)], "row_id long, gppd_idnr string, latitude double, longitude double")
    r = suite_rows(df)
    assert r[1].observed == "column missing" and not r[1].success
    assert r[1].detail == "Column 'capacity_mw' does not exist in the dataset."
    assert r[7].threshold == "[0, 25000]" and r[7].observed == "column missing"


def test_uniqueness_counts_null_group_and_samples(spark):
    rows = [(1, "A", 1.0, 0.0, 0.0, 2000), (2, "A", 1.0, 0.0, 0.0, 2000), (3, None, 1.0, 0.0, 0.0, 2000),
            (4, None, 1.0, 0.0, 0.0, 2000), (5, "B", 1.0, 0.0, 0.0, 2000)]
    r = suite_rows(spark.createDataFrame(rows, SCHEMA))[4]
    assert r.n_bad == 4 and r.observed_value == 0.2
    assert r.detail == "4 duplicate rows across 3 non-unique values. Sample duplicates: {'A': 2}"


def test_between_and_text(spark):
    rows = [(1, "A", -5.0, 95.125, 0.0, 2000), (2, "B", 30000.0, 10.0, 0.0, None)]
    r = suite_rows(spark.createDataFrame(rows, SCHEMA))
    assert r[5].observed == "min=10.00, max=95.12" and r[5].detail == "1 values outside [-90, 90]."
    assert r[7].detail == "2 values outside [0, 25000]." and not r[7].success
    assert r[2].detail == "Required ≥ 95% complete. 1 / 2 values are null (50.0% missing)."


def test_summary_dimension_and_report(spark, assets_small, edges_small):
    from terracheck.operators.validate import validate_assets

    suite = X.run_expectation_suite(assets_small)
    s = X.suite_summary(suite).first()
    assert s.checks == 8 and s.passed + s.failed == 8
    rep = dq.build_dq_report(assets_small, suite, validate_assets(assets_small, edges_small))
    dims = {r.dimension: r for r in rep.dimensions.collect()}
    assert set(dims) == {"ACCURACY", "COMPLETENESS", "CONSISTENCY", "UNIQUENESS"}
    assert dims["UNIQUENESS"].score == 0.0 and dims["UNIQUENESS"].status == "❌ FAIL"
    assert rep.issues.count() == 20
    o = rep.summary.first()
    assert o.overall_score == pytest.approx(sum(d.raw_score for d in dims.values()) / 4, abs=1e-4)


def test_report_reads_the_table_twice(spark, assets_small, edges_small, tmp_path):
    """Counts, scores and issues come from one validated pass, id counts from another."""
    rows = assets_small.count()
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    plain = dq.build_dq_report(assets_small, X.run_expectation_suite(assets_small), country_edges=edges_small)
    want = [sorted(map(str, t.collect())) for t in (plain.dimensions, plain.summary, plain.checks, plain.issues, plain.suite)]
    for folder in (None, str(tmp_path / "validated")):
        before = read.value
        watched = assets_small.mapInArrow(count, assets_small.schema)
        rep = dq.build_dq_report(watched, country_edges=edges_small, write_to=folder)
        got = [sorted(map(str, t.collect())) for t in (rep.dimensions, rep.summary, rep.checks, rep.issues, rep.suite)]
        assert got == want
        assert read.value - before <= 2 * rows
    assert spark.read.parquet(folder).count() == rows


def test_report_of_an_empty_table(assets_small, edges_small):
    rep = dq.build_dq_report(assets_small.where("row_id < 0"), country_edges=edges_small)
    assert rep.accuracy.first().accuracy == 1.0 and rep.issues.count() == 0
    assert rep.summary.first().total_rows == 0 and rep.dimensions.count() == 4


def test_export_dimensions(spark, assets_small, edges_small, tmp_path):
    from terracheck.operators.validate import validate_assets

    rep = dq.build_dq_report(assets_small, X.run_expectation_suite(assets_small), validate_assets(assets_small, edges_small))
    dq.export_dimensions(rep, str(tmp_path / "dq"))
    back = spark.read.option("header", True).csv(str(tmp_path / "dq"))
    assert back.columns == ["dimension", "score", "pct", "status", "description", "source"] and back.count() == 4
