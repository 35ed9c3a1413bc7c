"""End-to-end runs (both entry points of the reference) with their table sinks."""

from pyspark.sql import functions as F

from terracheck.plans.runs import anomaly_run, qa_run


def test_qa_and_anomaly_runs_write_their_tables(spark, assets_small, edges_small, tmp_path):
    out = str(tmp_path / "out")
    qa = qa_run(assets_small, edges_small, out_dir=out)
    assert qa.dirty.count() == 1560 + int(1560 * 0.04)
    assert qa.suite.count() == 8
    assert {r.issue_type for r in qa.issues.select("issue_type").distinct().collect()} == {
        "OCEAN_COORDS", "DUPLICATE_ID", "MISSING_CAPACITY"}
    for name in ("clean", "dirty", "scored", "qa_report"):
        assert spark.read.parquet(f"{out}/{name}").count() > 0
    assert spark.read.option("header", True).csv(f"{out}/dq_dimensions").count() == 4

    run = anomaly_run(qa.dirty, out_dir=out)
    s = run.summary.first()
    assert s.total == qa.dirty.count() and 0 < s.anomalous < s.total
    r = run.recall.first()
    assert r.known > 0 and 0.0 <= r.recall <= 1.0
    assert run.top5.count() == 5
    markers = spark.read.parquet(f"{out}/markers")
    assert {r.layer for r in markers.select("layer").distinct().collect()} == {"clean", "anomalous"}
    scored = spark.read.parquet(f"{out}/ml_scored")
    assert scored.columns[:3] == ["gppd_idnr", "name", "country"] and "error_flags" in scored.columns
    assert scored.where(F.col("ANOMALY_SCORE").isNull()).count() == 0


def test_land_mode_qa_report(spark, assets_small, edges_small):
    from terracheck.operators.qa import detect_qa_errors

    land = detect_qa_errors(assets_small, mode="land", land=edges_small).where("issue_type = 'OCEAN_COORDS'")
    # points outside every L polygon: the notch and cell margins count as ocean here
    assert land.count() > detect_qa_errors(assets_small).where("issue_type = 'OCEAN_COORDS'").count()
