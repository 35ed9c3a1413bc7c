"""Physical-plan assertions (survey section 4.2)."""

from terracheck.operators import charts, evaluate
from terracheck.operators import expectations as X
from terracheck.operators.validate import validate_records


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_validation_is_one_projection(spark, tmp_path, assets_small):
    path = str(tmp_path / "assets")
    assets_small.write.parquet(path)
    p = plan(validate_records(spark.read.parquet(path)))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "Exchange" not in p


def test_topk_uses_take_ordered(spark, assets_small):
    from pyspark.sql import functions as F

    scored = assets_small.withColumns({"ANOMALY_SCORE": F.col("latitude") / 100, "IS_ANOMALY": F.col("latitude") > 50})
    assert "TakeOrderedAndProject" in plan(evaluate.top_anomalies(scored))
    assert "TakeOrderedAndProject" in plan(X.top_duplicate_values(assets_small, "gppd_idnr"))
    assert "TakeOrderedAndProject" in plan(charts.country_anomaly_rate(scored))


def test_suite_is_one_fused_aggregate(assets_small):
    p = plan(X.run_expectation_suite(assets_small))
    assert "BatchEvalPython" not in p
    # one aggregate for the table stats + the id count and its two consumers
    assert p.count("HashAggregate") <= 12 and "Subquery" not in p


def test_no_cartesian_or_row_python_in_any_query(spark):
    from terracheck.plans import catalog

    catalog.load_all()
    offenders = []
    for name, fn in sorted(catalog.QUERIES.items()):
        df = fn(spark, "/root/testdata/sf0.001")
        p = plan(df)
        if "CartesianProduct" in p or "BatchEvalPython" in p:
            offenders.append(name)
    assert offenders == []
