"""The row validators run unchanged on a stream."""

from terracheck.columns import ASSET_SCHEMA
from terracheck.streaming.validate_stream import read_asset_stream, start_sink, validate_stream


def test_stream_validation(spark, assets_small, edges_small, tmp_path):
    src = str(tmp_path / "in")
    assets_small.drop("row_id").limit(300).write.parquet(src)
    s = read_asset_stream(spark, src, ASSET_SCHEMA)
    out_df = validate_stream(s, edges_small)
    q = start_sink(out_df, str(tmp_path / "out"), str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 300
    assert {"pydantic_valid", "asset_valid", "geometry_consistent", "in_ocean"} <= set(got.columns)


def test_stream_scoring_with_saved_model(spark, assets_small, tmp_path):
    from pyspark.sql import types as T

    from terracheck.operators.forest import ForestModel
    from terracheck.operators.scoring import train_isolation_forest
    from terracheck.streaming.score_stream import score_stream

    model, _ = train_isolation_forest(assets_small, n_estimators=50)
    model.save(str(tmp_path / "model"))
    loaded = ForestModel.load(spark, str(tmp_path / "model"))
    src = str(tmp_path / "in2")
    assets_small.write.parquet(src)
    schema = T.StructType([T.StructField("row_id", T.LongType())] + list(ASSET_SCHEMA.fields))
    q = score_stream(read_asset_stream(spark, src, schema), loaded, str(tmp_path / "scored"), str(tmp_path / "ck2"),
                     trigger_once=True)
    q.awaitTermination(180)
    got = spark.read.parquet(str(tmp_path / "scored"))
    assert got.count() == assets_small.count()
    assert {"anomaly_score", "is_anomaly", "batch_id"} <= set(got.columns)


def test_bundle_scores_a_stream_as_a_batch(spark, assets_small, tmp_path):
    """A reloaded two-layer bundle gives the run's scores, to a batch, to a part of it, and to a stream."""
    import pytest
    from pyspark.sql import types as T

    from terracheck.operators.bundle import AnomalyBundle, fit_bundle
    from terracheck.streaming.score_stream import score_stream

    names = ["row_id", "global_score", "country_score", "country_anomaly", "model_used", "ANOMALY_SCORE", "IS_ANOMALY", "country_cap_zscore"]
    at = lambda df: {r.row_id: tuple(r) for r in df.select(names).collect()}
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        AnomalyBundle.load(spark, path)
    bundle, scored = fit_bundle(assets_small)
    want = at(scored)
    assert bundle.save(path) == 1
    loaded = AnomalyBundle.load(spark, path)
    few = assets_small.where("row_id % 50 = 0 AND country = 'C03' OR country = 'XX'")
    assert at(loaded.score(few)) == {r.row_id: want[r.row_id] for r in few.select("row_id").collect()}
    src = str(tmp_path / "in3")
    assets_small.repartition(2).write.parquet(src)
    schema = T.StructType([T.StructField("row_id", T.LongType())] + list(ASSET_SCHEMA.fields))
    q = score_stream(read_asset_stream(spark, src, schema), loaded, str(tmp_path / "scored3"), str(tmp_path / "ck3"), trigger_once=True)
    q.awaitTermination(240)
    assert at(spark.read.parquet(str(tmp_path / "scored3"))) == want
    # a second version; one whose manifest line is missing is not seen
    bundle.bounds = {k: (0.0, 0.0, 1.0) for k in bundle.bounds}
    assert bundle.save(path) == 2 and AnomalyBundle.load(spark, path).bounds != loaded.bounds
    assert AnomalyBundle.load(spark, path, 1).bounds == loaded.bounds
    with pytest.raises(FileNotFoundError):
        AnomalyBundle.load(spark, path, 3)
