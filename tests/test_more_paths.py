"""Less-travelled paths: Parquet scan, stored vertex tables, global scaling, ranked quantile rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terracheck.operators.features import standard_scale
from terracheck.sources.assets import scan_assets
from terracheck.sources.polygons import read_vertex_table, vertices_to_edges


def test_scan_parquet_projects_and_casts(spark, assets_small, tmp_path):
    path = str(tmp_path / "assets")
    assets_small.withColumn("extra", F.lit(1)).write.parquet(path)
    df = scan_assets(spark, path, "parquet")
    assert df.columns == ["gppd_idnr", "name", "capacity_mw", "latitude", "longitude", "country", "primary_fuel",
                          "commissioning_year"]
    assert df.count() == assets_small.count()
    assert "extra" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_stored_vertex_table(spark, tmp_path):
    rows = [("AAA", 0, 0, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (4, 0), (4, 4), (0, 4)])]
    path = str(tmp_path / "verts")
    spark.createDataFrame(rows, "iso_a3 string, part int, ring int, seq int, x double, y double").write.parquet(path)
    edges = vertices_to_edges(read_vertex_table(spark, path))
    assert edges.count() == 4
    assert edges.agg(F.sum(F.col("x2") - F.col("x1"))).first()[0] == 0


def test_global_standard_scale(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0], "b": [5.0, 5.0, 5.0, 5.0]}))
    out = standard_scale(df, ["a", "b"]).collect()
    a = np.array([1.0, 2.0, 3.0, 4.0])
    assert [r.a_scaled for r in out] == pytest.approx(list((a - a.mean()) / a.std()))
    assert all(r.b_scaled == 0.0 for r in out)  # std 0 -> divide by 1
