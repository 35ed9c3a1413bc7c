"""Golden facts of the derived asset table (FIXTURES.md section 5) and polygon sources."""

from pyspark.sql import functions as F

from terracheck.functions.geometry import in_boxes
from terracheck.operators import geo
from terracheck.operators.sampling import with_hash_rank
from terracheck.sources.assets import normalise_nulls, point_wkt, project_existing, scan_assets


def test_golden_counts_sf0001(assets_small):
    a = assets_small
    r = a.agg(
        F.count("*").alias("rows"),
        F.count_distinct("row_id").alias("ids"),
        F.count_distinct("gppd_idnr").alias("gids"),
        F.count_if(F.col("capacity_mw").isNull()).alias("null_cap"),
        F.count_if(F.col("commissioning_year").isNull()).alias("null_year"),
        F.count_if(F.col("capacity_mw") < 0).alias("neg_cap"),
        F.count_if(F.col("latitude") > 90).alias("lat90"),
        F.count_if(F.col("commissioning_year") > 2100).alias("y2100"),
        F.count_if(F.length("country") != 3).alias("badc"),
        F.count_if(in_boxes(F.col("latitude"), F.col("longitude"))).alias("ocean"),
        F.count_distinct("country").alias("countries"),
    ).first()
    assert (r.rows, r.ids, r.gids) == (1560, 1560, 1500)
    assert (r.null_cap, r.null_year, r.neg_cap, r.lat90, r.y2100, r.badc) == (125, 750, 25, 5, 8, 3)
    assert (r.ocean, r.countries) == (61, 26)


def test_golden_border_facts(assets_small, edges_small):
    from terracheck.functions import geometry as G

    arrays = geo.country_edge_arrays(edges_small)
    j = assets_small.join(F.broadcast(arrays), assets_small.country == arrays.iso_a3)
    px, py = F.col("longitude"), F.col("latitude")
    r = j.agg(
        F.count("*").alias("known"),
        F.count_if(G.inside(F.col("_edges"), px, py)).alias("inside"),
        F.count_if(G.within_buffer(F.col("_edges"), px, py, 0.5)).alias("consistent"),
    ).first()
    assert (r.known, r.inside, r.consistent) == (1557, 1404, 1448)


def test_golden_md5_rank_sample(assets_small):
    ranked = with_hash_rank(assets_small, 100, 99, "ocean").where(F.col("_rank").isNotNull())
    assert ranked.count() == 100
    assert ranked.agg(F.sum(F.col("row_id") * F.col("_rank"))).first()[0] == 8210230


def test_polygon_edges_close_rings(edges_small):
    assert edges_small.count() == 25 * 6
    per = edges_small.groupBy("iso_a3").agg(F.sum(F.col("x2") - F.col("x1")).alias("dx"), F.sum(F.col("y2") - F.col("y1")).alias("dy"))
    assert per.where((F.abs("dx") > 1e-9) | (F.abs("dy") > 1e-9)).count() == 0


def test_normalise_nulls_and_projection(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), 2.0, None), (2, 3.0, float("nan"), "OCEAN_COORDS")],
        "row_id long, capacity_mw double, latitude double, error_flags string",
    )
    out = normalise_nulls(df).orderBy("row_id").collect()
    assert out[0].capacity_mw is None and out[0].error_flags == ""
    assert out[1].latitude is None and out[1].error_flags == "OCEAN_COORDS"
    assert project_existing(df, ["latitude", "missing", "row_id"]).columns == ["latitude", "row_id"]


def test_scan_csv_projects_asset_columns(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text(
        "extra,gppd_idnr,name,capacity_mw,latitude,longitude,country,primary_fuel,commissioning_year\n"
        "x,WRI1,Plant,12.5,1.0,2.0,USA,Coal,2000\n"
        "y,WRI2,Plant2,abc,3.0,4.0,DEU,Gas,\n"
    )
    df = scan_assets(spark, str(p), "csv")
    assert df.columns[0] == "gppd_idnr" and "extra" not in df.columns
    rows = df.orderBy("gppd_idnr").collect()
    assert rows[0].capacity_mw == 12.5 and rows[1].capacity_mw is None and rows[1].commissioning_year is None


def test_point_wkt(spark):
    df = spark.createDataFrame([(1, 40.0, -74.0)], "row_id long, latitude double, longitude double")
    r = point_wkt(df).first()
    assert r.wkt == "POINT (-74.0000 40.0000)" and r.geometry.x == -74.0
