"""Polygon predicates on hand-made polygons: holes, two parts, edges, buffer, land/ocean."""

import pytest
from pyspark.sql import functions as F

from terracheck.operators import geo
from terracheck.operators.qa import with_ocean_flag
from terracheck.sources.polygons import vertices_to_edges

SQUARE_WITH_HOLE = [
    ("AAA", 0, 0, [(0, 0), (10, 0), (10, 10), (0, 10)]),
    ("AAA", 0, 1, [(4, 4), (6, 4), (6, 6), (4, 6)]),  # hole
    ("BBB", 0, 0, [(20, 0), (22, 0), (22, 2), (20, 2)]),  # two parts
    ("BBB", 1, 0, [(30, 0), (32, 0), (32, 2), (30, 2), (30, 0)]),  # stored closed
    ("-99", 0, 0, [(50, 50), (51, 50), (51, 51)]),  # dropped
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(c, p, r, i, float(x), float(y)) for c, p, r, pts in SQUARE_WITH_HOLE for i, (x, y) in enumerate(pts)]
    v = spark.createDataFrame(rows, "iso_a3 string, part int, ring int, seq int, x double, y double")
    return vertices_to_edges(v).cache()


def pts(spark, rows):
    return spark.createDataFrame(rows, "row_id long, country string, latitude double, longitude double")


def test_edges(edges):
    assert edges.where("iso_a3 = '-99'").count() == 0
    assert edges.where("iso_a3 = 'BBB' AND part = 1").count() == 4  # closing duplicate dropped


def test_point_in_country_cases(spark, edges):
    df = pts(
        spark,
        [
            (1, "AAA", 2.0, 2.0),  # inside
            (2, "AAA", 5.0, 5.0),  # in the hole, 1 from its edges: outside buffer
            (3, "AAA", 5.0, 4.2),  # in the hole, 0.2 from its edge: within buffer
            (4, "AAA", 10.3, 5.0),  # 0.3 outside: within buffer
            (5, "AAA", 12.0, 5.0),  # far outside
            (6, "BBB", 1.0, 31.0),  # second part
            (7, "BBB", 1.0, 26.0),  # between parts
            (8, "ZZZ", 0.0, 0.0),  # unknown code
            (9, "aaa ", 2.0, 2.0),  # normalised code
            (10, "AAA", 0.0, 5.0),  # exactly on an edge
        ],
    )
    want = {1: True, 2: False, 3: True, 4: True, 5: False, 6: True, 7: False, 8: True, 9: True, 10: True}
    for method, cell in (("arrays", 5.0), ("cells", 5.0), ("cells", 1.0), ("cells", 0.3)):
        got = {r.row_id: r.in_country for r in geo.point_in_country(df, edges, method=method, cell_deg=cell).collect()}
        assert got == want, (method, cell)


def test_on_land_grid_join(spark, edges):
    df = pts(spark, [(1, None, 2.0, 2.0), (2, None, 5.0, 5.0), (3, None, 1.0, 31.0), (4, None, 1.0, 26.0),
                     (5, None, -40.0, 100.0), (6, None, 9.99, 9.99)])
    got = {r.row_id: r.on_land for r in geo.on_land(df, edges, cell_deg=3.0).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False, 6: True}


def test_land_mode_requires_polygons(spark):
    with pytest.raises(ValueError):
        with_ocean_flag(pts(spark, [(1, "A", 0.0, 0.0)]), mode="land")


def test_plan_is_broadcast_equi_join(spark, edges):
    df = pts(spark, [(1, "AAA", 2.0, 2.0)])
    for plan_df in (geo.point_in_country(df, edges), geo.on_land(df, edges)):
        plan = plan_df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_cells_hold_local_edges_only(spark, edges_small):
    """A coast of 10,000 edges a country: no cell's list grows with the coast."""
    from terracheck.sources.polygons import roughened_edges

    coast = roughened_edges(edges_small.where("iso_a3 IN ('C07', 'C12')"), 2000)
    assert coast.groupBy("iso_a3").count().first()["count"] == 12000
    step = 192 / 12000
    for cell in (0.5, 2.0):
        index = geo.parity_cells(coast, "iso_a3", cell, 0.5)
        longest = index.select(F.max(F.size("local"))).first()[0]
        assert longest <= 3 * (cell + 1 + 0.4) / step  # two sides of a corner, and what the coast swings
        rows = index.groupBy("iso_a3").agg(F.sum(F.col("ref_inside").cast("int"))).collect()
        area = 64 * 16 + 32 * 16
        assert all(abs(r[1] * cell * cell - area) < 0.05 * area + 70 * cell for r in rows)


def test_cells_equal_all_edges_on_a_jagged_coast(spark, edges_small):
    import random

    from terracheck.sources.polygons import roughened_edges

    coast = roughened_edges(edges_small.where("iso_a3 IN ('C07', 'C12')"), 300).cache()
    by_code = {}
    for e in coast.collect():
        by_code.setdefault(e.iso_a3, []).append((e.x1, e.y1, e.x2, e.y2))
    r = random.Random(4)
    rows = []
    for i in range(400):
        code = r.choice(sorted(by_code))
        x1, y1, _, _ = r.choice(by_code[code])
        # near the coast, on cell borders, on vertices' heights, anywhere
        x, y = r.choice([(x1 + r.uniform(-1, 1), y1 + r.uniform(-1, 1)), (float(round(x1)), float(round(y1))), (x1 + r.uniform(-2, 2), y1), (r.uniform(-180, 180), r.uniform(-90, 90))])
        rows.append((i, code, y, x))
    rows.append((999, "C07", None, 5.0))
    df = pts(spark, rows)

    def odd(code, x, y):
        return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / ((y2 - y1) or 1.0) + x1 for x1, y1, x2, y2 in by_code[code]) % 2 == 1

    land = {i: y is not None and any(odd(c, x, y) for c in by_code) for i, _, y, x in rows}
    flat = {r.row_id: r.in_country for r in geo.point_in_country(df, coast, method="arrays").collect()}
    for cell in (0.5, 1.0, 2.5, None):
        got = {r.row_id: r.in_country for r in geo.point_in_country(df, coast, method="cells", cell_deg=cell).collect()}
        assert got == flat, cell
        assert {r.row_id: r.on_land for r in geo.on_land(df, coast, cell_deg=cell).collect()} == land, cell


def test_slanted_edges_through_cell_corners(spark):
    """Vertices and edges that run exactly through corners of cells."""
    rings = [("AAA", 0, 0, [(0, 0), (10, 10), (20, 0), (10, -10)]), ("AAA", 0, 1, [(5, 0), (10, 5), (15, 0), (10, -5)])]
    rows = [(c, p, r, i, float(x), float(y)) for c, p, r, at in rings for i, (x, y) in enumerate(at)]
    edges = vertices_to_edges(spark.createDataFrame(rows, "iso_a3 string, part int, ring int, seq int, x double, y double"))
    grid = [(k, "AAA", y / 4 + 0.05, x / 4) for k, (x, y) in enumerate((x, y) for x in range(-8, 92, 3) for y in range(-48, 48, 5))]
    df = pts(spark, grid)
    want = {k: (4.999 < abs(x - 10) + abs(y) < 10.001) for k, _, y, x in grid}
    for cell in (0.5, 1.0, 5.0):
        assert {r.row_id: r.on_land for r in geo.on_land(df, edges, cell_deg=cell).collect()} == want, cell


#: Rings over the antimeridian, and the same split by hand.
CROSSING = [
    ("FJI", 0, 0, [(170, -10), (-170, -10), (-170, -25), (170, -25)]),
    ("FJI", 0, 1, [(178, -15), (-176, -15), (-176, -18), (178, -18)]),  # a hole over it too
    ("RUS", 0, 0, [(100, 50), (-175, 60), (-175, 65), (179, 70), (-179, 75), (100, 75)]),  # two crossings apart
    ("RUS", 1, 0, [(20, 50), (60, 50), (60, 60), (20, 60)]),  # does not cross
    ("ATA", 0, 0, [(-180 + 30 * k, -70 - (k % 2) * 3) for k in range(12)]),  # around the south pole
]
SPLIT = [
    ("FJI", 0, 0, [(170, -10), (180, -10), (180, -15), (178, -15), (178, -18), (180, -18), (180, -25), (170, -25)]),
    ("FJI", 1, 0, [(-180, -10), (-170, -10), (-170, -25), (-180, -25), (-180, -18), (-176, -18), (-176, -15), (-180, -15)]),
    ("ATA", 0, 0, [(-180 + 30 * k, -70 - (k % 2) * 3) for k in range(12)] + [(180, -70), (180, -90), (-180, -90)]),
]


def _polygon_tables(spark, rings):
    rows = [(c, p, r, i, float(x), float(y)) for c, p, r, at in rings for i, (x, y) in enumerate(at)]
    return vertices_to_edges(spark.createDataFrame(rows, "iso_a3 string, part int, ring int, seq int, x double, y double"))


def test_rings_over_the_antimeridian_are_split(spark):
    """Crossing polygons answer as pre-split ones do, in country and land tests."""
    crossing, split = (_polygon_tables(spark, [r for r in rings if r[0] in ("FJI", "ATA")]).cache() for rings in (CROSSING, SPLIT))
    assert crossing.where("abs(x1) > 180 OR abs(x2) > 180 OR abs(x2 - x1) > 180").where("abs(y1) < 90").count() == 0
    grid = [(x, y) for x in [*range(-180, -164, 1), *range(166, 181, 1), -100, 0, 77] for y in (-89.5, -80.3, -72.6, -71.2, -69.8, -25.3, -24.7, -18.3, -17.2, -16.1, -14.8, -12.3, -9.8, -9.3)]
    rows = [(i, c, y, x + 0.13 if x < 180 else x - 0.13) for i, (x, y, c) in enumerate((x, y, c) for x, y in grid for c in ("FJI", "ATA"))]
    df = pts(spark, rows)
    for ask in (lambda e: geo.point_in_country(df, e, method="arrays"), lambda e: geo.point_in_country(df, e, method="cells", cell_deg=2.0)):
        got, want = ({r.row_id: r.in_country for r in ask(e).collect()} for e in (crossing, split))
        assert got == want
    got, want = ({r.row_id: r.on_land for r in geo.on_land(df, e, cell_deg=3.0).collect()} for e in (crossing, split))
    assert got == want and 0 < sum(got.values()) < len(got)


def test_both_sides_of_a_crossing_ring(spark):
    edges = _polygon_tables(spark, CROSSING)
    inside = [(-176.0, 63.0), (179.5, 66.0), (-179.9, 74.5), (-179.9, 73.5), (110.0, 60.0), (30.0, 55.0), (-178.0, -12.0), (175.0, -20.0), (0.0, -80.0)]
    outside = [(-174.0, 62.0), (179.8, 71.0), (179.5, 71.0), (0.0, 60.0), (-100.0, 60.0), (179.0, -16.0), (-177.0, -16.0), (-160.0, -20.0), (0.0, -60.0)]
    df = pts(spark, [(i, None, y, x) for i, (x, y) in enumerate(inside + outside)])
    got = {r.row_id: r.on_land for r in geo.on_land(df, edges, cell_deg=5.0).collect()}
    assert [got[i] for i in range(len(inside))] == [True] * len(inside), got
    assert [got[i + len(inside)] for i in range(len(outside))] == [False] * len(outside), got
    # no edge along the antimeridian where the polygon does not meet it
    near = geo.point_in_country(pts(spark, [(1, "RUS", 71.0, -179.8), (2, "FJI", -16.5, 179.8)]), edges, buffer_deg=0.25)
    assert [r.in_country for r in near.orderBy("row_id").collect()] == [False, False]


def test_geojson_lines_reader(spark, tmp_path):
    import json

    from terracheck.sources.polygons import geojson_vertices

    feats = [
        {"type": "Feature", "properties": {"iso_a3": "AAA"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]],
                                                         [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]]}},
        {"type": "Feature", "properties": {"iso_a3": "BBB"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[20, 0], [22, 0], [22, 2], [20, 2], [20, 0]]],
                                                              [[[30, 0], [32, 0], [32, 2], [30, 2], [30, 0]]]]}},
        {"type": "Feature", "properties": {"iso_a3": "-99"},
         "geometry": {"type": "Polygon", "coordinates": [[[50, 50], [51, 50], [51, 51], [50, 50]]]}},
    ]
    path = tmp_path / "world.geojsonl"
    path.write_text("\n".join(json.dumps(f) for f in feats))
    edges = vertices_to_edges(geojson_vertices(spark, str(path)))
    assert edges.where("iso_a3 = 'AAA'").count() == 8 and edges.where("iso_a3 = 'BBB'").count() == 8
    assert edges.where("iso_a3 = '-99'").count() == 0
    df = pts(spark, [(1, "AAA", 2.0, 2.0), (2, "AAA", 5.0, 5.0), (3, "BBB", 1.0, 31.0), (4, "BBB", 1.0, 26.0)])
    got = {r.row_id: r.in_country for r in geo.point_in_country(df, edges, buffer_deg=0.1).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False}


def test_shuffle_fallbacks_equal_broadcast_paths(spark, assets_small, edges_small):

    def as_map(df, col):
        return {r.row_id: r[col] for r in df.select("row_id", col).collect()}

    for method in ("arrays", "cells"):
        b = as_map(geo.point_in_country(assets_small, edges_small, method=method), "in_country")
        s = as_map(geo.point_in_country(assets_small, edges_small, method=method, max_broadcast_edges=0), "in_country")
        assert b == s
    assert as_map(geo.on_land(assets_small, edges_small), "on_land") == as_map(
        geo.on_land(assets_small, edges_small, max_broadcast_edges=0), "on_land"
    )


def test_issue_kinds_add_up_and_missing_coordinates(spark, assets_small, edges_small):
    from terracheck.operators.qa import detect_qa_errors

    key = lambda r: (r.row_id, r.issue_type, r.detail)
    whole = sorted(map(key, detect_qa_errors(assets_small).collect()))
    parts = sorted(key(r) for k in ("OCEAN_COORDS", "DUPLICATE_ID", "MISSING_CAPACITY") for r in detect_qa_errors(assets_small, kinds=(k,)).collect())
    assert whole == parts
    rows = spark.createDataFrame([(1, "a", 1.0, None, 5.0), (2, "b", float("nan"), 1.0, float("nan"))], "row_id long, gppd_idnr string, capacity_mw double, latitude double, longitude double")
    got = {(r.row_id, r.issue_type): r.detail for r in detect_qa_errors(rows, mode="land", land=edges_small).collect()}
    assert got[1, "OCEAN_COORDS"] == "lat=nan, lon=5.0" and got[2, "OCEAN_COORDS"] == "lat=1.0, lon=nan" and (2, "MISSING_CAPACITY") in got
