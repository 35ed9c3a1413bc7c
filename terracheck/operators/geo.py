"""Geospatial predicates and joins (G1, G2) without a geometry type.

* G1 ``point_in_country``: coarse polygons join on the country code to the country's edge array
  (bounding-box reject, even-odd, nearest-edge distance); detailed ones join on (country, grid cell).
* G2 ``ocean_by_land``: the theta join "point within any land polygon" made an equi-join on a grid
  cell.

``parity_cells`` is the index of both. A cell has one bit, whether its reference corner is inside,
and the edges near the cell. A point is inside when the path from it to the corner crosses an even
number of these edges and the corner is inside, or an odd number and it is not. So no edge is ever
copied beyond the cells it touches, and the work of a point depends on its cell alone.

The polygon side is small and checked: it is broadcast when its rows and edges are under
``max_broadcast_edges``; above that the join is a regular shuffle join (AQE splits skewed
countries / cells).  Points are never shuffled to reach a broadcast side, and no join here is a
nested-loop or cartesian product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.functions import geometry as G
from terracheck.session import cut_lineage

MAX_BROADCAST_EDGES = 2_000_000  # ~ 64 MB of (x1, y1, x2, y2) doubles


def _maybe_broadcast(side: DataFrame, n_edges: int, max_edges: int) -> DataFrame:
    return F.broadcast(side) if n_edges <= max_edges else side


#: A cell is about so many mean edge lengths wide, within these bounds in degrees.
EDGES_PER_CELL = 16
CELL_BOUNDS = (0.25, 5.0)
#: Edges count as near a cell from this much farther away than asked for, against rounding.
_SLACK = 1e-6


def fitting_cell(edges: DataFrame) -> float:
    """A cell width for the detail of ``edges``."""
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    mean = edges.agg(F.avg(length)).first()[0]
    low, high = CELL_BOUNDS
    return high if mean is None else min(high, max(low, EDGES_PER_CELL * mean))


def parity_cells(edges: DataFrame, key: str, cell_deg: float, near_deg: float = 0.0) -> DataFrame:
    """``(key, cx, cy, ref_inside, local)`` of the polygons named by column ``key``.

    ``ref_inside`` tells whether the cell's reference corner ``((cx + 1) * cell, cy * cell)`` is
    inside, and ``local`` has the edges that come within ``near_deg`` of the cell. Cells without
    either are missing: all their points are outside."""
    c, m = F.lit(float(cell_deg)), F.lit(near_deg + _SLACK)
    e = edges.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))).select(F.col(key), "x1", "y1", "x2", "y2")
    edge = F.struct("x1", "y1", "x2", "y2")

    # the rows of cells that an edge comes near, and its part within each row
    rows = F.sequence(F.floor((F.least("y1", "y2") - m) / c), F.floor((F.greatest("y1", "y2") + m) / c))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def x_in_row(height: Column) -> Column:
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (height - F.col("y1")) / F.when(dy == 0, 1.0).otherwise(dy)))
        return F.col("x1") + t * dx

    low, high = x_in_row(F.col("cy") * c - m), x_in_row((F.col("cy") + 1) * c + m)
    level = dy == 0
    first = F.when(level, F.least("x1", "x2")).otherwise(F.least(low, high))
    last = F.when(level, F.greatest("x1", "x2")).otherwise(F.greatest(low, high))
    near = e.select(key, "x1", "y1", "x2", "y2", F.explode(rows).alias("cy")).select(
        key, "cy", edge.alias("edge"), F.explode(F.sequence(F.floor((first - m) / c), F.floor((last + m) / c))).alias("cx"), F.lit(False).alias("ref")
    )

    # where the lower border of each row of cells crosses the polygon: inside from every odd crossing to the next
    borders = F.sequence(F.floor(F.least("y1", "y2") / c), F.floor(F.greatest("y1", "y2") / c) + 1)
    at = e.select(key, edge.alias("edge"), F.explode(borders).alias("cy")).select(
        key, "cy", G.x_where_crossed(F.col("edge"), F.col("cy") * c).alias("x")
    )
    row = Window.partitionBy(key, "cy").orderBy("x")  # the crossings of one line with one polygon
    spans = at.where("x IS NOT NULL").select(key, "cy", "x", F.lead("x").over(row).alias("until"), F.row_number().over(row).alias("i"))
    inside = (
        spans.where("i % 2 = 1 AND until IS NOT NULL")
        .select(key, "cy", "x", "until", F.explode(F.sequence(F.floor(F.col("x") / c) - 2, F.floor(F.col("until") / c) + 1)).alias("cx"))
        .where(((F.col("cx") + 1) * c >= F.col("x")) & ((F.col("cx") + 1) * c < F.col("until")))
        .select(key, "cy", F.lit(None).cast(near.schema["edge"].dataType).alias("edge"), "cx", F.lit(True).alias("ref"))
    )
    return near.unionByName(inside).groupBy(key, "cx", "cy").agg(F.max("ref").alias("ref_inside"), F.collect_list("edge").alias("local"))


def _inside_cell(ref_inside: Column, local: Column, px: Column, py: Column, cx: Column, cy: Column, cell_deg: float) -> Column:
    c = F.lit(float(cell_deg))
    return G.inside_by_reference(ref_inside, local, px, py, (cx + 1) * c, cy * c)


def _box() -> list[Column]:
    return [
        F.least(F.min("x1"), F.min("x2")).alias("_xmin"),
        F.greatest(F.max("x1"), F.max("x2")).alias("_xmax"),
        F.least(F.min("y1"), F.min("y2")).alias("_ymin"),
        F.greatest(F.max("y1"), F.max("y2")).alias("_ymax"),
    ]


def country_boxes(edges: DataFrame) -> DataFrame:
    """One row per country: its bounding box."""
    return edges.groupBy("iso_a3").agg(*_box())


def country_edge_arrays(edges: DataFrame) -> DataFrame:
    """One row per country: its edges as an array plus its bounding box."""
    return edges.groupBy("iso_a3").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("_edges"), *_box())


def normalised_country(cols: AssetCols = DEFAULT_COLS):
    """A4: strip (any whitespace) then upper-case."""
    return F.upper(F.regexp_replace(F.col(cols.country), r"(?U)^\s+|\s+$", ""))


MAX_EDGES_PER_COUNTRY_FOR_ARRAYS = 256


def point_in_country(
    df: DataFrame,
    edges: DataFrame,
    cols: AssetCols = DEFAULT_COLS,
    buffer_deg: float = 0.5,
    out: str = "in_country",
    max_broadcast_edges: int = MAX_BROADCAST_EDGES,
    method: str = "auto",
    cell_deg: float | None = None,
) -> DataFrame:
    """G1: adds boolean ``out`` = point strictly within its country's polygon grown by
    ``buffer_deg`` (planar degrees).  Unknown country codes give True.

    ``method='arrays'`` tests every edge of the row's country (fine for coarse polygons);
    ``method='cells'`` joins on (country, grid cell) to the cell's reference bit and near edges, so
    per-row work does not grow with coastline detail.  ``'auto'`` picks arrays when no country has
    more than 256 edges.  Both give the same rows; ``cell_deg`` defaults to what fits the edges."""
    sizes = edges.groupBy("iso_a3").count().agg(F.sum("count").alias("n"), F.max("count").alias("widest"), F.count("*").alias("countries")).first()
    n_edges, widest = sizes["n"] or 0, sizes["widest"] or 0
    if method == "auto":
        method = "arrays" if widest <= MAX_EDGES_PER_COUNTRY_FOR_ARRAYS else "cells"
    key = normalised_country(cols)
    px, py = F.col(cols.lon), F.col(cols.lat)
    if method == "arrays":
        polys = country_edge_arrays(edges)
        joined = df.join(_maybe_broadcast(polys, n_edges, max_broadcast_edges), key == F.col("iso_a3"), "left")
        near = G.within_buffer(F.col("_edges"), px, py, buffer_deg)
        extra = ["_edges"]
    elif method == "cells":
        cell = fitting_cell(edges) if cell_deg is None else cell_deg
        boxes = country_boxes(edges)
        index = cut_lineage(parity_cells(edges, "iso_a3", cell, buffer_deg)).select(  # counted, then joined
            F.col("iso_a3").alias("_ci"), F.col("cx").alias("_ccx"), F.col("cy").alias("_ccy"), F.col("ref_inside").alias("_ref"), F.col("local").alias("_local")
        )
        n_index = index.select(F.sum(F.size("_local") + 1)).first()[0] or 0
        joined = (
            df.withColumns({"_key": key, "_cx": F.floor(px / cell), "_cy": F.floor(py / cell)})
            .join(_maybe_broadcast(boxes, sizes["countries"] or 0, max_broadcast_edges), F.col("_key") == F.col("iso_a3"), "left")
            .join(
                _maybe_broadcast(index, n_index, max_broadcast_edges),
                (F.col("_key") == F.col("_ci")) & (F.col("_cx") == F.col("_ccx")) & (F.col("_cy") == F.col("_ccy")),
                "left",
            )
        )
        inside = _inside_cell(F.col("_ref"), F.col("_local"), px, py, F.col("_cx"), F.col("_cy"), cell)
        near = F.coalesce(inside, F.lit(False)) | F.coalesce(G.min_edge_distance(F.col("_local"), px, py) < buffer_deg, F.lit(False))
        extra = ["_key", "_cx", "_cy", "_ci", "_ccx", "_ccy", "_ref", "_local"]
    else:
        raise ValueError(f"unknown method {method!r}; use 'auto', 'arrays' or 'cells'")
    in_box = (
        (px > F.col("_xmin") - buffer_deg)
        & (px < F.col("_xmax") + buffer_deg)
        & (py > F.col("_ymin") - buffer_deg)
        & (py < F.col("_ymax") + buffer_deg)
    )
    test = F.when(F.col("iso_a3").isNull(), F.lit(True)).when(F.coalesce(in_box, F.lit(False)), near).otherwise(F.lit(False))
    return joined.withColumn(out, F.coalesce(test, F.lit(False))).drop("iso_a3", "_xmin", "_xmax", "_ymin", "_ymax", *extra)


def on_land(
    df: DataFrame,
    edges: DataFrame,
    cols: AssetCols = DEFAULT_COLS,
    cell_deg: float | None = None,
    out: str = "on_land",
    max_broadcast_edges: int = MAX_BROADCAST_EDGES,
) -> DataFrame:
    """Adds boolean ``out``: the point lies inside at least one polygon part (no buffer)."""
    cell = fitting_cell(edges) if cell_deg is None else cell_deg
    parts = edges.withColumn("_poly", F.concat_ws("#", "iso_a3", F.col("part").cast("string")))
    cells = cut_lineage(parity_cells(parts, "_poly", cell))  # counted, then joined
    index = cells.groupBy("cx", "cy").agg(F.collect_list(F.struct("ref_inside", "local")).alias("_parts"))
    n_rows = cells.select(F.sum(F.size("local") + 1)).first()[0] or 0
    index = _maybe_broadcast(index, n_rows, max_broadcast_edges)
    px, py = F.col(cols.lon), F.col(cols.lat)
    pts = df.withColumns({"_cx": F.floor(px / cell), "_cy": F.floor(py / cell)})
    joined = pts.join(index, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy")), "left")
    hit = F.exists(F.col("_parts"), lambda p: _inside_cell(p["ref_inside"], p["local"], px, py, F.col("_cx"), F.col("_cy"), cell))
    return joined.withColumn(out, F.coalesce(hit, F.lit(False))).drop("_cx", "_cy", "cx", "cy", "_parts")


def ocean_by_land(
    df: DataFrame, land_edges: DataFrame, cols: AssetCols = DEFAULT_COLS, cell_deg: float | None = None
) -> DataFrame:
    """Adds ``in_ocean`` = no land polygon contains the point (spatial left join -> anti)."""
    return on_land(df, land_edges, cols, cell_deg, out="_land").withColumn("in_ocean", ~F.col("_land")).drop("_land")
