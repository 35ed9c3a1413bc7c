"""Planar geometry as Spark column expressions (no UDF, no geometry type).

Polygons travel as arrays of edge structs ``(x1, y1, x2, y2)``.  Point-in-polygon
is the even-odd rule over all edges, so holes and multi-part polygons need no
special casing; "within a buffer" is inside-or-closer-than-the-buffer to an edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three mid-ocean boxes of the reference, as
# (lon_min, lon_max, lat_min, lat_max), all bounds closed.
OCEAN_ZONES = (
    (-170.0, -120.0, -10.0, 10.0),  # Central Pacific
    (-40.0, -20.0, 5.0, 20.0),  # Mid-Atlantic
    (60.0, 90.0, -30.0, -10.0),  # Indian Ocean
)


def in_boxes(lat: Column, lon: Column, zones=OCEAN_ZONES) -> Column:
    """OR of closed lon/lat boxes.  NULL coordinates are not in any box."""
    cond = F.lit(False)
    for lon0, lon1, lat0, lat1 in zones:
        cond = cond | (lat.between(lat0, lat1) & lon.between(lon0, lon1))
    return F.coalesce(cond, F.lit(False))


def _crosses(e: Column, px: Column, py: Column) -> Column:
    """Does the ray from (px, py) towards +x cross edge e?  Horizontal edges never do."""
    dy = F.when(e["y2"] == e["y1"], F.lit(1.0)).otherwise(e["y2"] - e["y1"])
    x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / dy + e["x1"]
    return ((e["y1"] > py) != (e["y2"] > py)) & (px < x_at)


def _x_at(e: Column, y: Column) -> Column:
    """x of edge ``e`` at height ``y``, never beyond its ends."""
    dy = F.when(e["y2"] == e["y1"], F.lit(1.0)).otherwise(e["y2"] - e["y1"])
    x = (e["x2"] - e["x1"]) * (y - e["y1"]) / dy + e["x1"]
    return F.greatest(F.least(e["x1"], e["x2"]), F.least(F.greatest(e["x1"], e["x2"]), x))


def x_where_crossed(e: Column, y: Column) -> Column:
    """x where edge ``e`` crosses height ``y``; NULL where it does not."""
    return F.when((e["y1"] > y) != (e["y2"] > y), _x_at(e, y))


def crosses_right_of(e: Column, x: Column, y: Column) -> Column:
    """Does edge ``e`` cross height ``y`` to the right of ``x``?"""
    return ((e["y1"] > y) != (e["y2"] > y)) & (_x_at(e, y) > x)


def _above(e: Column, x: Column, y: Column) -> Column:
    """For an edge that crosses the vertical line at ``x``: does it pass above ``(x, y)``?"""
    right = F.when(e["x2"] > e["x1"], e["y2"]).otherwise(e["y1"])
    return (right > y) != crosses_right_of(e, x, y)


def crossing_count(edges: Column, px: Column, py: Column) -> Column:
    return F.size(F.filter(edges, lambda e: _crosses(e, px, py)))


def inside(edges: Column, px: Column, py: Column) -> Column:
    """Even-odd point-in-polygon over an edge array (points on an edge may go either way)."""
    return crossing_count(edges, px, py) % 2 == 1


def inside_by_reference(ref_inside: Column, local: Column, px: Column, py: Column, rx: Column, ry: Column) -> Column:
    """Even-odd test of ``(px, py)`` from a reference point ``(rx, ry)`` known to be inside or not.

    The path runs along ``y = py`` to ``rx`` and then along ``x = rx`` to ``ry``; only edges that meet
    it change the answer, so ``local`` needs no others. Both legs decide by the same ``x`` of an edge
    at a height, which makes the sum over all edges of closed rings equal to the ray's count exactly,
    rounding included."""

    def changes(e: Column) -> Column:
        along_y = crosses_right_of(e, px, py) != crosses_right_of(e, rx, py)
        along_x = ((e["x1"] > rx) != (e["x2"] > rx)) & (_above(e, rx, py) != _above(e, rx, ry))
        return along_y != along_x

    return ref_inside != (F.size(F.filter(local, changes)) % 2 == 1)


def _dist2(e: Column, px: Column, py: Column) -> Column:
    dx = e["x2"] - e["x1"]
    dy = e["y2"] - e["y1"]
    len2 = dx * dx + dy * dy
    t = F.greatest(
        F.lit(0.0),
        F.least(F.lit(1.0), ((px - e["x1"]) * dx + (py - e["y1"]) * dy) / F.when(len2 == 0, 1.0).otherwise(len2)),
    )
    return F.pow(px - (e["x1"] + t * dx), 2) + F.pow(py - (e["y1"] + t * dy), 2)


def min_edge_distance(edges: Column, px: Column, py: Column) -> Column:
    """Planar distance from (px, py) to the nearest edge (NULL for an empty array)."""
    return F.sqrt(F.array_min(F.transform(edges, lambda e: _dist2(e, px, py))))


def within_buffer(edges: Column, px: Column, py: Column, buffer_deg: float) -> Column:
    """Strictly within the polygon grown by ``buffer_deg``: inside, or nearer than the buffer to an edge."""
    return inside(edges, px, py) | F.coalesce(min_edge_distance(edges, px, py) < buffer_deg, F.lit(False))
