"""Polygon sources (S7): vertex tables, GeoJSON lines, and the grid-country fixture.

Polygons are carried as an *edge table* ``(iso_a3, part, ring, seq, x1, y1, x2, y2)``.
Rings are closed by pairing each vertex with the next one of its ring and the
last vertex with the first (``lead`` with ``first`` over a window partitioned
by ring, so every window is one ring: bounded, no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.session import cut_lineage

# The concave L drawn inside each nation's 72 x 36 degree cell,
# as (seq, dx, dy) offsets from the cell's lower-left corner.
L_SHAPE = ((0, 4.0, 2.0), (1, 68.0, 2.0), (2, 68.0, 18.0), (3, 36.0, 18.0), (4, 36.0, 34.0), (5, 4.0, 34.0))

NO_CODE = "-99"


def grid_country_vertices(nation: DataFrame) -> DataFrame:
    """One L-shaped polygon per nation inside its cell of the 5 x 5 world grid."""
    c = F.col("n_nationkey").cast("bigint")
    shape = F.array(*[F.struct(F.lit(q).alias("seq"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for q, dx, dy in L_SHAPE])
    cells = nation.select(c.alias("c"), F.inline(shape))
    return cells.select(
        F.concat(F.lit("C"), F.lpad(F.col("c").cast("string"), 2, "0")).alias("iso_a3"),
        F.lit(0).alias("part"),
        F.lit(0).alias("ring"),
        F.col("seq"),
        (F.lit(-180) + (F.col("c") % 5) * 72 + F.col("dx")).cast("double").alias("x"),
        (F.lit(-90) + ((F.col("c") - F.col("c") % 5) / 5) * 36 + F.col("dy")).cast("double").alias("y"),
    )


def vertices_to_edges(vertices: DataFrame) -> DataFrame:
    """Close every ring: edge i joins vertex i to vertex i+1, the last one to the first.  Rings that
    cross the antimeridian are split there (:func:`split_at_antimeridian`)."""
    ring = Window.partitionBy("iso_a3", "part", "ring").orderBy("seq")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = vertices.where(F.col("iso_a3") != NO_CODE).select(
        "iso_a3",
        "part",
        "ring",
        "seq",
        F.col("x").alias("x1"),
        F.col("y").alias("y1"),
        F.coalesce(F.lead("x").over(ring), F.first("x").over(whole)).alias("x2"),
        F.coalesce(F.lead("y").over(ring), F.first("y").over(whole)).alias("y2"),
    )
    # a ring stored closed (last vertex == first) yields one zero-length edge; drop it
    return split_at_antimeridian(edges.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))))


#: ``seq`` of the edges that close split rings along the antimeridian, or over a pole.
CLOSING = -1


def split_at_antimeridian(edges: DataFrame) -> DataFrame:
    """Edges of rings cut at +-180 degrees and closed again along it.

    An edge of more than 180 degrees of longitude runs the short way round, over the antimeridian
    (one between -180 and 180 itself lies along a split polygon's border and stays).  A ring that has
    such an edge is unrolled to continuous longitudes, its edges are cut at the odd multiples of
    180 degrees, and the pieces come back into [-180, 180].  Where a polygon part meets the
    antimeridian, between its first and second crossing by latitude, third and fourth, and so on,
    both sides get a closing edge.  A ring around a pole closes over the pole nearer to it.  All
    other rings come through as they are; a table without crossing rings, which a first look finds,
    is returned unchanged."""
    ring = Window.partitionBy("iso_a3", "part", "ring").orderBy("seq")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dx = F.col("x2") - F.col("x1")
    over = (F.abs(dx) > 180) & ~((F.abs("x1") == 180) & (F.abs("x2") == 180))
    if edges.where(over).isEmpty():
        return edges
    turn = F.when(over, F.when(dx > 0, -360.0).otherwise(360.0)).otherwise(0.0)
    before = ring.rowsBetween(Window.unboundedPreceding, -1)
    e = edges.withColumn("_turn", turn).withColumns(
        {
            "_crosses": F.max(F.col("_turn") != 0).over(whole),
            "_by": F.coalesce(F.sum("_turn").over(before), F.lit(0.0)),
            "_round": F.sum("_turn").over(whole),
            "_pole": F.when(F.avg("y1").over(whole) < 0, F.lit(-90.0)).otherwise(F.lit(90.0)),
            "_start": F.first(F.struct("x1", "y1")).over(whole),
            "_last": F.row_number().over(ring) == F.count(F.lit(1)).over(whole),
        }
    )
    names = ["iso_a3", "part", "ring", "seq", "x1", "y1", "x2", "y2"]
    plain = e.where(~F.col("_crosses")).select(names)
    rolled = e.where("_crosses").select(
        *names[:4], (F.col("x1") + F.col("_by")).alias("x1"), "y1", (F.col("x2") + F.col("_by") + F.col("_turn")).alias("x2"), "y2",
        "_round", "_pole", "_start", "_last",
    )
    # around a pole the unrolled ring ends a turn away from its start: up to the pole, along it, and back
    end = F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    over_end = F.struct(F.col("x2").alias("x"), F.col("_pole").alias("y"))
    over_start = F.struct(F.col("_start.x1").alias("x"), F.col("_pole").alias("y"))
    start = F.struct(F.col("_start.x1").alias("x"), F.col("_start.y1").alias("y"))
    steps = F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in ((end, over_end), (over_end, over_start), (over_start, start))])
    pole = rolled.where("_last AND _round <> 0").select(*names[:3], F.lit(CLOSING).alias("seq"), F.explode(steps).alias("s"))
    pole = pole.select(*names[:4], F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))
    rolled = rolled.select(names).unionByName(pole).withColumn("seq", F.col("seq").cast(edges.schema["seq"].dataType))

    # pieces of each edge in the turns (180 + 360 (k - 1), 180 + 360 k] that it meets
    turn_of = lambda x: F.ceil((x - 180) / 360)
    each = rolled.withColumn("k", F.explode(F.sequence(turn_of(F.least("x1", "x2")), turn_of(F.greatest("x1", "x2")))))
    west, east = F.col("k") * 360.0 - 180, F.col("k") * 360.0 + 180
    span = F.col("x2") - F.col("x1")

    def at(x, y):
        """The end ``(x, y)`` brought to the turn's borders along the edge."""
        to = F.least(east, F.greatest(west, x))
        return to, F.when(to == x, y).otherwise(F.col("y1") + (to - F.col("x1")) / F.when(span == 0, 1.0).otherwise(span) * (F.col("y2") - F.col("y1")))

    (xa, ya), (xb, yb) = at(F.col("x1"), F.col("y1")), at(F.col("x2"), F.col("y2"))
    shift = F.col("k") * 360.0
    pieces = each.select(*names[:4], (xa - shift).alias("x1"), ya.alias("y1"), (xb - shift).alias("x2"), yb.alias("y2"))
    pieces = pieces.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))

    # where edges pass from one turn to the next, by latitude
    passes = rolled.withColumns({"_k1": turn_of(F.col("x1")), "_k2": turn_of(F.col("x2"))}).where("_k1 <> _k2")
    passes = passes.withColumn("k", F.explode(F.sequence(F.least("_k1", "_k2"), F.greatest("_k1", "_k2") - 1)))
    height = F.col("y1") + (F.col("k") * 360.0 + 180 - F.col("x1")) / (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    line = Window.partitionBy("iso_a3", "part").orderBy("y")  # the crossings of one polygon with the antimeridian
    met = passes.select("iso_a3", "part", height.alias("y")).withColumns({"_to": F.lead("y").over(line), "_i": F.row_number().over(line)})
    sides = F.explode(F.array(F.lit(180.0), F.lit(-180.0)))
    closing = met.where("_i % 2 = 1 AND _to > y").select("iso_a3", "part", "y", "_to", sides.alias("x"))
    closing = closing.select(
        "iso_a3", "part", F.lit(CLOSING).alias("ring"), F.lit(CLOSING).alias("seq"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("_to").alias("y2")
    )
    return cut_lineage(plain.unionByName(pieces).unionByName(closing))


def grid_country_edges(nation: DataFrame) -> DataFrame:
    return vertices_to_edges(grid_country_vertices(nation))


def roughened_edges(edges: DataFrame, pieces: int) -> DataFrame:
    """A jagged coast: each edge cut into ``pieces``, with its inner vertices moved sideways by up to
    0.2 degrees in a fixed pattern. The edges must be horizontal or vertical."""
    k = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))
    cut = edges.select("iso_a3", "part", "ring", "seq", "x1", "y1", "x2", "y2", k.alias("k"))
    off = F.when(F.col("k") == 0, 0.0).otherwise((((F.col("seq") + 1) * F.col("k") * 7919) % 101 - 50).cast("double") / 250)
    level = F.col("y1") == F.col("y2")
    vertices = cut.select(
        "iso_a3",
        "part",
        "ring",
        (F.col("seq") * pieces + F.col("k")).alias("seq"),
        (F.col("x1") + (F.col("x2") - F.col("x1")) * F.col("k") / pieces + F.when(level, 0.0).otherwise(off)).alias("x"),
        (F.col("y1") + (F.col("y2") - F.col("y1")) * F.col("k") / pieces + F.when(level, off).otherwise(0.0)).alias("y"),
    )
    return vertices_to_edges(vertices)


_MULTI = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
_SINGLE = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))


def geojson_vertices(spark: SparkSession, path: str, code_field: str = "iso_a3") -> DataFrame:
    """Vertices from GeoJSON lines: one feature per line, Polygon or MultiPolygon geometry."""
    raw = spark.read.text(path)
    gtype = F.get_json_object("value", "$.geometry.type")
    coords = F.get_json_object("value", "$.geometry.coordinates")
    parts = F.when(gtype == "MultiPolygon", F.from_json(coords, _MULTI)).otherwise(
        F.array(F.from_json(coords, _SINGLE))
    )
    feats = raw.select(
        F.coalesce(
            F.get_json_object("value", f"$.properties.{code_field}"), F.get_json_object("value", f"$.{code_field}")
        ).alias("iso_a3"),
        parts.alias("parts"),
    )
    return (
        feats.select("iso_a3", F.posexplode("parts").alias("part", "rings"))
        .select("iso_a3", "part", F.posexplode("rings").alias("ring", "pts"))
        .select("iso_a3", "part", "ring", F.posexplode("pts").alias("seq", "pt"))
        .select("iso_a3", "part", "ring", "seq", F.col("pt")[0].alias("x"), F.col("pt")[1].alias("y"))
    )


def read_vertex_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored vertex table ``(iso_a3, part, ring, seq, x, y)``."""
    return spark.read.format(fmt).load(path).select("iso_a3", "part", "ring", "seq", "x", "y")
