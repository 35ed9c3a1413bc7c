"""Chart- and map-ready tables (C1-C7): the data behind the reference's HTML map and
dashboard, computed in Spark; rendering stays with whichever plotting tool reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.functions.text import py_fixed
from terracheck.operators.quantiles import exact_quantiles_row
from terracheck.session import attach_row

# Marker colours and opacities, popup status and score colour, radius range, histogram
# bins, threshold line.
CLEAN = ("clean", "#2980b9", "#5dade2", 0.55, "✅ CLEAN", "#27ae60")
ANOMALOUS = ("anomalous", "#e74c3c", "#ff6b6b", 0.85, "🔴 ANOMALY", "#e74c3c")
RADIUS_MIN, RADIUS_SPAN = 4.0, 14.0
N_BINS = 40
THRESHOLD_LINE = 0.60
MISSING_CAPACITY_FOR_RADIUS = 100.0


def map_centre(scored: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """Median latitude and median longitude."""
    q = exact_quantiles_row(scored, [cols.lat, cols.lon], 0.5, "_median")
    return q.select(F.col(cols.lat + "_median").alias("centre_lat"), F.col(cols.lon + "_median").alias("centre_lon"))


def _radius_source(scored: DataFrame, cols: AssetCols):
    if "cap_filled" in scored.columns:
        return F.col("cap_filled")
    return F.coalesce(F.col(cols.capacity), F.lit(MISSING_CAPACITY_FOR_RADIUS))


def marker_radius(scored: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """4 + 14 (log1p(cap) - min) / (max - min + 1e-9) with a one-row min/max broadcast."""
    r = F.log1p(_radius_source(scored, cols))
    mm = scored.agg(F.min(r).alias("_rmin"), F.max(r).alias("_rmax"))
    lo, hi = F.col("_rmin"), F.col("_rmax")
    out = attach_row(scored, mm).withColumn("radius", RADIUS_MIN + RADIUS_SPAN * (r - lo) / (hi - lo + F.lit(1e-9)))
    return out.drop("_rmin", "_rmax")


def marker_table(scored: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """One marker per row: layer, colours, opacity, radius, tooltip and popup fields."""
    x = marker_radius(scored, cols)
    anom = F.col("IS_ANOMALY")

    def pick(i):
        return F.when(anom, F.lit(ANOMALOUS[i])).otherwise(F.lit(CLEAN[i]))

    name = F.coalesce(F.col(cols.name), F.col(cols.id)) if cols.name in scored.columns else F.col(cols.id)
    tooltip = F.concat(F.when(anom, F.lit("⚠ ")).otherwise(F.lit("")), name, F.lit(" | Score: "), py_fixed(F.col("ANOMALY_SCORE"), 2))
    opt = lambda c: F.col(c).cast("string") if c in scored.columns else F.lit("N/A")
    capacity = F.coalesce(opt(cols.capacity), F.lit("nan")) if cols.capacity in scored.columns else F.lit("N/A")
    capacity = F.when(capacity == "NaN", "nan").otherwise(capacity)
    return x.select(
        cols.row_id,
        pick(0).alias("layer"),
        pick(1).alias("color"),
        pick(2).alias("fill_color"),
        pick(3).alias("fill_opacity"),
        "radius",
        F.col(cols.lat).alias("latitude"),
        F.col(cols.lon).alias("longitude"),
        tooltip.alias("tooltip"),
        name.alias("popup_name"),
        opt(cols.id).alias("popup_id"),
        opt(cols.country).alias("popup_country"),
        opt(cols.fuel).alias("popup_fuel"),
        pick(4).alias("popup_status"),
        F.concat(capacity, F.lit(" MW")).alias("popup_capacity"),
        opt("model_used").alias("popup_model"),
        pick(5).alias("popup_score_color"),
        py_fixed(F.col("ANOMALY_SCORE"), 3).alias("popup_score"),
        F.concat(py_fixed(F.col(cols.lat), 4), F.lit(", "), py_fixed(F.col(cols.lon), 4)).alias("popup_latlon"),
    )


def layer_counts(scored: DataFrame) -> DataFrame:
    """C4: markers per layer."""
    return scored.groupBy(F.when(F.col("IS_ANOMALY"), F.lit(ANOMALOUS[0])).otherwise(F.lit(CLEAN[0])).alias("layer")).agg(
        F.count(F.lit(1)).alias("count")
    )


def score_histogram(scored: DataFrame, bins: int = N_BINS) -> DataFrame:
    """Fixed bins on [0, 1] split by flag, plus the threshold line position."""
    b = F.least(F.greatest(F.floor(F.col("ANOMALY_SCORE") * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        scored.groupBy(b.alias("bin"), F.col("IS_ANOMALY").alias("is_anomaly"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumns({"bin_start": F.col("bin") / bins, "bin_end": (F.col("bin") + 1) / bins, "threshold": F.lit(THRESHOLD_LINE)})
    )


def marker_density(scored: DataFrame, cols: AssetCols = DEFAULT_COLS, cell_deg: float = 1.0) -> DataFrame:
    """C3 at scale: the marker layers as a grid-cell density table (markers, mean score and
    centre per cell and layer) - what a map can draw when there are billions of assets."""
    cx = F.floor(F.col(cols.lon) / cell_deg)
    cy = F.floor(F.col(cols.lat) / cell_deg)
    layer = F.when(F.col("IS_ANOMALY"), F.lit(ANOMALOUS[0])).otherwise(F.lit(CLEAN[0]))
    return (
        scored.where(F.col(cols.lat).isNotNull() & F.col(cols.lon).isNotNull())
        .groupBy(cx.alias("cell_x"), cy.alias("cell_y"), layer.alias("layer"))
        .agg(F.count(F.lit(1)).alias("markers"), F.round(F.avg("ANOMALY_SCORE"), 6).alias("mean_score"))
        .withColumns(
            {
                "centre_lon": (F.col("cell_x") + 0.5) * cell_deg,
                "centre_lat": (F.col("cell_y") + 0.5) * cell_deg,
            }
        )
    )


#: Zoom levels of a tile pyramid: 2^zoom tiles along each side of the map.
ZOOMS = (0, 2, 4, 6, 8)


def _spread_bits(v: Column) -> Column:
    """The lower 16 bits of ``v`` with a zero between any two."""
    for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, step)).bitwiseAND(F.lit(mask).cast("bigint"))
    return v


def marker_pyramid(scored: DataFrame, cols: AssetCols = DEFAULT_COLS, zooms=ZOOMS) -> DataFrame:
    """C3 at scale, for every zoom of a map: markers, mean score and middle of each tile and layer.

    A marker's tile at the deepest zoom is one Morton code, whose leading bits are its tiles at all
    others, so one aggregation over grouping sets of codes serves every level.  Tiles cut longitude
    and latitude evenly, from the north-west corner; markers without a place are left out."""
    deep = max(zooms)
    if deep > 16:
        raise ValueError("zoom levels go up to 16")
    side = 1 << deep
    x = F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor((F.col(cols.lon) + 180) / 360 * side))).cast("bigint")
    y = F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor((90 - F.col(cols.lat)) / 180 * side))).cast("bigint")
    code = _spread_bits(F.col("_x")).bitwiseOR(F.shiftleft(_spread_bits(F.col("_y")), 1))
    layer = F.when(F.col("IS_ANOMALY"), F.lit(ANOMALOUS[0])).otherwise(F.lit(CLEAN[0]))
    places = scored.where(F.col(cols.lat).isNotNull() & F.col(cols.lon).isNotNull() & ~F.isnan(cols.lat) & ~F.isnan(cols.lon))
    # scores have four decimals: summed as whole numbers, means do not depend on the order of rows
    units = F.round(F.col("ANOMALY_SCORE") * 10_000).cast("bigint")
    placed = places.select(layer.alias("layer"), x.alias("_x"), y.alias("_y"), units.alias("_units")).withColumn("_code", code)
    deepest = placed.groupBy("_code", "layer").agg(
        F.count(F.lit(1)).alias("_n"), F.count("_units").alias("_scored"), F.sum("_units").alias("_units"), F.min("_x").alias("_x"), F.min("_y").alias("_y")
    )
    levels = {z: f"_z{z}" for z in zooms}
    coded = deepest.withColumns({name: F.shiftright("_code", 2 * (deep - z)) for z, name in levels.items()})
    tiles = coded.groupingSets([["layer", name] for name in levels.values()], "layer", *levels.values()).agg(
        F.sum("_n").alias("markers"), F.sum("_scored").alias("_scored"), F.sum("_units").alias("_sum"), F.min("_x").alias("_x"), F.min("_y").alias("_y")
    )
    zoom = F.coalesce(*[F.when(F.col(name).isNotNull(), F.lit(z)) for z, name in levels.items()])
    width = F.pow(F.lit(2.0), F.col("zoom"))
    up = F.expr(f"CAST({deep} - zoom AS INT)")
    return (
        tiles.withColumns({"zoom": zoom, "tile": F.coalesce(*levels.values())})
        .withColumns({"tile_x": F.call_function("shiftright", "_x", up), "tile_y": F.call_function("shiftright", "_y", up)})
        .select(
            "zoom", "tile", "tile_x", "tile_y", "layer", "markers",
            (F.col("_sum") / F.col("_scored") / 10_000).alias("mean_score"),
            ((F.col("tile_x") + 0.5) * 360 / width - 180).alias("centre_lon"),
            (90 - (F.col("tile_y") + 0.5) * 180 / width).alias("centre_lat"),
        )
    )


def scatter_series(scored: DataFrame, cols: AssetCols = DEFAULT_COLS, sample_n: int | None = None) -> DataFrame:
    """(latitude, capacity NULL -> 0) and (longitude, latitude) points with their flag;
    ``sample_n`` caps a chart at an exact, repeatable sample of points."""
    if sample_n is not None:
        from terracheck.operators.sampling import sample_exact_n

        scored = sample_exact_n(scored, sample_n, seed=42, step="scatter", row_id=cols.row_id).drop("sample_rank")
    cap = F.col("cap_filled") if "cap_filled" in scored.columns else F.col(cols.capacity)
    return scored.select(
        cols.row_id,
        F.col("IS_ANOMALY").alias("is_anomaly"),
        F.col(cols.lat).alias("latitude"),
        F.coalesce(cap, F.lit(0.0)).alias("capacity_y"),
        F.col(cols.lon).alias("longitude"),
        F.col(cols.country).alias("country"),
    )


def country_anomaly_rate(scored: DataFrame, cols: AssetCols = DEFAULT_COLS, k: int = 20) -> DataFrame:
    """Per country anomalies, total and rate; the k countries with most anomalies, shown by rate."""
    stats = (
        scored.where(F.col(cols.country).isNotNull())
        .groupBy(cols.country)
        .agg(F.count_if("IS_ANOMALY").alias("anomalies"), F.count(F.lit(1)).alias("total"))
        .withColumn("rate", F.round(F.col("anomalies") / F.col("total"), 6))
    )
    top = stats.orderBy(F.desc("anomalies"), cols.country).limit(k)
    return top.orderBy("rate", cols.country)
