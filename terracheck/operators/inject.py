"""Deterministic error injection (E1-E5): plant ocean coordinates, duplicate ids and
missing capacities so detectors can be measured against ``error_flags``.

Same seed, same output, whatever the partitioning.  Selections are exact
(``int(n * pct)`` rows): a narrow predicate on (hash, id).  Only the rows that
E1 and E2 select are shuffled, to be ranked; E3 shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.functions.geometry import OCEAN_ZONES
from terracheck.functions.rand import uniform
from terracheck.operators.sampling import bucket_counts, kth_cut, selected, with_hash_rank

OCEAN = "OCEAN_COORDS"
DUPLICATE = "DUPLICATE_ID"
MISSING = "MISSING_CAPACITY"


def _zone_value(rank_col, seed, step, key, axis):
    """Uniform inside the zone ``(rank - 1) % 3`` along ``axis`` (0 = lon, 1 = lat), rounded to 4."""
    lo_hi = [(z[0], z[1]) if axis == 0 else (z[2], z[3]) for z in OCEAN_ZONES]
    zone = (rank_col - 1) % len(OCEAN_ZONES)
    u = uniform(seed, step, key)
    expr = None
    for i, (lo, hi) in enumerate(lo_hi):
        val = F.round(F.lit(lo) + u * (hi - lo), 4)
        expr = F.when(zone == i, val) if expr is None else expr.when(zone == i, val)
    return expr


def inject_ocean(df: DataFrame, k: int, seed=99, cols: AssetCols = DEFAULT_COLS, counts=None) -> DataFrame:
    """K rows move into the ocean boxes, the i-th selected row into zone i % 3; flag ``_ocean``."""
    ranked = with_hash_rank(df, k, seed, "ocean", cols.row_id, "_orank", counts)
    key = F.col(cols.row_id)
    sel = F.col("_orank").isNotNull()
    return ranked.withColumns(
        {
            cols.lon: F.when(sel, _zone_value(F.col("_orank"), seed, "ocean_lon", key, 0)).otherwise(F.col(cols.lon)),
            cols.lat: F.when(sel, _zone_value(F.col("_orank"), seed, "ocean_lat", key, 1)).otherwise(F.col(cols.lat)),
            "_ocean": sel,
        }
    ).drop("_orank")


def inject_duplicates(df: DataFrame, k: int, seed=99, cols: AssetCols = DEFAULT_COLS, counts=None, max_id=None, ids=None) -> DataFrame:
    """Copies of k original rows are appended (a copy keeps any earlier flag); copies get
    row_id = max(row_id) + selection rank and flag ``_dup``.  ``ids``, a table of the row ids of
    ``df``, spares a scan of it where one is known."""
    ranked = with_hash_rank(df, k, seed, "duplicate", cols.row_id, "_drank", counts, ids)
    if max_id is None:
        max_id = df.agg(F.max(cols.row_id)).first()[0] or 0
    # One linear pass: a selected row is emitted twice (original, then its copy), so the
    # plan has no union and the ranking exchange is computed once.
    copy = F.explode(
        F.when(F.col("_drank").isNotNull(), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    )
    out = ranked.withColumn("_dup", copy)
    return out.withColumn(
        cols.row_id, F.when(F.col("_dup"), F.lit(max_id).cast("bigint") + F.col("_drank")).otherwise(F.col(cols.row_id))
    ).drop("_drank")


def inject_missing(df: DataFrame, k: int, seed=99, cols: AssetCols = DEFAULT_COLS, counts=None, ids=None) -> DataFrame:
    """K rows (copies included) lose their capacity; flag ``_missing``.  ``ids``, a table of the
    row ids of ``df``, spares a scan of it where one is known."""
    ids = df.select(cols.row_id) if ids is None else ids
    counts = counts if counts is not None else bucket_counts(ids, seed, ["missing"], cols.row_id)[0]["missing"]
    cut = kth_cut(ids, k, seed, "missing", counts, cols.row_id) if k > 0 and counts else None
    sel = selected(k, cut, seed, "missing", cols.row_id)
    return df.withColumns({cols.capacity: F.when(sel, F.lit(None).cast("double")).otherwise(F.col(cols.capacity)), "_missing": sel})


def inject_errors(
    df: DataFrame,
    pct_ocean: float = 0.05,
    pct_duplicate: float = 0.04,
    pct_missing: float = 0.08,
    seed: int = 99,
    cols: AssetCols = DEFAULT_COLS,
) -> DataFrame:
    """E5: E1 -> E2 -> E3 and the pipe-joined ``error_flags``.

    Two small jobs size everything: one pass over the row ids gives n, the largest
    id and the bucket counts of all three selections; the copies' ids are known in
    advance (max_id + 1 .. max_id + k2), so their buckets come from ``range``."""
    counts, n, max_id = bucket_counts(df, seed, ["ocean", "duplicate", "missing"], cols.row_id)
    n_dup = int(n * pct_duplicate)
    n_missing = int((n + n_dup) * pct_missing)
    missing_counts, originals = counts["missing"], df.select(cols.row_id)
    ids = originals
    if n_dup > 0 and n_missing > 0:
        copies = df.sparkSession.range(max_id + 1, max_id + n_dup + 1).withColumnRenamed("id", cols.row_id)
        extra, _, _ = bucket_counts(copies, seed, ["missing"], cols.row_id)
        merged: dict[int, int] = {}
        for b, c in missing_counts + extra["missing"]:
            merged[b] = merged.get(b, 0) + c
        missing_counts = list(merged.items())
        ids = ids.unionByName(copies)
    out = inject_ocean(df, int(n * pct_ocean), seed, cols, counts["ocean"])
    out = inject_duplicates(out, n_dup, seed, cols, counts["duplicate"], max_id, originals)
    out = inject_missing(out, n_missing, seed, cols, missing_counts, ids)
    flags = F.array_join(
        F.array_compact(
            F.array(
                F.when(F.col("_ocean"), F.lit(OCEAN)),
                F.when(F.col("_dup"), F.lit(DUPLICATE)),
                F.when(F.col("_missing"), F.lit(MISSING)),
            )
        ),
        "|",
    )
    return out.withColumn(cols.flags, flags).drop("_ocean", "_dup", "_missing")
