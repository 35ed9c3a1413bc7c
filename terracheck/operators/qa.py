"""Rule-based QA issue report.

One issue row per finding: ocean placement, duplicated id, missing capacity.
The report is built in a single pass over the table: each row carries an
array of its issue structs which is exploded, so the input is scanned once and
the only shuffle is the id count (map-side combined, skew split by AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.functions.geometry import OCEAN_ZONES, in_boxes
OCEAN = "OCEAN_COORDS"
DUPLICATE = "DUPLICATE_ID"
MISSING = "MISSING_CAPACITY"

ISSUE_COLUMNS = ("row_id", "gppd_idnr", "plant_name", "issue_type", "detail", "capacity_mw")


def id_counts(df: DataFrame, cols: AssetCols = DEFAULT_COLS, min_count: int = 2) -> DataFrame:
    """Per non-null id, its row count, keeping ids that occur at least ``min_count`` times.

    ``groupBy`` does a partial (map-side) count first, so a hot id costs one
    row per map task in the shuffle.
    """
    return (
        df.where(F.col(cols.id).isNotNull())
        .groupBy(cols.id)
        .agg(F.count(F.lit(1)).alias("id_count"))
        .where(F.col("id_count") >= min_count)
    )


def duplicate_ids(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """Every row whose (non-null) id occurs more than once, with that count."""
    return df.join(id_counts(df, cols), on=cols.id, how="inner")


def with_ocean_flag(df: DataFrame, cols: AssetCols = DEFAULT_COLS, mode: str = "bbox", land=None) -> DataFrame:
    """Adds boolean ``in_ocean``: ``mode='bbox'`` (the three boxes) or ``mode='land'`` (no land polygon contains it)."""
    if mode == "bbox":
        return df.withColumn("in_ocean", in_boxes(F.col(cols.lat), F.col(cols.lon), OCEAN_ZONES))
    if mode == "land":
        if land is None:
            raise ValueError("mode='land' needs a land polygon table (see terracheck.sources.polygons)")
        from terracheck.operators.geo import ocean_by_land

        return ocean_by_land(df, land, cols)
    raise ValueError(f"unknown ocean mode {mode!r}; use 'bbox' or 'land'")


def _issue(kind: str, detail):
    return F.struct(F.lit(kind).alias("issue_type"), detail.alias("detail"))


KINDS = (OCEAN, DUPLICATE, MISSING)


def detect_qa_errors(
    df: DataFrame,
    cols: AssetCols = DEFAULT_COLS,
    mode: str = "bbox",
    land=None,
    kinds=KINDS,
) -> DataFrame:
    """Q5: union of ocean, duplicate-id and missing-capacity issues, one row per finding; only what
    ``kinds`` names is computed.

    Lazy: nothing runs before the report does.  Spark broadcasts the duplicated ids when the run
    shows that they are few, and splits skewed ids otherwise.  A missing coordinate is written
    ``nan``; a NaN capacity is missing."""
    joined, found = df, []
    if OCEAN in kinds:
        joined = with_ocean_flag(joined, cols, mode, land)
        lat, lon = (F.when(F.isnan(c) | F.col(c).isNull(), "nan").otherwise(F.col(c).cast("string")) for c in (cols.lat, cols.lon))
        found.append(F.when(F.col("in_ocean"), _issue(OCEAN, F.concat(F.lit("lat="), lat, F.lit(", lon="), lon))))
    if DUPLICATE in kinds:
        joined = joined.join(id_counts(df, cols), on=cols.id, how="left")
        times = F.concat(F.lit("appears "), F.col("id_count").cast("string"), F.lit("x"))
        found.append(F.when(F.col("id_count").isNotNull(), _issue(DUPLICATE, times)))
    if MISSING in kinds:
        gone = F.col(cols.capacity).isNull() | F.isnan(cols.capacity)
        found.append(F.when(gone, _issue(MISSING, F.lit("capacity_mw is NaN"))))
    issues = F.array_compact(F.array(*found))
    name = F.coalesce(F.col(cols.name), F.lit("")) if cols.name in df.columns else F.lit("")
    return joined.select(
        F.col(cols.row_id).alias("row_id"),
        F.col(cols.id).alias("gppd_idnr"),
        name.alias("plant_name"),
        F.col(cols.capacity).alias("capacity_mw"),
        F.explode(issues).alias("issue"),
    ).select(
        "row_id",
        "gppd_idnr",
        "plant_name",
        F.col("issue.issue_type").alias("issue_type"),
        F.col("issue.detail").alias("detail"),
        "capacity_mw",
    )


def qa_issue_type(df: DataFrame, kind: str, cols: AssetCols = DEFAULT_COLS, mode: str = "bbox", land=None) -> DataFrame:
    """Q2/Q3/Q4: the issues of one type."""
    return detect_qa_errors(df, cols, mode, land, (kind,))


def qa_issue_counts(issues: DataFrame) -> DataFrame:
    """Q6: flagged rows and distinct ids per issue type."""
    return issues.groupBy("issue_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("gppd_idnr").alias("n_ids"),
    )
