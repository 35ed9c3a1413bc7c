"""Column-name parameters and the asset schema.

Every operator receives an :class:`AssetCols` so it runs on any table whose
columns carry other names; nothing is renamed physically.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class AssetCols:
    row_id: str = "row_id"
    id: str = "gppd_idnr"
    name: str = "name"
    capacity: str = "capacity_mw"
    lat: str = "latitude"
    lon: str = "longitude"
    country: str = "country"
    fuel: str = "primary_fuel"
    year: str = "commissioning_year"
    flags: str = "error_flags"


DEFAULT_COLS = AssetCols()

# The eight source columns of an asset table, in their canonical order.
ASSET_FIELDS = (
    "gppd_idnr",
    "name",
    "capacity_mw",
    "latitude",
    "longitude",
    "country",
    "primary_fuel",
    "commissioning_year",
)

ASSET_SCHEMA = T.StructType(
    [
        T.StructField("gppd_idnr", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("capacity_mw", T.DoubleType(), True),
        T.StructField("latitude", T.DoubleType(), True),
        T.StructField("longitude", T.DoubleType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("primary_fuel", T.StringType(), True),
        T.StructField("commissioning_year", T.IntegerType(), True),
    ]
)


def require_columns(df, names, what: str = "DataFrame") -> None:
    """Raise naming the missing set (driver-side check on the schema only)."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
