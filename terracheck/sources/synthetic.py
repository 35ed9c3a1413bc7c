"""Synthetic asset rows (S2) keyed by any id column, repeatable by hash uniforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.functions.rand import uniform

# Fuels and countries of the reference's synthetic generator.
FUELS = ("Coal", "Gas", "Wind", "Solar", "Hydro", "Nuclear", "Oil")
COUNTRIES = ("USA", "CHN", "IND", "DEU", "BRA", "ZAF", "AUS")


def synthetic_assets(keys: DataFrame, key_col: str, seed: int = 0) -> DataFrame:
    """One asset row per key: id ``WRI%06d``, cap U(10,3000) r1, lat U(-60,75) r4,
    lon U(-180,180) r4, one of 7 countries and 7 fuels, year in [1950, 2023)."""
    k = F.col(key_col)

    def pick(values, step):
        idx = F.floor(uniform(seed, step, k) * len(values)).cast("int") + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), idx)

    return keys.select(
        k.alias("row_id"),
        F.concat(F.lit("WRI"), F.lpad(k.cast("string"), 6, "0")).alias("gppd_idnr"),
        F.concat(F.lit("Plant_"), k.cast("string")).alias("name"),
        F.round(F.lit(10.0) + uniform(seed, "capacity", k) * 2990.0, 1).alias("capacity_mw"),
        F.round(F.lit(-60.0) + uniform(seed, "latitude", k) * 135.0, 4).alias("latitude"),
        F.round(F.lit(-180.0) + uniform(seed, "longitude", k) * 360.0, 4).alias("longitude"),
        pick(COUNTRIES, "country").alias("country"),
        pick(FUELS, "fuel").alias("primary_fuel"),
        (F.lit(1950) + F.floor(uniform(seed, "year", k) * 73)).cast("int").alias("commissioning_year"),
    )
