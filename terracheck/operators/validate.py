"""Row validation (V9, V10) and asset validation with the border check (A1-A5).

Both are one projection over the input: no exchange, no Python.  Only the
border check adds a join, to the broadcast country edge arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols, require_columns
from terracheck.functions import rules as R
from terracheck.operators.geo import normalised_country, point_in_country


def record_rules(df: DataFrame, cols: AssetCols = DEFAULT_COLS, missing_year: str = "error"):
    """The V1-V8 rules of the 8-field record, in field order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []

    def have(name):
        return name in types

    def required_missing(field):
        return F.lit(f"{field}: {R.MSG_REQUIRED}")

    fields = [
        (cols.id, lambda c: R.id_rule(cols.id, c), True),
        (cols.name, lambda c: R.string_required(cols.name, c), True),
        (cols.capacity, lambda c: R.nonneg_optional(cols.capacity, R.coerce_double(c, types[cols.capacity])), False),
        (cols.lat, lambda c: R.bounded_number(cols.lat, c, -90, 90), True),
        (cols.lon, lambda c: R.bounded_number(cols.lon, c, -180, 180), True),
        (cols.country, lambda c: R.exact_length(cols.country, c, 3), True),
        (cols.fuel, lambda c: R.string_required(cols.fuel, c), True),
        (
            cols.year,
            lambda c: R.optional_int_range(cols.year, c, types[cols.year], 1900, 2100, missing_year),
            False,
        ),
    ]
    for name, rule, required in fields:
        if have(name):
            out.append(rule(F.col(name)))
        elif required:
            out.append(required_missing(name))
    return out


def validate_records(df: DataFrame, cols: AssetCols = DEFAULT_COLS, missing_year: str = "error") -> DataFrame:
    """V9: adds ``pydantic_valid`` and ``pydantic_errors`` ("field: msg" joined by ", ")."""
    errors = R.join_messages(record_rules(df, cols, missing_year), ", ")
    return df.withColumn("pydantic_errors", errors).withColumn("pydantic_valid", F.col("pydantic_errors") == "")


def validate_summary(validated: DataFrame) -> DataFrame:
    """Rows checked and rows failing."""
    return validated.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("pydantic_valid")).alias("n_invalid"),
    )


def asset_rules(df: DataFrame, cols: AssetCols = DEFAULT_COLS, legacy_nulls: bool = False):
    """A3-A4 + V4-V7 for the 5-field asset: id, latitude, longitude, capacity, country."""
    types = {f.name: f.dataType for f in df.schema.fields}
    ident = F.col(cols.id).cast("string")
    country = F.col(cols.country).cast("string")
    if legacy_nulls:  # str() of a pandas missing value is 'nan'
        ident = F.coalesce(ident, F.lit("nan"))
        country = F.coalesce(country, F.lit("nan"))
    return [
        R.id_rule("id", ident, R.MSG_ASSET_ID_BLANK),
        R.bounded_number("latitude", F.col(cols.lat), -90, 90),
        R.bounded_number("longitude", F.col(cols.lon), -180, 180),
        R.nonneg_optional("capacity_mw", R.coerce_double(F.col(cols.capacity), types[cols.capacity])),
        R.exact_length("country", country, 3),
    ]


def validate_assets(
    df: DataFrame,
    country_edges: DataFrame,
    cols: AssetCols = DEFAULT_COLS,
    buffer_deg: float = 0.5,
    legacy_nulls: bool = False,
) -> DataFrame:
    """A5: adds ``asset_valid``, ``asset_errors`` and ``geometry_consistent``.

    The border check runs only for rows whose fields all pass, so a field-invalid
    row keeps ``geometry_consistent = True``.  Field messages are joined by " | ".
    """
    require_columns(df, {cols.id, cols.lat, cols.lon, cols.capacity, cols.country}, "asset table")
    field_errors = R.join_messages(asset_rules(df, cols, legacy_nulls), " | ")
    checked = point_in_country(df.withColumn("_ferr", field_errors), country_edges, cols, buffer_deg, out="_inside")
    fields_ok = F.col("_ferr") == ""
    border_fail = fields_ok & ~F.col("_inside")
    code = normalised_country(cols)
    border_msg = F.concat(
        F.lit("Value error, Coordinates ("),
        F.col(cols.lat).cast("string"),
        F.lit(", "),
        F.col(cols.lon).cast("string"),
        F.lit(") do not fall within the borders of '"),
        code,
        F.lit("'. Possible country mis-assignment or coordinate error."),
    )
    return checked.withColumns(
        {
            "asset_valid": fields_ok & F.col("_inside"),
            "asset_errors": F.when(border_fail, border_msg).otherwise(F.col("_ferr")),
            "geometry_consistent": ~border_fail,
        }
    ).drop("_ferr", "_inside")
