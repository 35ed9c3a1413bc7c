"""Asset-table sources.

* :func:`scan_assets` reads CSV or Parquet with an explicit schema and keeps the
  eight asset columns only (column pruning reaches the scan).
* :func:`tpch_assets` derives a geolocated asset table from ``orders`` and
  ``customer``; it plants nulls, negative capacities, bad latitudes and years,
  unknown countries, foreign and near-border placements and 4 % duplicate ids.
  The same derivation is written as SQL for the DuckDB oracle.
* :func:`normalise_nulls` makes NaN and NULL one thing, once, at the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.columns import ASSET_FIELDS, ASSET_SCHEMA, DEFAULT_COLS, AssetCols
from terracheck.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def scan_assets(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None) -> DataFrame:
    """Read an asset file with an explicit schema and project the 8 asset columns.

    Extra file columns are never materialised (CSV column pruning / Parquet
    ReadSchema).  Any Spark-readable URI works (object stores, HDFS, local).  Whole numbers are
    read through DOUBLE, so ``2013.0`` is the year 2013; a fraction is no year and becomes NULL.
    NaN, text or number, is NULL from here on (:func:`normalise_nulls`).  A file without one of
    the columns raises, whatever its format.
    """
    reader = spark.read
    if fmt == "csv":
        # CSV carries all columns; declare them as strings we then project and cast,
        # so files with extra columns in any order still load.
        df = reader.option("header", True).option("enforceSchema", False).csv(path)
        return normalise_nulls(df.select([_typed(f).alias(f.name) for f in (schema or ASSET_SCHEMA).fields]))
    df = reader.format(fmt).load(path)
    return normalise_nulls(df.select([_typed(f).alias(f.name) for f in (schema or ASSET_SCHEMA).fields]))


def _typed(field: T.StructField) -> Column:
    if not isinstance(field.dataType, T.IntegralType):
        return F.col(field.name).try_cast(field.dataType)
    number = F.col(field.name).try_cast("double")
    return F.when(number == F.floor(number), number.try_cast(field.dataType))


def _lpad_key(k: Column, width: int) -> Column:
    return F.lpad(k.cast("string"), width, "0")


def tpch_assets(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Derive ``row_id`` + the 8 asset columns from orders x customer.

    Each nation owns one 72 x 36 degree cell of a 5 x 5 world grid; assets are
    placed inside their nation's cell, except every 20th order (placed in the
    cell of nation n+7) and the k % 20 = 7 rows (placed near the cell's inner
    corner).  Orders with k % 25 = 3 get a clean duplicate row with the same id.
    """
    # Fixed values of the fixture derivation (must equal the oracle SQL):
    # grid origin (-180, -90), cell 72 x 36 degrees, 5 cells per grid row,
    # id prefix 'WRI' padded to 8 digits, name prefix 'Plant_', country 'C' + 2 digits,
    # unknown country 'XX', multipliers 104729 and 7919.
    base = orders.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_totalprice").alias("cap0"),
        F.col("o_custkey"),
        F.col("o_orderpriority").alias("fuel"),
    ).join(
        customer.select(F.col("c_custkey"), F.col("c_nationkey").cast("bigint").alias("n")),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    k, n = F.col("k"), F.col("n")
    cell = F.when(k % 20 == 0, (n + 7) % 25).otherwise(n)

    # Left-to-right sums, term by term, so doubles round exactly as the SQL text does.
    def row_lat(c: Column, shift: int, frac_part: Column) -> Column:
        return F.lit(-90) + ((c - c % 5) / 5) * 36 + shift + frac_part

    def row_lon(c: Column, shift: int, frac_part: Column) -> Column:
        return F.lit(-180) + (c % 5) * 72 + shift + frac_part

    frac = lambda mult, mod: ((k * mult) % mod).cast("double") / 100
    gid = F.concat(F.lit("WRI"), _lpad_key(k, 8))
    name = F.concat(F.lit("Plant_"), k.cast("string"))
    code = F.concat(F.lit("C"), _lpad_key(n, 2))

    # One pass over orders x customer: rows with k % 25 = 3 are emitted twice, the
    # second time (copy = 1) as a clean duplicate placed in its own nation's cell.
    rows = base.withColumn("copy", F.explode(F.when(k % 25 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    dup = F.col("copy") == 1
    return rows.select(
        (k * 2 + F.col("copy")).alias("row_id"),
        gid.alias("gppd_idnr"),
        name.alias("name"),
        F.when(dup, F.col("cap0") / 100)
        .when(k % 12 == 5, F.lit(None).cast("double"))
        .when(k % 50 == 9, -1 * F.col("cap0") / 100)
        .otherwise(F.col("cap0") / 100)
        .alias("capacity_mw"),
        F.when(dup, row_lat(n, 2, frac(104729, 1600)))
        .when(k % 333 == 1, F.lit(95.5))
        .when(k % 20 == 7, row_lat(cell, 18, frac(104729, 100)))
        .otherwise(row_lat(cell, 2, frac(104729, 1600)))
        .alias("latitude"),
        F.when(dup, row_lon(n, 4, frac(7919, 6400)))
        .when(k % 20 == 7, row_lon(cell, 40, frac(7919, 2000)))
        .otherwise(row_lon(cell, 4, frac(7919, 6400)))
        .alias("longitude"),
        F.when(~dup & (k % 501 == 2), F.lit("XX")).otherwise(code).alias("country"),
        F.col("fuel").alias("primary_fuel"),
        F.when(dup, 1900 + k % 121)
        .when(k % 2 == 0, F.lit(None))
        .when(k % 97 == 1, F.lit(2150))
        .otherwise(1900 + k % 121)
        .cast("int")
        .alias("commissioning_year"),
    )


def load_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived asset table of a test-data folder (orders x customer)."""
    return tpch_assets(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))


def normalise_nulls(df: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """S3: NaN -> NULL on every double column; a null ``error_flags`` means no error."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.nullif(c, F.lit(float("nan")).cast(field.dataType))
        elif field.name == cols.flags:
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(field.name))
    return df.select(out)


def project_existing(df: DataFrame, wanted) -> DataFrame:
    """Keep, in the given order, those wanted columns that exist."""
    return df.select([c for c in wanted if c in df.columns])


def point_wkt(df: DataFrame, cols: AssetCols = DEFAULT_COLS, decimals: int = 4) -> DataFrame:
    """Keep lon/lat as doubles, add a ``struct`` point and a WKT text of fixed decimals."""
    from terracheck.functions.text import py_fixed

    lon, lat = F.col(cols.lon), F.col(cols.lat)
    text = F.concat(F.lit("POINT ("), py_fixed(lon, decimals), F.lit(" "), py_fixed(lat, decimals), F.lit(")"))
    return df.withColumns(
        {
            "geometry": F.struct(lon.alias("x"), lat.alias("y")),
            "wkt": F.when(lon.isNotNull() & lat.isNotNull(), text),
        }
    )


__all__ = [
    "ASSET_FIELDS",
    "load_assets",
    "normalise_nulls",
    "point_wkt",
    "project_existing",
    "read_table",
    "scan_assets",
    "tpch_assets",
]


def supplier_assets(supplier: DataFrame) -> DataFrame:
    """A second asset table, one row per supplier, placed in its nation's grid cell.

    Nations hold 1 to 10 suppliers at sf0.01, which exercises the >= 10 rows rule
    of per-country models; ``s_acctbal`` (some negative) is the capacity.
    """
    k = F.col("s_suppkey")
    n = F.col("s_nationkey").cast("bigint")
    return supplier.select(
        k.alias("row_id"),
        F.concat(F.lit("SUP"), F.lpad(k.cast("string"), 8, "0")).alias("gppd_idnr"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("capacity_mw"),
        (F.lit(-90) + ((n - n % 5) / 5) * 36 + 2 + ((k * 104729) % 1600).cast("double") / 100).alias("latitude"),
        (F.lit(-180) + (n % 5) * 72 + 4 + ((k * 7919) % 6400).cast("double") / 100).alias("longitude"),
        F.concat(F.lit("C"), F.lpad(n.cast("string"), 2, "0")).alias("country"),
        F.lit("Supplier").alias("primary_fuel"),
        (1900 + k % 121).cast("int").alias("commissioning_year"),
    )


def load_supplier_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_assets(read_table(spark, sf_dir, "supplier"))
