"""Row validation on a stream.

The row operators (rules V1-V9, the border check G1, the ocean boxes G3) hold
no aggregate, so they accept a streaming DataFrame unchanged: new asset files
landing in a folder are validated as they arrive, the border check being a
stream-static join against the (broadcast) country edge arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.operators.qa import with_ocean_flag
from terracheck.operators.validate import validate_assets, validate_records


def read_asset_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = 100) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(path)


def validate_stream(stream: DataFrame, country_edges: DataFrame, cols: AssetCols = DEFAULT_COLS) -> DataFrame:
    """V9 + A5 + G3 flags on every arriving row."""
    out = validate_records(stream, cols)
    out = validate_assets(out, country_edges, cols)
    return with_ocean_flag(out, cols, mode="bbox")


def start_sink(validated: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger_once: bool = False):
    """Append the validated rows to ``path``; ``checkpoint`` must be on shared storage."""
    w = validated.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
