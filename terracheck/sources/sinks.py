"""Table sinks (S8): Parquet or CSV snapshots, optionally partitioned by a column."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "overwrite") -> None:
    """Write ``df``; CSV gets a header.  Partition by e.g. ``country`` for pruned re-reads."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
