"""A left join that no frequent key slows down.

Keys that hold at least one row in ``HOT`` are at most ``HOT`` keys, whatever the size of the data:
their rows of the table are broadcast, and rows with such a key, or with a null in it, which finds
nothing, never move. All other keys are rare by the same count and are joined by a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.llm.common import fresh_name

#: A key is frequent when one row in so many has it.
HOT = 1024


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], hot: int = HOT) -> DataFrame:
    """``rows`` with the other columns of ``table``, which has one row per ``keys`` at most; null
    where it has none. ``rows`` is read three times, so it should be a stored table."""
    spark = rows.sparkSession
    total = rows.count()
    flag, n = fresh_name(rows, "_hot"), fresh_name(rows, "_n")
    counted = rows.groupBy(*keys).agg(F.count("*").alias(n)).where(F.col(n) * hot >= total)
    schema = rows.select(*keys).schema
    frequent = spark.createDataFrame([tuple(r)[: len(keys)] for r in counted.collect()], schema)  # at most `hot` rows
    known = table.join(F.broadcast(frequent), keys, "left_semi")
    marked = rows.join(F.broadcast(frequent.withColumn(flag, F.lit(True))), keys, "left")
    null_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    still = F.coalesce(F.col(flag), F.lit(False)) | null_key
    here = marked.where(still).drop(flag).join(F.broadcast(known), keys, "left")
    there = marked.where(~still).drop(flag).join(table, keys, "left")
    return here.unionByName(there)
