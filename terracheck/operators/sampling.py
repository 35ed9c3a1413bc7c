"""Exact-k selection without a sort or shuffle of the table (S4, and E1-E3 helpers).

Rows are ordered by ``(md5(seed|step|row_id), row_id)``. The k-th row of that order is found from
counts of hash prefixes: 65,536 counts say which prefix holds it, and as long as that prefix holds
more than ``FETCH`` rows, its own longer prefixes are counted in turn. The driver sees counts and at
most ``FETCH`` ids. The selection is then the narrow predicate ``(hash, id) <= cut``; only selected
rows are ranked, by prefix, so no task receives a hot group."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracheck.functions.rand import hash_hex, hex_int

BUCKET_HEX = 4


def bucket_offsets(spark, counts: list[tuple[int, int]], k: int):
    """From (bucket, count) pairs: a DataFrame of (bucket, offset) for buckets holding a top-k row."""
    if k <= 0 or not counts:
        return None
    counts = sorted(counts)
    buckets = np.array([b for b, _ in counts], dtype=np.int64)
    sizes = np.array([c for _, c in counts], dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keep = before < k
    rows = [(int(b), int(o)) for b, o in zip(buckets[keep], before[keep])]
    return spark.createDataFrame(rows, "_bucket int, _offset bigint")


def bucket_expr(seed, step: str, key) -> "F.Column":
    return hex_int(hash_hex(seed, step, key), 1, BUCKET_HEX).cast("int")


def bucket_counts(df: DataFrame, seed, steps, row_id: str = "row_id"):
    """One job: per step, the (bucket, count) pairs of ``df``'s row ids, plus the row count and
    the largest row id.  The driver receives at most 65,536 rows per step."""
    pairs = F.explode(F.array(*[F.struct(F.lit(st).alias("step"), bucket_expr(seed, st, F.col(row_id)).alias("bucket")) for st in steps]))
    rows = (
        df.select(F.col(row_id).alias("_id"), pairs.alias("_p"))
        .groupBy(F.col("_p.step").alias("step"), F.col("_p.bucket").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("count"), F.max("_id").alias("max_id"))
        .collect()
    )
    counts = {st: [] for st in steps}
    max_id = None
    for r in rows:
        counts[r["step"]].append((r["bucket"], r["count"]))
        max_id = r["max_id"] if max_id is None else max(max_id, r["max_id"])
    n = sum(c for _, c in counts[steps[0]]) if steps else 0
    return counts, n, max_id


FETCH = 65_536


def kth_cut(ids: DataFrame, k: int, seed, step: str, counts, row_id: str = "row_id") -> tuple[str, int] | None:
    """(hash, id) of the k-th row of ``ids`` in hash order; None when there are fewer than k + 1.
    ``counts`` are its (bucket, count) pairs."""
    h = hash_hex(seed, step, F.col(row_id))
    left, prefix, pairs = k, "", [(f"{b:0{BUCKET_HEX}x}", c) for b, c in counts]
    if sum(c for _, c in pairs) <= k:
        return None
    hashed = ids.select(h.alias("_h"), F.col(row_id).alias("_id"))
    while True:
        for p, c in sorted(pairs):
            if left <= c:
                break
            left -= c
        prefix, inside = p, hashed.where(F.col("_h").startswith(p))
        if c <= FETCH or len(prefix) >= 32:
            return tuple(sorted((r["_h"], r["_id"]) for r in inside.collect())[left - 1])
        longer = F.substring("_h", 1, len(prefix) + BUCKET_HEX)
        pairs = [(r["p"], r["count"]) for r in inside.groupBy(longer.alias("p")).count().collect()]


def selected(k: int, cut: tuple[str, int] | None, seed, step: str, row_id: str = "row_id"):
    """Is a row among the first k?"""
    if k <= 0:
        return F.lit(False)
    if cut is None:
        return F.lit(True)
    h = hash_hex(seed, step, F.col(row_id))
    return (h < cut[0]) | ((h == cut[0]) & (F.col(row_id) <= cut[1]))


def _counts(df: DataFrame, seed, step: str, row_id: str) -> list[tuple[int, int]]:
    return bucket_counts(df, seed, [step], row_id)[0][step]


def _ranked(chosen: DataFrame, seed, step: str, row_id: str, rank_col: str, counts, k: int) -> DataFrame:
    """``rank_col`` from 1 on for rows that are all selected: the only rows that are shuffled."""
    offsets = bucket_offsets(chosen.sparkSession, counts, k)
    h = hash_hex(seed, step, F.col(row_id))
    hashed = chosen.withColumns({"_h": h, "_bucket": hex_int(h, 1, BUCKET_HEX).cast("int")})
    w = Window.partitionBy("_bucket").orderBy("_h", row_id)
    joined = hashed.join(F.broadcast(offsets), "_bucket")  # 65,536 rows at most
    return joined.withColumn(rank_col, F.col("_offset") + F.row_number().over(w)).drop("_h", "_bucket", "_offset")


def with_hash_rank(df: DataFrame, k: int, seed, step: str, row_id: str = "row_id", rank_col: str = "_rank", counts=None, ids=None) -> DataFrame:
    """Adds ``rank_col``: 1..k for the k rows first in hash order, NULL for all others.

    ``counts`` (bucket, count) pairs of the row ids, when already known, spare a job; ``ids``, a table
    of the row ids of ``df``, spares a scan of it."""
    counts = counts if counts is not None else _counts(df, seed, step, row_id)
    none = F.lit(None).cast("bigint")
    if k <= 0 or not counts:
        return df.withColumn(rank_col, none)
    hit = selected(k, kth_cut(df if ids is None else ids, k, seed, step, counts, row_id), seed, step, row_id)
    ranked = _ranked(df.where(hit), seed, step, row_id, rank_col, counts, k)
    return ranked.unionByName(df.where(~hit).withColumn(rank_col, none))


def sample_exact_n(df: DataFrame, n: int, seed=42, step: str = "sample", row_id: str = "row_id") -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same for the same seed; no rows of
    an empty table."""
    counts = _counts(df, seed, step, row_id)
    if n <= 0 or not counts:
        return df.withColumn("sample_rank", F.lit(None).cast("bigint")).limit(0)
    cut = kth_cut(df, n, seed, step, counts, row_id)
    return _ranked(df.where(selected(n, cut, seed, step, row_id)), seed, step, row_id, "sample_rank", counts, n)
