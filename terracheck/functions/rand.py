"""Repeatable randomness that does not depend on partitioning (section 4.3 of the survey).

``h(seed, step, key) = md5(seed | step | key)``; a uniform in [0, 1) is the
first 8 hex digits over 2^32.  DuckDB computes the same digest and number, so
operators built on it have exact SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash_hex(seed, step: str, key: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(step), key.cast("string")))


def hex_int(h: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(h, start, length), 16, 10).cast("bigint")


def uniform(seed, step: str, key: Column) -> Column:
    """U[0, 1) from the first 32 bits of the md5 digest."""
    return hex_int(hash_hex(seed, step, key), 1, 8) / TWO_POW_32


def uniform_between(seed, step: str, key: Column, lo: float, hi: float) -> Column:
    return F.lit(lo) + uniform(seed, step, key) * (hi - lo)


def sql_uniform(seed, step: str, key_sql: str) -> str:
    """The DuckDB text of :func:`uniform`."""
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', '{step}', CAST({key_sql} AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0)"
