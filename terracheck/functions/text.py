"""Python-compatible number formatting as column expressions.

``format_number`` rounds the exact binary value half-to-even, which is what
Python's ``f"{x:.2f}"`` does; ``format_string('%.2f')`` rounds half-up on the
shortest decimal and disagrees at ties, so it is not used for numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_fixed(c: Column, decimals: int, null_text: str = "nan") -> Column:
    """``f"{x:.{decimals}f}"``; NULL renders as ``nan`` like a pandas empty min/max."""
    return F.coalesce(F.replace(F.format_number(c, decimals), F.lit(","), F.lit("")), F.lit(null_text))


def py_thousands(c: Column) -> Column:
    """``f"{n:,}"`` for integers."""
    return F.format_number(c, 0)


def py_number(c: Column) -> Column:
    """``str(x)`` for a double (shortest round-trip text) or an integer."""
    return c.cast("string")
