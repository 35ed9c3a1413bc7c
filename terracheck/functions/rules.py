"""Row rules as pure column expressions (V1-V8, A3, A4).

Each rule returns a column that is NULL when the value passes and the error
message otherwise; a record's messages are ``array_compact`` of its rules in
field order.  Message texts are the public wording of the pydantic checks the
reference declares (field type, ``ge``/``le`` bounds, string length).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pydantic v2 error texts.
MSG_STRING = "Input should be a valid string"
MSG_NUMBER = "Input should be a valid number"
MSG_FINITE = "Input should be a finite number"
MSG_FRACTION = "Input should be a valid integer, got a number with a fractional part"
MSG_REQUIRED = "Field required"
MSG_MIN_LEN = "String should have at least {n} characters"
MSG_MAX_LEN = "String should have at most {n} characters"
MSG_GE = "Input should be greater than or equal to {v}"
MSG_LE = "Input should be less than or equal to {v}"
MSG_ID_BLANK = "Value error, gppd_idnr must not be blank."
MSG_ASSET_ID_BLANK = "Value error, Asset id must not be blank or whitespace."

# Unicode-aware (like Python's str.strip): no-break and em spaces count as whitespace too.
_BLANK = r"(?U)^\s*$"


def _msg(field: str, text: str) -> Column:
    return F.lit(f"{field}: {text}")


def is_blank(c: Column) -> Column:
    """``not s.strip()``: empty or whitespace only (tabs and newlines included)."""
    return c.rlike(_BLANK)


def coerce_double(c: Column, dtype: T.DataType) -> Column:
    """V3: NULL, NaN and unparsable text all become NULL; numeric text is parsed."""
    if isinstance(dtype, T.StringType):
        c = c.try_cast("double")
    else:
        c = c.cast("double")
    return F.nullif(c, F.lit(float("nan")))


def string_required(field: str, c: Column) -> Column:
    """V2: a required string."""
    return F.when(c.isNull(), _msg(field, MSG_STRING))


def id_rule(field: str, c: Column, blank_msg: str = MSG_ID_BLANK) -> Column:
    """V1: a string that is not blank; the blank check runs only for strings."""
    return F.when(c.isNull(), _msg(field, MSG_STRING)).when(is_blank(c), _msg(field, blank_msg))


def bounded_number(field: str, c: Column, lo: float, hi: float) -> Column:
    """V5/V6: a required number in [lo, hi].  NaN is above every number in Spark, so it gets
    the upper-bound message exactly as the reference does."""
    return (
        F.when(c.isNull(), _msg(field, MSG_NUMBER))
        .when(c > hi, _msg(field, MSG_LE.format(v=_num(hi))))
        .when(c < lo, _msg(field, MSG_GE.format(v=_num(lo))))
    )


def nonneg_optional(field: str, c: Column) -> Column:
    """V4: optional, >= 0 (after V3 coercion, so NULL passes; +inf passes)."""
    return F.when(c < 0, _msg(field, MSG_GE.format(v=0)))


def exact_length(field: str, c: Column, n: int = 3) -> Column:
    """V7: string of exactly n characters, tested on the raw text."""
    return (
        F.when(c.isNull(), _msg(field, MSG_STRING))
        .when(F.length(c) < n, _msg(field, MSG_MIN_LEN.format(n=n)))
        .when(F.length(c) > n, _msg(field, MSG_MAX_LEN.format(n=n)))
    )


def optional_int_range(field: str, c: Column, dtype: T.DataType, lo: int, hi: int, missing: str = "error") -> Column:
    """V8: optional integer in [lo, hi].  ``missing='error'`` treats a missing value the way
    pandas hands it to the reference (a NaN float, which fails as not finite); ``'allow'`` passes it."""
    rule = F.when(c.isNull(), _msg(field, MSG_FINITE) if missing == "error" else F.lit(None))
    # floor() of a double is a saturating BIGINT in Spark; round(c, 0) stays a double, so
    # huge whole numbers are not mistaken for fractions.  Infinities are not finite.
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        rule = (
            rule.when(F.isnan(c) | (F.abs(c) == float("inf")), _msg(field, MSG_FINITE))
            .when(c != F.round(c, 0), _msg(field, MSG_FRACTION))
        )
    elif isinstance(dtype, T.StringType):
        c = c.try_cast("double")
        rule = (
            rule.when(c.isNull(), _msg(field, MSG_NUMBER))
            .when(F.isnan(c) | (F.abs(c) == float("inf")), _msg(field, MSG_FINITE))
            .when(c != F.round(c, 0), _msg(field, MSG_FRACTION))
        )
    return rule.when(c < lo, _msg(field, MSG_GE.format(v=lo))).when(c > hi, _msg(field, MSG_LE.format(v=hi)))


def _num(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else str(v)


def join_messages(rules: list[Column], sep: str) -> Column:
    """Non-null rule messages in order, joined; '' when the record is valid."""
    return F.array_join(F.array_compact(F.array(*rules)), sep)
