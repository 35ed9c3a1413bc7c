"""Exact, linearly interpolated quantiles per group, by radix selection over the bits of a double.

Every number maps to a whole number of the same order (sign times its exponent and fraction bits).
A round counts rows per next 16 bits, with partial sums, among the rows that share the leading bits
found so far; a group's counts, 65,536 at most, say under which digit each wanted rank lies. After
four rounds all 64 bits are known, and earlier when the rows left are so few that their values are
counted whole. All columns, probabilities and groups advance in the same scan. Nothing of the
table's size is written, sorted or shuffled, and no group is ever in one task.

Interpolation is linear as in numpy/pandas: position ``q * (n - 1)``. NULL is a group like any
other; NULL and NaN values are left out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracheck.session import cut_lineage

_DIGIT = 16
#: Counts of one group in a round; also the rows that are left to the last round, and the wanted
#: prefixes that travel through the driver.
MAX_COUNTS = 1 << _DIGIT
_FRACTION = 1 << 52


def ordered_bits(v: Column) -> Column:
    """A BIGINT that sorts as the DOUBLE ``v`` does (0 and -0 alike; not for NaN)."""
    a = F.abs(v)
    near = F.floor(F.log2(a))  # off by one at worst, next to a power of two
    p = F.pow(F.lit(2.0), near)
    e = near + F.when(a < p, -1).when(a >= p * 2, 1).otherwise(0)
    normal = (e + 1023) * _FRACTION + ((a / F.pow(F.lit(2.0), e) - 1) * float(_FRACTION)).cast("bigint")
    small = (a * 2.0**537 * 2.0**537).cast("bigint")
    bits = F.when(a < 2.0**-1022, small).when(a == float("inf"), F.lit(2047 * _FRACTION)).otherwise(normal)
    return F.when(v < 0, -bits).otherwise(bits)


def value_of_bits(bits: Column) -> Column:
    """The DOUBLE that :func:`ordered_bits` gave ``bits``."""
    b = F.abs(bits)
    e, fraction = F.shiftright(b, 52), (b % _FRACTION).cast("double")
    normal = (1 + fraction / float(_FRACTION)) * F.pow(F.lit(2.0), e - 1023)
    a = F.when(e == 0, fraction * 2.0**-537 * 2.0**-537).when(e == 2047, F.lit(float("inf"))).otherwise(normal)
    return F.when(bits < 0, -a).otherwise(a)


def _joined(rows: DataFrame, found: DataFrame, names: list[str], small: bool) -> DataFrame:
    """Rows of ``rows`` under a found prefix, null equal to null, with the prefix's wanted ranks."""
    theirs = {c: f"_r{i}" for i, c in enumerate(names)}
    found = found.withColumnsRenamed(theirs)
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(found[theirs[c]]) for c in names])
    return rows.join(F.broadcast(found) if small else found, same).drop(*theirs.values())


def _selected(values: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """``keys, _n, _id, _bits``: for each group the order statistics at the floor (id 2 i) and the
    ceiling (2 i + 1) of each probability's position. ``values`` has ``keys`` and ``_bits``."""
    spark = values.sparkSession
    found, small, shift = None, True, 64 - _DIGIT
    while True:
        if found is None:
            rows = values.withColumn("_prefix", F.lit(0))
            counted = rows.groupBy(*keys, "_prefix", F.shiftright("_bits", shift).alias("_next")).agg(F.count("*").alias("_c"))
        else:
            rows = _joined(values.withColumn("_prefix", F.shiftright("_bits", last)), found, [*keys, "_prefix"], small)
            counted = rows.groupBy(*keys, "_prefix", F.shiftright("_bits", shift).alias("_next")).agg(
                F.count("*").alias("_c"), F.first("_want").alias("_want"), F.first("_n").alias("_n")
            )
        group = Window.partitionBy(*keys, "_prefix")
        before = group.orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        if found is None:
            counted = counted.withColumn("_n", F.sum("_c").over(group))
            at = [F.lit(q) * (F.col("_n") - 1) for q in probabilities]
            ranks = [F.struct(F.lit(2 * i + j).alias("id"), f(p).cast("bigint").alias("rank")) for i, p in enumerate(at) for j, f in enumerate((F.floor, F.ceil))]
            counted = counted.withColumn("_want", F.array(*ranks))
        here = F.filter("_want", lambda w: (w["rank"] >= F.col("_before")) & (w["rank"] < F.col("_before") + F.col("_c")))
        left = F.transform(here, lambda w: F.struct(w["id"].alias("id"), (w["rank"] - F.col("_before")).alias("rank")))
        found = counted.withColumn("_want", left).where(F.size("_want") > 0).select(*keys, F.col("_next").alias("_prefix"), "_n", "_want", "_c")
        if shift == 0:
            return found.select(*keys, "_n", F.explode("_want.id").alias("_id"), F.col("_prefix").alias("_bits"))
        some = found.limit(MAX_COUNTS + 1).collect()
        small = len(some) <= MAX_COUNTS
        found = spark.createDataFrame(some, found.schema) if small else cut_lineage(found)
        few = small and sum(r["_c"] for r in some) <= MAX_COUNTS
        found = found.drop("_c")
        last, shift = shift, 0 if few else shift - _DIGIT


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """``keys, q0, q1, ...``: the quantiles of ``value`` of each group that has a value; one row
    without keys."""
    v = F.col(value).cast("double")
    values = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v")).select(*keys, ordered_bits(F.col("_v")).alias("_bits"))
    found = _selected(values, keys, probabilities).withColumn("_v", value_of_bits(F.col("_bits")))
    out = []
    for i, q in enumerate(probabilities):
        low, high = (F.max(F.when(F.col("_id") == 2 * i + j, F.col("_v"))) for j in (0, 1))
        at = F.lit(q) * (F.max("_n") - 1)
        # equal order statistics give their value, to the last bit
        out.append(F.when(low == high, low).otherwise(low + (high - low) * (at - F.floor(at))).alias(f"q{i}"))
    return found.groupBy(*keys).agg(*out)


def exact_quantile(
    df: DataFrame, value: str, q: float, keys: list[str] | tuple[str, ...] = (), out: str = "quantile", approx: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """The q-quantile of ``value`` in column ``out``: one row per group of ``keys`` that has a value,
    or one row overall without keys (NULL if there is no value).

    ``approx=True`` opts into ``percentile_approx`` (a mergeable sketch of bounded size, rank error
    about 1 / ``accuracy``)."""
    keys = list(keys)
    if approx:
        vals = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        return vals.groupBy(*keys).agg(F.percentile_approx("_v", q, accuracy).alias(out))
    return exact_quantiles(df, keys, value, [q]).withColumnRenamed("q0", out)


def quantile_by_and_overall(df: DataFrame, value: str, q: float, key: str) -> tuple[DataFrame, DataFrame]:
    """``(key, quantile)`` per group of ``key``, and ``(quantile)`` of the whole table, from the same scans."""
    every = F.struct(F.lit(True).alias("_every"), F.lit(None).cast(df.schema[key].dataType).alias(key))
    both = F.explode(F.array(F.struct(F.lit(False).alias("_every"), F.col(key).alias(key)), every))
    each = exact_quantile(df.select(both.alias("_g"), F.col(value).alias("_value")).select("_g.*", "_value"), "_value", q, ["_every", key])
    # one row per group: the groups' table is read by two consumers
    each = cut_lineage(each)
    return each.where(~F.col("_every")).drop("_every"), each.agg(F.max(F.when(F.col("_every"), F.col("quantile"))).alias("quantile"))


def exact_quantiles_row(df: DataFrame, values, q: float, suffix: str = "_q") -> DataFrame:
    """One row: the q-quantile of each column in ``values``, from the same scans."""
    values = list(values)
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("_name"), F.col(v).cast("double").alias("_value")) for v in values]))
    each = exact_quantile(df.select(pairs.alias("_p")).select("_p.*"), "_value", q, ["_name"])
    return each.agg(*[F.max(F.when(F.col("_name") == v, F.col("quantile"))).alias(v + suffix) for v in values])
