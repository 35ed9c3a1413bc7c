"""Table-level expectation suite (X1-X10) compiled into one aggregate.

The reference scans the table once per expectation.  Here every count, min,
max and out-of-range count is one ``agg`` over the table (one partial
HashAggregate per task, a single-row final), and uniqueness is one
``groupBy(id).count()`` whose output feeds both the duplicate totals and the
top-5 sample (Spark reuses the exchange).  The result is an 8-row DataFrame;
nothing is collected.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.functions.text import py_fixed, py_thousands
from terracheck.session import attach_row

COMPLETENESS = "Completeness"
UNIQUENESS = "Uniqueness"
VALIDITY = "Validity"
CONSISTENCY = "Consistency"

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
ROW_COUNT = "expect_table_row_count_to_be_between"

RESULT_COLUMNS = (
    "check_order",
    "expectation",
    "dimension",
    "column",
    "success",
    "observed",
    "observed_value",
    "n_bad",
    "n_checked",
    "threshold",
    "detail",
)


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | not_null_mostly | row_count | unique | between
    column: str = "(table)"
    threshold: float = 1.0
    lo: float | int | None = None
    hi: float | int | None = None
    dimension: str = COMPLETENESS


def default_suite(cols: AssetCols = DEFAULT_COLS) -> list[Check]:
    """The eight checks, in the reference order."""
    # Thresholds and ranges of the reference suite.
    return [
        Check("not_null", cols.capacity, threshold=1.0),
        Check("not_null_mostly", cols.year, threshold=0.95),
        Check("row_count", lo=1, hi=10_000_000),
        Check("unique", cols.id, dimension=UNIQUENESS),
        Check("between", cols.lat, lo=-90, hi=90, dimension=VALIDITY),
        Check("between", cols.lon, lo=-180, hi=180, dimension=VALIDITY),
        Check("between", cols.capacity, lo=0, hi=25_000, dimension=CONSISTENCY),
        Check("between", cols.year, lo=1900, hi=2100, dimension=CONSISTENCY),
    ]


def _range_text(lo, hi) -> str:
    return f"[{lo}, {hi}]"


def _result(order, expectation, dimension, column, success, observed, value, n_bad, n_checked, threshold, detail) -> Column:
    return F.struct(
        F.lit(order).alias("check_order"),
        F.lit(expectation).alias("expectation"),
        F.lit(dimension).alias("dimension"),
        F.lit(column).alias("column"),
        F.coalesce(success, F.lit(False)).alias("success"),
        observed.cast("string").alias("observed"),
        value.cast("double").alias("observed_value"),
        n_bad.cast("bigint").alias("n_bad"),
        n_checked.cast("bigint").alias("n_checked"),
        F.lit(threshold).alias("threshold"),
        detail.alias("detail"),
    )


def _missing(order, expectation, dimension, column, threshold) -> Column:
    return _result(
        order, expectation, dimension, column, F.lit(False), F.lit("column missing"), F.lit(None), F.lit(None),
        F.lit(None), threshold, F.lit(f"Column '{column}' does not exist in the dataset."),
    )


def suite_aggregates(columns, checks: list[Check]) -> dict[str, Column]:
    """Every aggregate that the checks need on a table with these columns, but for uniqueness, which
    counts ids: they go into one ``agg``, or are observed on rows that pass by."""
    present = set(columns)
    aggs: dict[str, Column] = {"_total": F.count(F.lit(1))}
    for i, ch in enumerate(checks):
        c = F.col(ch.column) if ch.column in present else None
        if ch.kind in ("not_null", "not_null_mostly") and c is not None:
            aggs[f"_nn{i}"] = F.count(c)
        elif ch.kind == "between" and c is not None:
            aggs[f"_n{i}"] = F.count(c)
            aggs[f"_min{i}"] = F.min(c).cast("double")
            aggs[f"_max{i}"] = F.max(c).cast("double")
            aggs[f"_out{i}"] = F.count_if((c < ch.lo) | (c > ch.hi))
    return aggs


def run_expectation_suite(
    df: DataFrame, checks: list[Check] | None = None, cols: AssetCols = DEFAULT_COLS, stats: DataFrame | None = None
) -> DataFrame:
    """Evaluate the checks as one fused aggregate; returns one row per check (X1-X8), none for an
    empty list.  With ``stats``, one row of :func:`suite_aggregates` that is known already, ids are
    counted at once, in one pass."""
    checks = default_suite(cols) if checks is None else checks
    present = set(df.columns)
    known = stats is not None
    if not known:
        stats = df.agg(*[v.alias(k) for k, v in suite_aggregates(df.columns, checks).items()])
    for i, ch in enumerate(checks):
        if ch.kind == "unique" and ch.column in present:
            stats = attach_row(stats, (_uniqueness_now if known else _uniqueness_stats)(df, ch.column, i))

    total = F.col("_total")
    rows = []
    for i, ch in enumerate(checks):
        order = i + 1
        if ch.kind in ("not_null", "not_null_mostly"):
            if ch.column not in present:
                rows.append(_missing(order, NOT_NULL, COMPLETENESS, ch.column, str(float(ch.threshold))))
                continue
            nulls = total - F.col(f"_nn{i}")
            compl = F.when(total > 0, F.col(f"_nn{i}") / total).otherwise(F.lit(0.0))
            detail = F.concat(
                py_thousands(nulls), F.lit(" / "), py_thousands(total), F.lit(" values are null ("),
                py_fixed(100 * (1 - compl), 1), F.lit("% missing)."),
            )
            if ch.kind == "not_null_mostly":
                detail = F.concat(F.lit(f"Required ≥ {ch.threshold * 100:.0f}% complete. "), detail)
            observed = F.round(compl, 4)
            rows.append(_result(order, NOT_NULL, COMPLETENESS, ch.column, compl >= ch.threshold, observed, observed,
                                nulls, total, str(float(ch.threshold)), detail))
        elif ch.kind == "row_count":
            ok = (total >= ch.lo) & (total <= ch.hi)
            detail = F.concat(F.lit("Dataset contains "), py_thousands(total), F.lit(" rows."))
            rows.append(_result(order, ROW_COUNT, COMPLETENESS, "(table)", ok, total, total, F.lit(0), total,
                                _range_text(ch.lo, ch.hi), detail))
        elif ch.kind == "unique":
            if ch.column not in present:
                rows.append(_missing(order, UNIQUE, UNIQUENESS, ch.column, "100% unique"))
                continue
            n_dupes = F.col(f"_dupes{i}")
            uniq = F.when(total > 0, 1 - n_dupes / total).otherwise(F.lit(1.0))
            detail = F.concat(
                py_thousands(n_dupes), F.lit(" duplicate rows across "), py_thousands(total - F.col(f"_nunique{i}")),
                F.lit(" non-unique values."),
                F.when(F.col(f"_sample{i}").isNotNull(), F.concat(F.lit(" Sample duplicates: "), F.col(f"_sample{i}")))
                .otherwise(F.lit("")),
            )
            observed = F.round(uniq, 4)
            rows.append(_result(order, UNIQUE, UNIQUENESS, ch.column, n_dupes == 0, observed, observed, n_dupes,
                                total, "1.0", detail))
        elif ch.kind == "between":
            rng = _range_text(ch.lo, ch.hi)
            if ch.column not in present:
                rows.append(_missing(order, BETWEEN, ch.dimension, ch.column, rng))
                continue
            n_out, n_in = F.col(f"_out{i}"), F.col(f"_n{i}")
            observed = F.concat(F.lit("min="), py_fixed(F.col(f"_min{i}"), 2), F.lit(", max="), py_fixed(F.col(f"_max{i}"), 2))
            detail = F.when(n_out > 0, F.concat(py_thousands(n_out), F.lit(f" values outside {rng}."))).otherwise(
                F.concat(F.lit("All "), py_thousands(n_in), F.lit(" values within range."))
            )
            rows.append(_result(order, BETWEEN, ch.dimension, ch.column, n_out == 0, observed, F.lit(None), n_out,
                                n_in, rng, detail))
        else:
            raise ValueError(f"unknown check kind {ch.kind!r}")
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _id_counts(df: DataFrame, column: str, i: int) -> tuple[DataFrame, list[Column], Column]:
    """Rows per id, the totals over them, and whether an id is duplicated."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    totals = [
        F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))), F.lit(0)).alias(f"_dupes{i}"),
        F.count(F.col(column)).alias(f"_nunique{i}"),
    ]
    return counts, totals, F.col(column).isNotNull() & (F.col("cnt") > 1)


def _top(counts: DataFrame, column: str, is_dup: Column, k: int) -> DataFrame:
    """The ids first by count (TakeOrderedAndProject); ties broken by value.  The duplicate test is an
    ordering key and filters only the k survivors, so no predicate is pushed below the id aggregate
    and both consumers share one exchange."""
    return counts.orderBy(is_dup.desc(), F.col("cnt").desc(), F.col(column)).limit(k)


def _sample_text(top: DataFrame, column: str, is_dup: Column, i: int) -> DataFrame:
    """The duplicated values of ``top`` with their counts as a Python-dict text."""
    return (
        top.where(is_dup)
        .agg(
            F.sort_array(F.collect_list(F.struct((-F.col("cnt")).alias("neg"), F.col(column).cast("string").alias("v"))))
            .alias("items")
        )
        .select(
            F.when(
                F.size("items") > 0,
                F.concat(
                    F.lit("{"),
                    F.array_join(F.transform("items", lambda x: F.concat(F.lit("'"), x["v"], F.lit("': "), (-x["neg"]).cast("string"))), ", "),
                    F.lit("}"),
                ),
            ).alias(f"_sample{i}")
        )
    )


def _uniqueness_stats(df: DataFrame, column: str, i: int, sample_size: int = 5) -> DataFrame:
    """One row: rows in duplicated groups (null is a group, as pandas ``duplicated``), distinct
    non-null values, and the top duplicated values as a Python-dict text."""
    counts, totals, is_dup = _id_counts(df, column, i)
    return attach_row(counts.agg(*totals), _sample_text(_top(counts, column, is_dup, sample_size), column, is_dup, i))


def _uniqueness_now(df: DataFrame, column: str, i: int, sample_size: int = 5) -> DataFrame:
    """The same row from one job: the totals are observed on the counts on their way to the top."""
    counts, totals, is_dup = _id_counts(df, column, i)
    seen = Observation(f"ids-{uuid.uuid4().hex}")
    top = _top(counts.observe(seen, *totals), column, is_dup, sample_size)
    rows = df.sparkSession.createDataFrame(top.collect(), top.schema)  # sample_size rows
    found = {f"_dupes{i}": 0, f"_nunique{i}": 0} | dict(seen.get)
    totals_row = df.sparkSession.createDataFrame([(found[f"_dupes{i}"], found[f"_nunique{i}"])], f"_dupes{i} long, _nunique{i} long")
    return attach_row(totals_row, _sample_text(rows, column, is_dup, i))


def top_duplicate_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The k most frequent duplicated (non-null) values with their counts."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
        .orderBy(F.col("count").desc(), F.col(column))
        .limit(k)
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """Passed, failed, pass rate (0.0 for an empty suite)."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.round(F.avg(F.col("success").cast("double")), 6), F.lit(0.0)).alias("pass_rate"),
    )


def suite_by_dimension(results: DataFrame) -> DataFrame:
    """Checks, passed, failed and score per dimension."""
    return results.groupBy("dimension").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.round(F.avg(F.col("success").cast("double")), 6).alias("score"),
    )


def expect_not_null(df: DataFrame, column: str, threshold: float = 1.0) -> DataFrame:
    return run_expectation_suite(df, [Check("not_null", column, threshold=threshold)])


def expect_not_null_mostly(df: DataFrame, column: str, mostly: float = 0.95) -> DataFrame:
    return run_expectation_suite(df, [Check("not_null_mostly", column, threshold=mostly)])


def expect_unique(df: DataFrame, column: str) -> DataFrame:
    return run_expectation_suite(df, [Check("unique", column, dimension=UNIQUENESS)])


def expect_between(df: DataFrame, column: str, lo, hi, dimension: str = VALIDITY) -> DataFrame:
    return run_expectation_suite(df, [Check("between", column, lo=lo, hi=hi, dimension=dimension)])


def expect_row_count(df: DataFrame, lo: int = 1, hi: int = 10_000_000) -> DataFrame:
    return run_expectation_suite(df, [Check("row_count", lo=lo, hi=hi)])
