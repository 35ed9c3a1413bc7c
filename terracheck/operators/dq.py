"""Data-quality dimension report.

ACCURACY comes from the asset border check; COMPLETENESS, CONSISTENCY and
UNIQUENESS are the per-dimension scores of the expectation suite (1.0 when a
dimension has no check).  Every piece is a small DataFrame; the report is a
bundle of them, so a caller writes or shows whichever it needs.

``build_dq_report`` reads the table twice, whatever it reports: once through the asset validation,
where the counts behind ACCURACY and every range and null check are observed on the rows that pass
by on their way to the issue list (or to the written table), and once to count ids.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.functions.text import py_fixed
from terracheck.operators.expectations import Check, default_suite, run_expectation_suite, suite_aggregates, suite_by_dimension
from terracheck.session import attach_row, cut_lineage

# Dimension names and pass thresholds; what each says and which operator it is from.
DIMENSIONS = (
    (
        1,
        "ACCURACY",
        None,
        0.95,
        "Share of assets that lie inside, or within half a degree of, the country they name.",
        "validate_assets: point in country by edge crossings",
    ),
    (
        2,
        "COMPLETENESS",
        "Completeness",
        0.95,
        "Share of the completeness checks that pass: capacity and year are known often enough.",
        "expectation suite: not_null, not_null_mostly",
    ),
    (
        3,
        "CONSISTENCY",
        "Consistency",
        0.95,
        "Share of the range checks that pass: capacity from 0 on, year from 1900 to 2100.",
        "expectation suite: between",
    ),
    (
        4,
        "UNIQUENESS",
        "Uniqueness",
        0.99,
        "Share of the uniqueness checks that pass: no id is on two rows.",
        "expectation suite: unique",
    ),
)
PASS = "✅ PASS"
FAIL = "❌ FAIL"
OVERALL_PASS = 0.90


def _status(score, threshold):
    return F.when(score >= threshold, F.lit(PASS)).otherwise(F.lit(FAIL))


def accuracy(validated: DataFrame) -> DataFrame:
    """Share of geometry-consistent rows (1.0 on an empty table)."""
    return _accuracy(validated.agg(*[v.alias(k) for k, v in _accuracy_counts().items()]))


def _accuracy_counts() -> dict:
    return {"n_total": F.count(F.lit(1)), "n_consistent": F.count_if(F.col("geometry_consistent"))}


def _accuracy(counts: DataFrame) -> DataFrame:
    share = F.when(F.col("n_total") > 0, F.col("n_consistent") / F.col("n_total")).otherwise(F.lit(1.0))
    return counts.select("n_total", "n_consistent", share.alias("accuracy"))


def accuracy_issues(validated: DataFrame, cols: AssetCols = DEFAULT_COLS, k: int = 20) -> DataFrame:
    """The first k inconsistent rows (by row_id): id, lat, lon, country, errors."""
    ident = cols.id if cols.id in validated.columns else validated.columns[0]
    return (
        validated.where(~F.col("geometry_consistent"))
        .select(cols.row_id, ident, cols.lat, cols.lon, cols.country, "asset_errors")
        .orderBy(cols.row_id)
        .limit(k)
    )


def _dimension_table(spark) -> DataFrame:
    return spark.createDataFrame(
        [(o, d, s, t, desc, src) for o, d, s, t, desc, src in DIMENSIONS],
        "dim_order int, dimension string, suite_dimension string, pass_threshold double, description string, source string",
    )


def dimension_scores(suite: DataFrame, accurate: DataFrame) -> DataFrame:
    """D3 + D7: four rows ``dimension, score, pct, status, description, source`` (+ order, raw score);
    ``accurate`` is the row of :func:`accuracy`."""
    spark = suite.sparkSession
    acc = accurate.select(F.lit("ACCURACY").alias("dimension"), F.col("accuracy").alias("raw"))
    by_dim = suite_by_dimension(suite).select(F.col("dimension").alias("suite_dimension"), F.col("score").alias("suite_score"))
    dims = F.broadcast(_dimension_table(spark))
    joined = dims.join(F.broadcast(by_dim), "suite_dimension", "left").join(F.broadcast(acc), "dimension", "left")
    raw = F.when(F.col("dimension") == "ACCURACY", F.col("raw")).otherwise(F.coalesce(F.col("suite_score"), F.lit(1.0)))
    return joined.select(
        "dim_order",
        "dimension",
        raw.alias("raw_score"),
        F.round(raw, 4).alias("score"),
        F.concat(py_fixed(raw * 100, 1), F.lit("%")).alias("pct"),
        _status(raw, F.col("pass_threshold")).alias("status"),
        "description",
        "source",
    )


def overall(dimensions: DataFrame, suite: DataFrame, accurate: DataFrame, run_time: str | None = None) -> DataFrame:
    """D4 + run metadata: plain mean of the four dimension scores; PASS at 0.90.  ``accurate`` is the
    row of :func:`accuracy`; ``run_time``, the caller's time of the run, becomes a column of that
    name when it is given."""
    mean = dimensions.agg(F.avg("raw_score").alias("raw"))
    meta = suite.agg(
        F.count(F.lit(1)).alias("gx_checks"),
        F.count_if(F.col("success")).alias("gx_passed"),
        F.count_if(~F.col("success")).alias("gx_failed"),
    )
    rows = accurate.select(F.col("n_total").alias("total_rows"))
    return (
        attach_row(attach_row(mean, meta), rows)
        .select(
            "total_rows",
            "gx_checks",
            "gx_passed",
            "gx_failed",
            F.round("raw", 4).alias("overall_score"),
            F.concat(py_fixed(F.col("raw") * 100, 1), F.lit("%")).alias("overall_pct"),
            _status(F.col("raw"), OVERALL_PASS).alias("overall_status"),
            *([F.lit(run_time).alias("run_time")] if run_time is not None else []),
        )
    )


def dimension_checks(suite: DataFrame) -> DataFrame:
    """The suite checks behind COMPLETENESS, CONSISTENCY and UNIQUENESS."""
    return suite.where(F.col("dimension").isin("Completeness", "Consistency", "Uniqueness")).select(
        F.upper("dimension").alias("dq_dimension"),
        "check_order",
        "expectation",
        "column",
        "success",
        "observed",
        "threshold",
        "detail",
    )


@dataclass
class DqReport:
    dimensions: DataFrame
    summary: DataFrame
    checks: DataFrame
    issues: DataFrame
    accuracy: DataFrame
    suite: DataFrame


def build_dq_report(
    df: DataFrame,
    suite: DataFrame | None = None,
    validated: DataFrame | None = None,
    country_edges: DataFrame | None = None,
    cols: AssetCols = DEFAULT_COLS,
    run_time: str | None = None,
    checks: list[Check] | None = None,
    write_to: str | None = None,
) -> DqReport:
    """The report bundle; runs the asset validation when ``validated`` is not given, and the
    expectation suite when ``suite`` is not.

    One pass over the validated rows finds the issues and, observed on the way, all counts; with
    ``write_to`` that pass is the write of the validated table to that folder.  Ids are counted in a
    second pass.  The suite (one row per check) is written once, since four tables read it."""
    spark = df.sparkSession
    if validated is None:
        if country_edges is None:
            raise ValueError("pass the validated asset table or the country edges to validate with")
        from terracheck.operators.validate import validate_assets

        validated = validate_assets(df, country_edges, cols)
    checks = default_suite(cols) if checks is None else checks
    wanted = _accuracy_counts() | (suite_aggregates(df.columns, checks) if suite is None else {})
    kinds = validated.agg(*[v.alias(k) for k, v in wanted.items()]).schema  # types only, not run
    seen = Observation(f"dq-{uuid.uuid4().hex}")
    passing = validated.observe(seen, *[v.alias(k) for k, v in wanted.items()])
    if write_to is not None:
        passing.write.mode("overwrite").parquet(write_to)
        issues = accuracy_issues(spark.read.schema(validated.schema).parquet(write_to), cols)
    else:
        first = accuracy_issues(passing, cols)
        issues = spark.createDataFrame(first.collect(), first.schema)  # k rows
    found = {k: 0 if k.startswith(("n_", "_total", "_nn", "_n", "_out")) else None for k in wanted} | dict(seen.get)
    counts = spark.createDataFrame([tuple(found[k] for k in wanted)], kinds)
    accurate = _accuracy(counts)
    suite = cut_lineage(run_expectation_suite(df, checks, cols, counts.drop(*_accuracy_counts())) if suite is None else suite)
    dims = dimension_scores(suite, accurate)
    return DqReport(
        dimensions=dims,
        summary=overall(dims, suite, accurate, run_time),
        checks=dimension_checks(suite),
        issues=issues,
        accuracy=accurate,
        suite=suite,
    )


def export_dimensions(report: DqReport, path: str, fmt: str = "csv") -> None:
    """The flat 4-row table (dimension, score, pct, status, description, source)."""
    out = report.dimensions.orderBy("dim_order").select("dimension", "score", "pct", "status", "description", "source")
    writer = out.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
