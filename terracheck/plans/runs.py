"""End-to-end runs: the QA run and the two-layer anomaly run.

``qa_run``: inject errors -> asset validation -> expectation suite -> basic forest ->
QA issue report -> DQ report.  ``anomaly_run``: two-layer forests -> projection ->
chart tables -> summary.  Both return DataFrames (lazy, except the bounded actions
inside injection and the forests) and write them when an output folder is given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from terracheck.columns import DEFAULT_COLS, AssetCols
from terracheck.operators import charts, dq, evaluate, inject, qa, scoring, validate
from terracheck.session import cut_lineage
from terracheck.sources.assets import project_existing
from terracheck.sources.sinks import write_table


@dataclass
class QaRun:
    dirty: DataFrame
    validated: DataFrame
    suite: DataFrame
    scored: DataFrame
    issues: DataFrame
    report: dq.DqReport


def qa_run(
    assets: DataFrame,
    country_edges: DataFrame,
    out_dir: str | None = None,
    pct_ocean=0.05,
    pct_duplicate=0.04,
    pct_missing=0.08,
    seed=99,
    ocean_mode: str = "bbox",
    land_edges: DataFrame | None = None,
    cols: AssetCols = DEFAULT_COLS,
) -> QaRun:
    dirty = cut_lineage(inject.inject_errors(assets, pct_ocean, pct_duplicate, pct_missing, seed, cols))
    validated = validate.validate_assets(dirty, country_edges, cols)
    _, scored = scoring.train_isolation_forest(dirty, 0.08, 200, 42, cols)
    issues = qa.detect_qa_errors(dirty, cols, ocean_mode, land_edges)
    report = dq.build_dq_report(dirty, validated=validated, cols=cols, write_to=f"{out_dir}/validated" if out_dir else None)
    if out_dir:
        write_table(assets, f"{out_dir}/clean")
        write_table(dirty, f"{out_dir}/dirty")
        write_table(scored, f"{out_dir}/scored")
        write_table(issues, f"{out_dir}/qa_report")
        dq.export_dimensions(report, f"{out_dir}/dq_dimensions")
    return QaRun(dirty, validated, report.suite, scored, issues, report)


@dataclass
class AnomalyRun:
    scored: DataFrame
    summary: DataFrame
    recall: DataFrame
    coverage: DataFrame
    top5: DataFrame
    markers: DataFrame
    histogram: DataFrame
    country_rates: DataFrame


def anomaly_run(dirty: DataFrame, out_dir: str | None = None, contamination=0.08, seed=42, cols: AssetCols = DEFAULT_COLS) -> AnomalyRun:
    scored = cut_lineage(scoring.run_ml_anomaly_detection(dirty, contamination, seed, cols))
    run = AnomalyRun(
        scored=scored,
        summary=evaluate.anomaly_summary(scored),
        recall=evaluate.detection_recall(scored, cols.flags),
        coverage=evaluate.model_coverage(scored),
        top5=evaluate.top_anomalies(scored),
        markers=charts.marker_table(scored, cols),
        histogram=charts.score_histogram(scored),
        country_rates=charts.country_anomaly_rate(scored, cols),
    )
    if out_dir:
        write_table(project_existing(scored, scoring.SCORED_OUTPUT_COLUMNS), f"{out_dir}/ml_scored")
        write_table(run.markers, f"{out_dir}/markers", partition_by="layer")
        write_table(run.histogram, f"{out_dir}/score_histogram")
        write_table(run.country_rates, f"{out_dir}/country_rates")
    return run
