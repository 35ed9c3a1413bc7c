"""Registered queries: both end-to-end runs, sinks, renamed columns and required columns.

The runs are flattened to (part, name, figure) rows, each figure replayed by SQL on the injected
table, forests included."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.columns import DEFAULT_COLS as C
from terracheck.columns import AssetCols, require_columns
from terracheck.operators import features as FE
from terracheck.operators import inject, validate
from terracheck.plans.catalog import register
from terracheck.plans.forest_sql import forest_sql
from terracheck.plans.oracle_sql import ASSETS_CTE, EDGES_CTE, with_assets, with_edges
from terracheck.plans.queries_inject import INJECT_SQL, SEED
from terracheck.plans.queries_ml import FEATURES_SQL
from terracheck.plans.queries_rules import ASSET_VALID_SQL, country_edges
from terracheck.plans.queries_suite import _DQ_SQL
from terracheck.plans.runs import anomaly_run, qa_run
from terracheck.session import attach_row, cut_lineage, ensure_checkpoint_dir
from terracheck.sources.assets import load_assets
from terracheck.sources.sinks import write_table


def _on_dirty(tail: str) -> str:
    """SQL on the injected table under the name ``assets``."""
    return f"{ASSETS_CTE}{INJECT_SQL}SELECT * FROM (WITH assets AS (SELECT * FROM e3){tail})"


def _figures(parts: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """(part, name, figure) rows of small tables, given as (part, table, name and figure expressions)."""
    rows = [t.selectExpr(f"'{part}' AS part", f"{name} AS name", f"CAST({figure} AS DOUBLE) AS figure") for part, t, name, figure in parts]
    return reduce(DataFrame.unionByName, rows)


_QA_SQL = _on_dirty(
    EDGES_CTE
    + _DQ_SQL
    + ", med AS (SELECT quantile_cont(capacity_mw, 0.5) AS med FROM assets), basic AS (SELECT *, coalesce(capacity_mw, med) AS capacity_filled FROM assets, med)"
    + forest_sql("b", "basic", None, ["latitude", "longitude", "capacity_filled"], 200, 42)
    + """, dup AS (SELECT gppd_idnr FROM assets WHERE gppd_idnr IS NOT NULL GROUP BY gppd_idnr HAVING count(*) > 1)
SELECT 'rows' AS part, 'dirty' AS name, CAST(count(*) AS DOUBLE) AS figure FROM assets
UNION ALL SELECT 'rows', 'validated', count(*) FILTER (asset_valid) FROM va
UNION ALL SELECT 'dimension', dimension, round(raw_score, 4) FROM dq
UNION ALL SELECT 'check', CAST(check_order AS VARCHAR), CASE WHEN success THEN 1 ELSE 0 END FROM suite
UNION ALL SELECT 'anomalies', 'basic forest', count(*) FILTER (decision < 0) FROM b_decided
UNION ALL SELECT 'issues', 'OCEAN_COORDS', count(*) FROM assets WHERE (latitude BETWEEN -10 AND 10 AND longitude BETWEEN -170 AND -120)
   OR (latitude BETWEEN 5 AND 20 AND longitude BETWEEN -40 AND -20) OR (latitude BETWEEN -30 AND -10 AND longitude BETWEEN 60 AND 90)
UNION ALL SELECT 'issues', 'DUPLICATE_ID', count(*) FROM assets JOIN dup USING (gppd_idnr)
UNION ALL SELECT 'issues', 'MISSING_CAPACITY', count(*) FROM assets WHERE capacity_mw IS NULL"""
)


@register("qa_run", _QA_SQL)
def q_qa_run(spark, sf):
    """The whole QA run: injection, validation, suite, basic forest, issue report, DQ report, sinks."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/qa-run-{uuid.uuid4().hex}"
    run = qa_run(load_assets(spark, sf), country_edges(spark, sf), out, seed=SEED)
    back = lambda name: spark.read.parquet(f"{out}/{name}")
    return _figures(
        [
            ("rows", back("dirty").agg(F.count("*").alias("n")), "'dirty'", "n"),
            ("rows", back("validated").agg(F.count_if("asset_valid").alias("n")), "'validated'", "n"),
            ("dimension", run.report.dimensions, "dimension", "score"),
            ("check", run.suite, "CAST(check_order AS STRING)", "IF(success, 1, 0)"),
            ("anomalies", back("scored").agg(F.count_if("is_anomaly").alias("n")), "'basic forest'", "n"),
            ("issues", back("qa_report").groupBy("issue_type").count(), "issue_type", "count"),
        ]
    )


_ANOMALY_SQL = _on_dirty(
    FEATURES_SQL
    + forest_sql("g", "feat", None, list(FE.GLOBAL_FEATURES), 300, 42)
    + forest_sql("c", "feat", "country", list(FE.COUNTRY_FEATURES), 100, 42, min_rows=10)
    + """, two AS (SELECT g.row_id, round(g.decision, 4) AS gs, round(c.decision, 4) AS cs, g.decision < 0 OR coalesce(c.decision < 0, false) AS flagged
  FROM g_decided g LEFT JOIN c_decided c USING (row_id)),
bounds AS (SELECT -max(gs) AS gmn, -min(gs) AS gmx, -max(coalesce(cs, gs)) AS cmn, -min(coalesce(cs, gs)) AS cmx FROM two),
fin AS (SELECT row_id, cs, round(0.4 * ((-gs - gmn) / (gmx - gmn + 1e-9)) + 0.6 * ((-coalesce(cs, gs) - cmn) / (cmx - cmn + 1e-9)), 4) AS score, flagged FROM two, bounds),
judged AS (SELECT a.*, score, score > 0.6 OR flagged AS anomaly, cs IS NOT NULL AS by_country FROM assets a JOIN fin USING (row_id))
SELECT 'summary' AS part, 'total' AS name, CAST(count(*) AS DOUBLE) AS figure FROM judged
UNION ALL SELECT 'summary', 'anomalous', count(*) FILTER (anomaly) FROM judged
UNION ALL SELECT 'summary', 'avg_score', round(avg(score), 4) FROM judged
UNION ALL SELECT 'recall', 'known', count(*) FROM judged WHERE length(error_flags) > 0
UNION ALL SELECT 'recall', 'caught', count(*) FILTER (anomaly) FROM judged WHERE length(error_flags) > 0
UNION ALL SELECT 'coverage', CASE WHEN by_country THEN 'country' ELSE 'global_fallback' END, count(*) FROM judged GROUP BY by_country
UNION ALL SELECT 'markers', CASE WHEN anomaly THEN 'anomalous' ELSE 'clean' END, count(*) FROM judged GROUP BY anomaly
UNION ALL SELECT 'top', CAST(row_id AS VARCHAR), score FROM (SELECT row_id, score FROM judged ORDER BY score DESC, row_id LIMIT 5)
UNION ALL SELECT 'country', country, anomalies FROM (SELECT country, count(*) FILTER (anomaly) AS anomalies FROM judged WHERE country IS NOT NULL
  GROUP BY country ORDER BY anomalies DESC, country LIMIT 20)"""
)


@register("anomaly_run", _ANOMALY_SQL)
def q_anomaly_run(spark, sf):
    """The whole two-layer run on the injected table: scores, summary, chart tables, sinks."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/anomaly-run-{uuid.uuid4().hex}"
    dirty = cut_lineage(inject.inject_errors(load_assets(spark, sf), seed=SEED))
    run = anomaly_run(dirty, out)
    return _figures(
        [
            ("summary", run.summary, "'total'", "total"),
            ("summary", run.summary, "'anomalous'", "anomalous"),
            ("summary", run.summary, "'avg_score'", "round(avg_score, 4)"),
            ("recall", run.recall, "'known'", "known"),
            ("recall", run.recall, "'caught'", "caught"),
            ("coverage", run.coverage, "model_used", "count"),
            ("markers", spark.read.parquet(f"{out}/markers").groupBy("layer").count(), "layer", "count"),
            ("top", run.top5, "CAST(row_id AS STRING)", "ANOMALY_SCORE"),
            ("country", spark.read.parquet(f"{out}/country_rates"), "country", "anomalies"),
        ]
    )


@register(
    "sink_round_trip",
    with_assets(
        """SELECT 'csv' AS sink, row_id, country, capacity_mw, primary_fuel FROM assets
UNION ALL SELECT 'parquet', row_id, country, capacity_mw, primary_fuel FROM assets WHERE country = 'C03'"""
    ),
)
def q_sink_round_trip(spark, sf):
    """A CSV with header read back, and one country of a table that is partitioned by it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sink-{uuid.uuid4().hex}"
    a = load_assets(spark, sf).select("row_id", "country", "capacity_mw", "primary_fuel")
    write_table(a, f"{path}/csv", "csv")
    write_table(a, f"{path}/parquet", partition_by="country")
    csv = spark.read.schema(a.schema).option("header", True).csv(f"{path}/csv")
    one = spark.read.parquet(f"{path}/parquet").where("country = 'C03'").select(a.columns)
    return csv.withColumn("sink", F.lit("csv")).unionByName(one.withColumn("sink", F.lit("parquet")))


#: A table whose columns have other names.
OTHER = AssetCols("key", "Plant Id", "title", "MW", "phi", "lambda", "iso", "fuel", "since", "marks")


@register(
    "renamed_columns",
    with_edges(ASSET_VALID_SQL + 'SELECT row_id AS "key", asset_valid, asset_errors, geometry_consistent FROM va'),
)
def q_renamed_columns(spark, sf):
    """A1: the asset validation on a table with other column names."""
    a = load_assets(spark, sf)
    names = {getattr(C, f): getattr(OTHER, f) for f in C.__dataclass_fields__}
    out = validate.validate_assets(a.withColumnsRenamed({k: v for k, v in names.items() if k in a.columns}), country_edges(spark, sf), OTHER)
    return out.select("key", "asset_valid", "asset_errors", "geometry_consistent")


_NEEDED = ("capacity_mw", "country", "gppd_idnr", "latitude", "longitude")


@register(
    "required_columns",
    with_assets(
        "SELECT c AS dropped, 'asset table is missing columns: [''' || c || ''']' AS message, (SELECT count(*) FROM assets) AS n_rows "
        f"FROM (SELECT unnest({list(_NEEDED)}) AS c)"
    ),
)
def q_required_columns(spark, sf):
    """A2: what a table without one of the needed columns is told, next to its row count."""
    a = load_assets(spark, sf)
    said = []
    for name in _NEEDED:
        try:
            require_columns(a.drop(name), _NEEDED, "asset table")
        except ValueError as error:
            said.append((name, str(error)))
    return attach_row(spark.createDataFrame(said, "dropped string, message string"), a.agg(F.count("*").alias("n_rows")))
