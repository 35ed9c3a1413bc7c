"""Reproduce the shape of the reference's published run on our derived assets.

2,000 rows sampled exactly (seed 42) -> errors injected (5 % / 4 % / 8 %, seed 99)
-> 2,080 rows -> expectation suite, DQ dimensions, QA issue counts, two-layer
forests, recall against the planted errors.  Prints one JSON object (result

usage: python tools/reference_run.py [sf_dir] [n_rows]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    n_rows = int(sys.argv[2]) if len(sys.argv) > 2 else 2000
    from pyspark.sql import functions as F

    from terracheck.operators import qa
    from terracheck.operators.sampling import sample_exact_n
    from terracheck.plans.runs import anomaly_run, qa_run
    from terracheck.session import cut_lineage, local_session
    from terracheck.sources.assets import load_assets, read_table
    from terracheck.sources.polygons import grid_country_edges

    spark = local_session(8)
    t0 = time.perf_counter()
    edges = grid_country_edges(read_table(spark, sf, "nation"))
    clean = cut_lineage(sample_exact_n(load_assets(spark, sf), n_rows, seed=42).drop("sample_rank"))
    run = qa_run(clean, edges)
    suite = {r.check_order: r for r in run.suite.collect()}
    dims = {r.dimension: r.score for r in run.report.dimensions.collect()}
    overall = run.report.summary.first()
    counts = {r.issue_type: (r.n_rows, r.n_ids) for r in qa.qa_issue_counts(run.issues).collect()}
    t_qa = time.perf_counter() - t0
    ml = anomaly_run(run.dirty)
    s = ml.summary.first()
    rec = ml.recall.first()
    cov = {r.model_used: r["count"] for r in ml.coverage.collect()}
    top = ml.top5.first()
    n_countries = ml.scored.where("model_used = 'country'").select("country").distinct().count()
    basic_share = run.scored.agg(F.avg(F.col("is_anomaly").cast("double"))).first()[0]
    out = {
        "rows_after_injection": run.dirty.count(),
        "expectations_passed": f"{sum(1 for r in suite.values() if r.success)} / {len(suite)}",
        "dq_dimensions": dims,
        "dq_overall": overall.overall_score,
        "null_capacity": suite[1].n_bad,
        "null_year": suite[2].n_bad,
        "duplicate_rows_and_ids": counts.get("DUPLICATE_ID"),
        "qa_issues_rows": {k: v[0] for k, v in counts.items()},
        "basic_forest_flag_share": round(basic_share, 4),
        "anomalous": s.anomalous,
        "anomalous_pct": s.pct_anomalous,
        "country_model_coverage": cov,
        "country_models": n_countries,
        "recall_vs_planted": rec.recall,
        "top_score": top.ANOMALY_SCORE,
        "seconds_qa_run": round(t_qa, 2),
        "seconds_total": round(time.perf_counter() - t0, 2),
    }
    print(json.dumps(out, ensure_ascii=False))


if __name__ == "__main__":
    main()
