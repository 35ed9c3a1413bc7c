"""What grows with the table: working memory of a scored group, shuffles on a model's key."""

import tracemalloc

import numpy as np
import pandas as pd

from terracheck.operators import forest as FO


def _forest(n_trees: int, n_features: int, psi: int, depth: int) -> pd.DataFrame:
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n_trees * psi, n_features)).round(1)
    return pd.DataFrame(FO.grow_trees(x, np.repeat(np.arange(n_trees), psi), np.arange(n_trees) * 3, depth, 5, "k"))


def _walk(x, nodes: pd.DataFrame) -> float:
    """Path length of one row in one tree, node by node."""
    by_id = nodes.set_index("node_id")
    at = by_id.loc[0]
    while at["feature"] >= 0:
        at = by_id.loc[int(at["left"] if x[int(at["feature"])] <= at["threshold"] else at["right"])]
    return at["path_len"]


def test_paths_match_a_walk_node_by_node():
    nodes = _forest(9, 3, 20, 5)
    x = np.random.default_rng(4).normal(size=(30, 3)).round(1)
    x[3, 0], x[5, 1], x[7, 2] = np.nan, np.inf, -np.inf
    got = FO.mean_path_length(x, FO.forest_arrays(nodes.sample(frac=1, random_state=2)))
    assert got.tolist() == [sum(_walk(r, t) for _, t in nodes.groupby("tree_id")) / 9 for r in x]


def test_scoring_memory_does_not_grow_with_the_group():
    arrays, peaks = FO.forest_arrays(_forest(32, 4, 64, 6)), []
    for n in (20_000, 200_000):
        x = np.random.default_rng(1).normal(size=(n, 4))
        tracemalloc.start()
        FO.score_samples(x, arrays, 64)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < 64 * 180_000  # a few doubles a row, none for each tree


def test_folded_is_the_remainder():
    p = FO.PLACES
    v = np.array([0, 1, p - 1, p, p + 1, 2 * p, p * p - 1, (p - 1) * (p - 1) + p - 1], dtype=np.int64)
    assert (FO.folded(v) == v % p).all()


def test_few_models_shuffle_no_row_by_their_key(spark, assets_small):
    _, scored = FO.fit_forest(assets_small.select("row_id", "country", "latitude"), ["latitude"], "country", 3, min_rows=10)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [model_key" in plan and "hashpartitioning(model_key" not in plan


def test_many_models_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(FO, "MAX_BROADCAST_MODELS", 2)
    df = spark.range(120).selectExpr("id AS row_id", "concat('k', id % 4) AS country", "CAST(id * 7 % 31 AS DOUBLE) AS v")
    _, scored = FO.fit_forest(df, ["v"], "country", 3)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [model_key" not in plan
    shuffled = {r.row_id: r._raw for r in scored.collect()}
    monkeypatch.undo()
    assert shuffled == {r.row_id: r._raw for r in FO.fit_forest(df, ["v"], "country", 3)[1].collect()}
