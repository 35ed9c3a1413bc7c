"""Exact quantiles against numpy: hot keys, hot values, NULL keys."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from terracheck.operators import quantiles as Q
from terracheck.operators.quantiles import exact_quantile, exact_quantiles_row


@pytest.mark.parametrize("q", [0.08, 0.5, 0.9])
def test_matches_numpy(spark, q):
    rng = np.random.default_rng(1)
    keys = np.where(rng.random(5000) < 0.34, "HOT", rng.choice(["a", "b", "c", "d"], 5000))
    vals = rng.normal(size=5000).round(3)  # many ties
    vals[::50] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"k": keys, "v": vals})).repartition(4)
    fast = {r.k: r.quantile for r in exact_quantile(df, "v", q, ["k"]).collect()}
    assert fast.keys() == set(keys)
    for k in fast:
        expect = np.quantile(vals[(keys == k) & ~np.isnan(vals)], q)
        assert fast[k] == pytest.approx(expect, abs=1e-12)


def test_global_and_row(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, 2.0, 3.0, 10.0], "b": [5.0, None, 1.0, 3.0]}))
    assert exact_quantile(df, "a", 0.5).first()[0] == 2.5
    r = exact_quantiles_row(df, ["a", "b"], 0.5, "_m").first()
    assert (r.a_m, r.b_m) == (2.5, 3.0)
    empty = df.where("a > 100")
    assert exact_quantile(empty, "a", 0.5).first()[0] is None


def test_approx_opt_in_is_close(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame({"k": rng.choice(["a", "b"], 20000), "v": rng.normal(size=20000)}))
    exact = {r.k: r.quantile for r in exact_quantile(df, "v", 0.5, ["k"]).collect()}
    approx = {r.k: r.quantile for r in exact_quantile(df, "v", 0.5, ["k"], approx=True).collect()}
    for k in exact:
        assert abs(exact[k] - approx[k]) < 0.01


def test_null_key_hot_value_and_nan(spark):
    rows = [(None, float(i % 7)) for i in range(70)] + [("a", 5.0)] * 600 + [("a", float(i)) for i in range(400)] + [("a", float("nan")), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for q in (0.25, 0.5, 0.9):
        got = {r.k: r.quantile for r in exact_quantile(df, "v", q, ["k"]).collect()}
        assert set(got) == {None, "a"}
        for k in got:
            assert got[k] == pytest.approx(np.quantile([v for key, v in rows if key == k and v is not None and v == v], q))


ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2), -1.0, 0.1, 1 / 3]
ODD += [2.0**k for k in range(-1074, 1024, 37)] + [np.nextafter(2.0**k, 0) for k in range(-1000, 1024, 41)] + [-np.nextafter(2.0**k, 0) for k in range(-1000, 1024, 97)]
ODD += [1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 123456.789, -1e-7]


def test_bits_keep_order_and_come_back(spark):
    rng = np.random.default_rng(4)
    some = ODD + rng.integers(0, 2**63, 3000, dtype=np.uint64).view(np.float64)[:3000].tolist()
    some = [float(v) for v in some if v == v]
    df = spark.createDataFrame([(v,) for v in some], "v double").select("v", Q.ordered_bits(F.col("v")).alias("b"))
    rows = df.withColumn("back", Q.value_of_bits(F.col("b"))).collect()
    assert all(r.v == r.back for r in rows)
    rows.sort(key=lambda r: r.v)
    assert all((x.v < y.v) == (x.b < y.b) and (x.v == y.v) == (x.b == y.b) for x, y in zip(rows, rows[1:]))


@pytest.mark.parametrize("most", [4, 64])
def test_every_round_runs(spark, monkeypatch, most):
    """With few counts allowed, all four rounds and the stored prefixes are used."""
    rng = np.random.default_rng(6)
    vals = np.concatenate([rng.normal(size=500), np.full(200, 0.25), 1.0 + rng.integers(0, 40, 300) * 2.0**-52, [1e300, -1e300, np.inf, -np.inf]])
    keys = rng.choice(["a", "b", "c", None], len(vals))
    rows = [(None if k is None else str(k), float(v)) for k, v in zip(keys, vals)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    monkeypatch.setattr(Q, "MAX_COUNTS", most)
    got = {r.k: (r.q0, r.q1, r.q2) for r in Q.exact_quantiles(df, ["k"], "v", [0.0, 0.5, 0.93]).collect()}
    assert set(got) == {"a", "b", "c", None}
    for k, q in got.items():
        mine = np.sort([v for key, v in rows if key == k])
        at = [p * (len(mine) - 1) for p in (0.0, 0.5, 0.93)]
        want = [mine[int(np.floor(p))] + (mine[int(np.ceil(p))] - mine[int(np.floor(p))]) * (p - np.floor(p)) if mine[int(np.floor(p))] != mine[int(np.ceil(p))] else mine[int(np.floor(p))] for p in at]
        assert q == pytest.approx(want, rel=1e-15)


def test_groups_and_the_whole_table_together(spark):
    rows = [("a", 1.0), ("a", 4.0), (None, 7.0), ("b", None), ("c", 2.0)]
    each, whole = Q.quantile_by_and_overall(spark.createDataFrame(rows, "k string, v double"), "v", 0.5, "k")
    assert {r.k: r.quantile for r in each.collect()} == {"a": 2.5, None: 7.0, "c": 2.0} and [tuple(r) for r in whole.collect()] == [(3.0,)]
    none = spark.createDataFrame([], "k string, v double")
    each, whole = Q.quantile_by_and_overall(none, "v", 0.5, "k")
    assert each.count() == 0 and [tuple(r) for r in whole.collect()] == [(None,)]
