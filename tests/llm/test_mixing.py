import re

import pytest

from terracheck.llm import mixing


def water_level(sizes: dict) -> dict:
    """Targets by resharing the excess until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] >= 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= set(over)
    return target


def test_targets_and_copies(docs, rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = water_level(sizes)
    got = mixing.plan_mix(docs).collect()
    assert len(got) == len(rows)
    taken: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert sum(taken.values()) == pytest.approx(sum(want.values()), rel=0.3)
    assert sorted(map(str, mixing.plan_mix(docs.repartition(3)).collect())) == sorted(map(str, got))


def test_mix_repeats_rows_and_keeps_columns(docs):
    odd = docs.selectExpr("*", "1 AS rate", "'x' AS target", "array(1) AS _row", "2 AS `size`")
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    assert out.count() == sum(r.copies for r in mixing.plan_mix(docs).collect())


def test_large_sources_come_near_their_target(spark):
    docs = spark.range(30000).selectExpr("id AS doc_id", "repeat('w ', int(1 + id % 7)) AS text", "concat('s', id % 5) AS source")
    out = mixing.plan_mix(docs).groupBy("source", "target").sum("taken").collect()
    assert all(r["sum(taken)"] == pytest.approx(r.target, rel=0.02) for r in out)


def test_empty(no_docs):
    assert mixing.plan_mix(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_many_sources_are_joined_with_the_same_result(docs, monkeypatch):
    few = sorted(map(str, mixing.plan_mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted(map(str, mixing.plan_mix(docs).collect())) == few
