import random
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from terracheck.llm import jaccard
from terracheck.llm.common import LOWER, UPPER
from terracheck.llm.components import merge_labels


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    return frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, num, den):
    """(id, set size, component) of every row, by all pairs."""
    sets = [shingles(t, k) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                up[find(a)] = find(b)
    members = defaultdict(list)
    for x in range(len(rows)):
        members[find(x)].append(rows[x][0])
    least = {c: min((i for i in m if i is not None), default=None) for c, m in members.items()}
    return [(rows[x][0], len(sets[x]), least[find(x)] if sets[x] else rows[x][0]) for x in range(len(rows))]


def chain(n):
    """Texts that each link with the next one only: components must follow links."""
    words = [f"c{i}" for i in range(40 + n)]
    return [(5000 - i, " ".join(words[i : i + 40]), "s") for i in range(n)]


key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or -1)


@pytest.mark.parametrize("k,num,den,rounds", [(4, 85, 100, 4), (2, 50, 100, 1), (5, 80, 100, 2)])
def test_components_match_all_pairs(spark, rows, k, num, den, rounds):
    rows = rows + chain(25)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS node", "2 AS n", "3 AS th").repartition(4)
    got = jaccard.link_components(docs, k, num, den, rounds).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, k, num, den), key=key)


def test_one_of_each_group_stays(spark, rows, docs):
    odd = docs.selectExpr("*", "1 AS th", "2 AS label")
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    found = brute(rows, 5, 80, 100)
    want = sorted([r[0] for r in set(found) if r[1] and r[0] is not None and r[0] == r[2]] + [r[0] for r in found if not r[1]])
    got = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in got if i is not None) == want and got.count(None) == 1


def test_empty(no_docs, spark):
    assert jaccard.link_components(no_docs).count() == 0 and jaccard.keep_one(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (2, " ")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.link_components(blank).collect()) == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]
    assert jaccard.keep_one(blank).count() == 3


def test_merge_labels_on_long_chains(spark):
    labels = spark.range(200).selectExpr("id", "id AS label")
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 98)] + [(150, 120), (150, 199), (120, 120)], "a long, b long")
    got = {r.id: r.label for r in merge_labels(labels, links).collect()}
    assert all(got[i] == 0 for i in range(99)) and got[120] == got[150] == got[199] == 120 and got[130] == 130


def near_copies(n):
    """Texts that differ from one in up to 12 places, in groups that share their changes."""
    words = [f"n{i}" for i in range(300)]
    out = []
    for i in range(n):
        new = list(words)
        for j in range(i % 13):
            new[(i % 3) * 90 + 7 * j] = f"x{i % 5}q{j}"
        out.append((7000 + i, " ".join(new[: 300 - i % 7]), "s"))
    return out


@pytest.mark.parametrize("k,num,den,rounds", [(4, 85, 100, 2), (2, 50, 100, 1)])
def test_links_are_counted_by_all_pairs(spark, rows, k, num, den, rounds):
    rows = rows + chain(25) + near_copies(60)
    sets = [shingles(t, k) for _, t, *_ in rows]
    links = [sum(bool(s) and a != b and den * len(s & t) >= num * len(s | t) for b, t in enumerate(sets)) for a, s in enumerate(sets)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS node", "2 AS links", "3 AS c").repartition(4)
    got = jaccard.link_numbers(docs, k, num, den, rounds).collect()
    want = [(*r, n) for r, n in zip(brute(rows, k, num, den), links)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key) and max(links) > 20


def test_links_of_nothing(spark, no_docs):
    assert jaccard.link_numbers(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "One")], "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.link_numbers(blank).collect()) == [(1, 0, 1, 0), (2, 0, 2, 0), (3, 1, 3, 1), (4, 1, 3, 1)]


def test_links_at_pivots_are_those_of_all_pairs_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 8)
    r = random.Random(5)
    sets, rows = {}, []
    for pivot in (1, 1000, 2000):
        base = list(range(pivot * 1000, pivot * 1000 + (200 if pivot < 2000 else 3)))
        for i in range(60 if pivot < 2000 else 2):
            gone = set(r.sample(base, r.randrange(0, 40) if i and len(base) > 40 else 0))
            new = {10**9 + r.randrange(60) for _ in range(r.randrange(0, 30) if i else 0)}
            sets[pivot + i] = frozenset(base) - gone | new
            delta = sorted(sets[pivot + i] ^ sets[pivot])
            rows.append((pivot + i, pivot, len(delta), len(sets[pivot + i]), 1 + i % 3, b"".join(x.to_bytes(8, "little") for x in delta)))
    join = object.__new__(jaccard.Join)
    join.num, join.den = 85, 100
    table = spark.createDataFrame(rows, "node long, pivot long, d int, n int, c long, delta binary")
    join.deltas = table.selectExpr("node AS id", "pivot", "delta")
    got = {x.node: x.links for x in join.links_at_pivots(table.drop("delta")).groupBy("node").agg({"links": "sum"}).withColumnRenamed("sum(links)", "links").collect()}
    linked = lambda s, t: 100 * len(s & t) >= 85 * len(s | t)
    want = {a: sum(c for b, q, _, _, c, _ in rows if q == p and b != a and linked(sets[a], sets[b])) for a, p, *_ in rows}
    assert {a: got.get(a, 0) for a in want} == want and len(set(want.values())) > 20


def test_first_elements_are_those_of_a_full_sort():
    r = np.random.default_rng(3)
    edges = np.concatenate(([0], np.cumsum(r.integers(0, 30, 200))))
    size = np.diff(edges)
    row = np.repeat(np.arange(200), size)
    element, weight = r.integers(0, 1000, len(row)).astype(np.uint64), (r.random(len(row)) < 0.6) * r.integers(1, 4, len(row)).astype(np.uint64)
    element = element[np.lexsort((element, row))]
    keep = np.minimum(size, r.integers(0, 30, 200))
    order = np.lexsort((element, weight, row))
    want = order[(np.arange(len(order)) - np.repeat(edges[:-1], size)) < np.repeat(keep, size)]
    got = jaccard.first_elements(element, edges, weight, keep)
    assert element[got].tolist() == element[want].tolist() and weight[got].tolist() == weight[want].tolist()


def test_sets_without_a_partner_leave_before_any_round(spark):
    r = random.Random(2)
    passage = [f"p{i}" for i in range(100)]
    rows = [(i, " ".join([f"w{r.randrange(10**6)}" for _ in range(100)] + passage), "s") for i in range(40)] + near_copies(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    join = jaccard.Join(docs, jaccard.prefixes(docs, 4, 85, 100), 4, 85, 100)
    # half of each text is a passage of all: the passage's lists hold 40 sets, and none of them can link
    assert join.labels.count() == join.posts.select("node").distinct().count() == 6


def test_sets_are_made_of_small_pieces(spark, monkeypatch):
    seen, make = [], jaccard.shingle_sets
    text = " ".join(f"word{i % 977}" for i in range(30_000))

    def watched(raw, off, k):
        tracemalloc.start()
        out = make(raw, off, k)
        seen.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        return out

    monkeypatch.setattr(jaccard, "shingle_sets", watched)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([text[:150_000]] * 16)], names=["text"])

    class Docs:
        """Runs the scan here, on one batch."""

        def select(self, *_):
            return self

        def mapInArrow(self, scan, _):  # noqa: N802
            assert sum(b.num_rows for b in scan(iter([batch]))) > 0
            raise StopIteration

    with pytest.raises(StopIteration):
        jaccard.heavy_elements(Docs(), 4)
    assert len(seen) > 4 and max(seen) < 60 << 20
