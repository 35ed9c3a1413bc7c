"""Vector codes against plain Lloyd rounds in whole numbers."""

import hashlib
import math
import random

import pytest

from terracheck.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error) of each row, and the digest, by the definitions."""
    good = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(good[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    first = {}
    for i, v, _ in good:
        if i is not None:
            first[i] = min(v, first.get(i, v))
    books = [[cut(first[i])[p] for i in sorted(first)[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, a: min((away(a, c), k) for k, c in enumerate(books[p]))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            members = {}
            for _, v, _ in good:
                a = cut(v)[p]
                members.setdefault(near(p, a)[1], []).append(a)
            for k, m in members.items():
                new[p][k] = [sum(col) // len(m) for col in zip(*m)]
        books = new
    out, by_label = [], {}
    for i, v, lab in good:
        hits = [near(p, a) for p, a in enumerate(cut(v))]
        error = sum(h[0] for h in hits)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join("%02x" % h[1] for h in hits), error, lab))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab]) for i, c, e, lab in out), key=str), digest


def found(table, **kw):
    rows, books = vc.compress(table, **kw)
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in rows.collect()), key=str), vc.books_digest(books)


def vectors(seed, n, width, spread=0.3):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(width)] for _ in range(7)]
    rows = [(i * 2, [c + r.gauss(0, spread) for c in r.choice(centres)], r.choice([0, 1, 1, None])) for i in range(n)]
    rows += [(9000, None, 1), (9001, [None] + [0.0] * (width - 1), 1), (9002, [math.nan] * width, 0), (9003, [math.inf] * width, None), (9004, [-math.inf] + [0.0] * (width - 1), 0)]
    rows += [(None, [0.25] * width, 2), (None, [0.25] * width, None), rows[3], (rows[4][0], [0.5] * width, 0)]
    return rows


@pytest.mark.parametrize("seed,n,width,entries", [(1, 150, 32, 64), (2, 40, 16, 64), (3, 200, 48, 5), (4, 1, 16, 64)])
def test_codes_equal_plain_rounds(spark, seed, n, width, entries):
    rows = vectors(seed, n, width) if n > 1 else [(1, [0.5] * width, None)]
    rows = [(i, v if v is None else [x if x is None else float(f"{x:.3f}") * 1.0 for x in v], lab) for i, v, lab in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    assert found(table, entries=entries) == plain(rows, entries=entries)


def test_more_rounds_migrate_members(spark):
    rows = vectors(5, 300, 16, spread=0.8)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    for rounds in (0, 1, 4):
        assert found(table, rounds=rounds, entries=9) == plain(rows, rounds=rounds, entries=9)


def test_migrate_keeps_every_member(spark):
    rows = vectors(6, 200, 16, spread=0.8)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("vec_id", "embedding AS vector")
    table = table.where(vc.usable(table["vector"]))
    books = vc.first_codebooks(table, 16, 9)
    members = vc.settle(table, books, 8).cache()
    assert members.where("salt > 0").count() > 0
    books = vc.updated(members, books)
    after = vc.migrate(members, books).cache()
    value = lambda df: sorted(map(tuple, df.select("position", "v0").collect()))
    assert value(after) == value(members)
    assert after.join(members, ["position", "entry", "salt", "v0"], "left_anti").count() > 0  # some changed their entry


def test_ties_go_to_the_lower_index():
    import numpy as np

    best, error = vc.nearest(np.array([[1], [3], [2]]), np.array([[4], [2], [0], [2]]))
    assert best.tolist() == [1, 0, 1] and error.tolist() == [1, 1, 0]
    big = 1 << 30  # beyond what doubles hold exactly
    best, error = vc.nearest(np.array([[big + 1]]), np.array([[0], [big], [big + 2]]))
    assert best.tolist() == [1] and error.tolist() == [1]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows, books = vc.compress(empty)
    assert rows.count() == 0 and books is None and rows.columns == ["vec_id", "label", "code", "error", "label_error"]
    nameless = spark.createDataFrame([(None, [0.5] * 16, 1)], SCHEMA)
    assert [tuple(r) for r in vc.compress(nameless)[0].collect()] == [(None, 1, None, None, None)]
    odd = spark.createDataFrame([(1, [0.5] * 17, 1)], SCHEMA)
    with pytest.raises(ValueError, match="cannot be cut"):
        vc.compress(odd)
    ragged = spark.createDataFrame([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], SCHEMA)
    with pytest.raises(Exception, match="must all have"):
        vc.compress(ragged)[0].collect()


def test_clashing_columns_and_decoding(spark):
    rows = vectors(8, 60, 16)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    odd = table.selectExpr("*", "1 AS vector", "2 AS error", "3 AS code", "4 AS position", "5 AS salt", "6 AS _label")
    assert found(odd) == found(table)
    codes, books = vc.compress(table)
    for r in vc.decoded(codes, books).collect():
        assert len(r.vector) == 16 and [int(r.code[2 * p : 2 * p + 2], 16) for p in range(16)] == [
            next(k for k in range(64) if books[p, k, 0] == round(v * 256)) for p, v in enumerate(r.vector)
        ]
