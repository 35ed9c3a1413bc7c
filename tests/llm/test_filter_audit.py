"""The filter audit against applying the filters one after the other."""

import re
from itertools import permutations

import numpy as np
import pytest

from terracheck.llm import filter_audit as fa
from terracheck.llm.lookup import look_up

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Audit rows as a dict, from the definitions of the filters."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in rows:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    fails, parts = [], {}
    for i, (d, text, lang) in enumerate(rows):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = ""
        failed += "A" if len(words) < 200 else ""
        failed += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        failed += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        failed += "D" if re.search(r"[#$%&*|]", text) else ""
        failed += "E" if d is not None and first[text] < d else ""
        fails.append(failed)
        parts.setdefault(lang or "", []).append(i)
    out = {}
    for part, members in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                gone = [i for i in left if x in fails[i]]
                shapley[x] += len(gone)
                kept = [i for i in left if x not in fails[i]]
                all_failing = [i for i in members if x in fails[i]]
                out[part, "".join(order), step] = [
                    len(kept), len(gone), len(all_failing) - len(gone), sum(fails[i] == x for i in members),
                    sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone),
                ]
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def found(df):
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in df.collect()}


@pytest.fixture(scope="module")
def mixed(rows):
    more = [(7000 + i, "UPPER " * (i % 4) + "word%d " % i * 3 + "x " * (230 if i % 3 else 1) + ("$" if i % 5 == 0 else ""), "s%d" % (i % 3)) for i in range(60)]
    more += [(7100 + i, " ".join("w%d" % k for k in range(250)), "s1") for i in range(9)] + [(None, "no id here at all", "s1"), (None, "", None)]
    return rows + more


def test_audit_equals_the_definitions(spark, mixed):
    labels = [(d, i % 2, i % 3 == 0) for i, (d, _, _) in enumerate(mixed) if i % 4] + [(7001, 1, 1), (7001, 0, 0), (None, 1, 1), (123456, 1, 1)]
    docs = spark.createDataFrame(mixed, "doc_id long, text string, lang string").repartition(4)
    marks = spark.createDataFrame([(d, int(q), int(t)) for d, q, t in labels], LABELS)
    assert found(fa.audit(docs, marks)) == brute(mixed, labels)


def test_extra_columns_and_string_ids(spark):
    rows = [("b", "same", "x"), ("a", "same", "x"), (None, "same", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string").selectExpr("*", "1 AS digest", "2 AS failed", "3 AS part", "4 AS _hot", "5 AS first")
    marks = spark.createDataFrame([("b", 1, None)], "doc_id string, quality int, toxic int")
    assert found(fa.audit(docs, marks)) == brute(rows, [("b", 1, None)])


def test_empty(spark, no_docs):
    docs = no_docs.withColumnRenamed("source", "lang")
    assert fa.audit(docs, spark.createDataFrame([], LABELS)).count() == 0


def test_one_text_in_a_third_of_the_rows(spark):
    rows = [(i, "the same text" if i % 3 == 0 else "text %d" % i, "l") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = fa.audit(docs, spark.createDataFrame([], LABELS)).where("filter_order = 'EABCD' AND step = 1").first()
    assert (got.kept, got.removed, got.redundant, got.unique_fails) == (4001, 1999, 0, 0)


def test_long_text_is_read_in_pieces(monkeypatch):
    text = " ".join("w%d" % (k % 997) for k in range(5000)).encode()
    whole = fa.text_failures(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(fa, "PIECE_BYTES", size)
        assert fa.text_failures(text) == whole


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 31, 1000])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    want = ((words[:, None].astype(np.int64) >> np.arange(32)) & 1).sum(axis=0)
    assert (fa.positional_popcount(words) == want).all()


def test_look_up_equals_a_left_join(spark):
    rows = [(None if i % 7 == 0 else i % 50 if i % 3 else 5, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, i int")
    table = spark.createDataFrame([(k, k * 10) for k in range(40)] + [(None, -1)], "k int, v int")
    want = sorted((i, None if k is None or k >= 40 else k * 10) for k, i in rows)
    for hot in (1, 3, 1024):
        assert sorted((r.i, r.v) for r in look_up(df, table, ["k"], hot).collect()) == want
