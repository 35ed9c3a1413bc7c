import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracheck.llm import quality

SF = "/root/testdata/sf0.01"


def test_trees_learn_an_interaction_and_traversal_matches_a_walk():
    r = np.random.default_rng(3)
    x = r.random((3000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = quality.grow(x, y, trees=30)
    s = trees.score(x)
    assert ((s > 0.5) == y).mean() > 0.97

    def walk(row):
        total = trees.base
        for f, c, v in zip(trees.feature, trees.cut, trees.value):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += v[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(s[:50], [walk(row) for row in x[:50]])


@pytest.mark.parametrize("y", [[], [1.0] * 30, [0.0] * 30])
def test_one_class_or_no_rows(y):
    trees = quality.grow(np.zeros((len(y), 4)), np.array(y))
    s = trees.score(np.ones((2, 4)))
    assert s == pytest.approx((sum(y) + 1) / (len(y) + 2))


def test_held_out_accuracy_and_folds(spark):
    got = quality.op5_quality_classifier(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    test = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in test]) > 0.95


def test_held_out_labels_teach_nothing(spark, docs):
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    flipped = labels.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 0, 0).otherwise(1))
    a, b = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert a.base == b.base and np.array_equal(a.value, b.value)


def test_odd_rows_and_columns(spark, docs, no_docs):
    labels = docs.selectExpr("doc_id", "int(length(text) % 2) AS quality", "'x' AS text")
    odd = docs.selectExpr("*", "'q' AS score", "1 AS quality")
    trees = quality.fit(odd, labels)
    out = quality.add_score(odd, trees, "s2").collect()
    assert len(out) == docs.count() and all(0 <= r.s2 <= 1 and r.score == "q" for r in out)
    by_text: dict = {}
    for r in out:
        by_text.setdefault(r.text or "", set()).add(r.s2)
    assert all(len(s) == 1 for s in by_text.values())
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r.s2 >= quality.CUT for r in out)
    assert quality.keep_good(no_docs, labels).count() == 0
    assert quality.add_score(docs, quality.fit(docs, labels.limit(0))).count() == docs.count()


def test_statistics_do_not_depend_on_neighbours(rows):
    import pyarrow as pa

    texts = [t for _, t, _ in rows]
    whole = quality.text_statistics(pa.array(texts))
    each = np.concatenate([quality.text_statistics(pa.array([t], pa.string())) for t in texts])
    assert whole.shape[1] == len(quality.FEATURES) and np.allclose(whole, each)


def test_repeated_and_string_ids_give_one_row_of_a_label(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("concat('d', id % 3) AS doc_id", "concat('word ', id) AS text")
    labels = spark.createDataFrame([("d0", 1), ("d1", 0), ("d2", 1)], "doc_id string, quality int")
    learnt, grow = [], quality.grow
    monkeypatch.setattr(quality, "grow", lambda x, y: learnt.append(len(y)) or grow(x, y))
    seen = labels.where(quality.fold(F.col("doc_id")) != 0).count()
    assert quality.keep_good(docs, labels).columns == docs.columns
    quality.fit(docs, labels, sample=1)
    assert learnt == [seen, 1] and seen > 1
