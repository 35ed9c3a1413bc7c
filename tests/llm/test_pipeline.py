"""The pipeline against a chain of plain-Python stages, each on what the one before kept."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from terracheck.llm import mixing, quality

from .test_decontam import brute as hits
from .test_jaccard import brute as components
from .test_jaccard import shingles
from .test_mixing import water_level
from .test_secrets import base_of

PASSAGE = " ".join(f"exam{i}" for i in range(25))
KEY = "password = hunter2hunter2"


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    planted = [(8001, "before " + PASSAGE + " after", "s1"), (8002, "alpha beta " * 20 + KEY + " gamma", "s2"), (8003, "clean words only here", None)]
    seen = {}
    for r in rows + planted:  # one row of an id: rows of one id would share their draws
        seen.setdefault(r[0], r)
    docs = [r for i, r in seen.items() if i is not None]
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3).write.parquet(f"{path}/documents.parquet")
    good = [(r[0], 0 if len(r[1] or "") % 5 == 0 else 1) for r in docs]
    spark.createDataFrame(good, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("b1", PASSAGE), ("b2", None)], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain(rows):
    return sorted((r.doc_id, r.text, r.source) for r in rows)


def kept_by_quality(spark, sf_dir, docs):
    trees = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def score(text):
        row, total = quality.text_statistics(pa.array([text], pa.string()))[0], trees.base
        for f, c, v in zip(trees.feature, trees.cut, trees.value):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += v[node - len(f)]
        return 1 / (1 + np.exp(-total))

    return [d for d in docs if score(d[1]) >= 0.3]


def one_of_each(docs):
    found = components(docs, 5, 80, 100)
    return [d for d, (i, _, least) in zip(docs, found) if i == least or not shingles(d[1], 5)]


def uncontaminated(docs):
    out = []
    for d in docs:
        words, hit, _ = hits(d[1], [("b1", PASSAGE), ("b2", None)])
        if not (hit and 20 * hit >= words):
            out.append(d)
    return out


def mixed(docs):
    size = {d[0]: len((d[1] or "").split()) for d in docs}
    total: dict = {}
    for i, _, s in docs:
        total[s] = total.get(s, 0) + size[i]
    target, out = water_level(total), []
    for d in docs:
        rate = target[d[2]] / total[d[2]] if total[d[2]] else 0.0
        u = int(hashlib.md5(f"mix|{mixing.SEED}|{d[0]}".encode()).hexdigest()[:12], 16) / 2**48
        out += [d] * (math.floor(rate + 1e-12) + (u < rate - math.floor(rate + 1e-12)))
    return out


def test_stages_and_whole_match_a_plain_chain(spark, sf_dir):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "secrets", "mix"]
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = plain(table.collect())

    def step(name, rows):
        return plain(stages[name](spark, spark.createDataFrame(rows, table.schema), sf_dir).collect())

    good = step("quality", docs)
    assert good == sorted(kept_by_quality(spark, sf_dir, docs), key=lambda d: d[0]) and 0 < len(good) <= len(docs)
    single = step("near_duplicates", good)
    assert single == sorted(one_of_each(good), key=lambda d: d[0]) and len(single) < len(good)
    clean = step("decontamination", single)
    assert clean == sorted(uncontaminated(single), key=lambda d: d[0])
    safe = step("secrets", clean)
    assert [(i, s) for i, _, s in safe] == [(i, s) for i, _, s in clean]
    for (_, before, _), (_, after, _) in zip(clean, safe):
        assert before == after or (before and after)
        assert not base_of(after) or "hunter2" not in after
    taken = step("mix", safe)
    assert [d for d in taken] == sorted(mixed(safe), key=lambda d: d[0])
    assert plain(corpus_pipeline.run(spark, sf_dir).collect()) == taken
