import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from terracheck.llm import suffixes


def brute(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (i, *_), b in zip(rows, texts):
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


key = lambda r: (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("length", [400, 120, 40])
def test_matches_every_window(spark, rows, docs, length):
    odd = docs.selectExpr("*", "1 AS th", "2 AS place", "3 AS copies")
    got = suffixes.repeats(odd, length).drop("spans").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, length), key=key)


def test_edges_and_periodic_texts(spark):
    r = random.Random(11)
    noise = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    p, q = noise(100), noise(60)
    rows = [
        (1, p), (2, noise(30) + p + noise(30)), (3, p[:99]), (4, noise(10) + p[1:] + noise(9)), (5, "a" * 200), (6, "ab" * 100), (7, noise(5) + q + noise(50) + q), (8, noise(10) + p[20:81]),
        (9, noise(3) + p[40:] + q), (10, p[:60] + p[60:] + p[:59]), (11, "é" * 40), (11, "xé" + "é" * 39), (12, "a" * 59), (13, noise(60)), (None, noise(20) + q[:59]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.repeats(docs, 60).collect()
    assert sorted([tuple(x)[:-1] for x in got], key=key) == sorted(brute(rows, 60), key=key)
    for x in got:
        assert sum(b - a for a, b in zip(x.spans[::2], x.spans[1::2])) == x.n_removed and len(x.spans) == 2 * x.n_spans


def test_empty(no_docs):
    assert suffixes.repeats(no_docs).count() == 0
