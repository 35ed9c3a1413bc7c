import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracheck.llm import lattice
from terracheck.llm.common import LOWER, UPPER


def paths(pieces, chars):
    """Probability of a marked word, over all segmentations one by one."""
    table = dict(zip(pieces.texts, np.exp(pieces.logp)))
    byte = math.exp(pieces.logp[-2])
    if not chars:
        return 1.0
    total = 0.0
    for n in range(1, len(chars) + 1):
        p = table.get(chars[:n])
        if p is None and n == 1:
            p = byte ** len(chars[0].encode())
        if p:
            total += p * paths(pieces, chars[n:])
    return total


@pytest.fixture(scope="module")
def pieces():
    return lattice.load_pieces()


def test_pieces_bytes_and_end_sum_to_one(pieces):
    fitted = pieces.with_counts(lattice.expected_counts(pieces, ["the", "北京x", "☃☃"], np.array([3.0, 1.0, 2.0])))
    for p in (pieces, fitted):
        assert np.exp(p.logp[:-2]).sum() + 256 * math.exp(p.logp[-2]) + math.exp(p.logp[-1]) == pytest.approx(1)


def test_forward_sums_all_segmentations(pieces):
    words = ["the", "therand", "naïve", "x☃y", "ththth", "a", "北京"]
    none = lattice.Discount(0, 0, 0, 0)
    logs = lattice.word_logs(pieces, words, np.zeros(len(words)), none)
    for w, got in zip(words, logs):
        assert got == pytest.approx(math.log(paths(pieces, "▁" + w)))


def test_expected_counts_match_path_by_path(pieces):
    word, counts = "there", lattice.expected_counts(pieces, ["there"], np.array([1.0]))
    length = sum(len(t) * c for t, c in zip(pieces.texts, counts))
    assert length == pytest.approx(len(word) + 1) and counts.min() >= 0


def test_em_raises_the_likelihood(pieces):
    words, p = ["thering", "ringther", "herring", "erring"], pieces
    seen = []
    for _ in range(4):
        seen.append(sum(lattice.Lattice(p, c).forward[-1].sum() for _, c in lattice._batches(words)))
        p = p.with_counts(lattice.expected_counts(p, words, np.full(4, 1000.0)))
    assert seen == sorted(seen)


def test_scores_match_brute_force(docs, rows, pieces, monkeypatch):
    monkeypatch.setattr(lattice, "HEAD", 5)  # nearly all words take the joined way
    got = lattice.score_corpus(docs.selectExpr("*", "1 AS train", "2 AS row", "3 AS hash"), lattice.fold(F.col("doc_id")) == 2).collect()
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans(UPPER, LOWER))) + ["\n"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t, _ in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i is None, i or 0, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, t, _ in rows for w in [tokens(t)])
    assert sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    once, twice = (sum(x == k and w != "\n" for w, x in c.items()) for k in (1, 2))
    discount = lattice.Discount(n, v, once, twice)
    p = pieces
    known = sorted(w for w in c if w != "\n")
    for _ in range(lattice.ROUNDS):
        counts = lattice.expected_counts(p, known, np.ones(len(known)))
        counts[-1] = 1.0
        p = p.with_counts(counts)
    text = {i: t for i, t, _ in rows}
    for r in got[:40]:
        w = tokens(text[r.doc_id])[:-1]
        logs = lattice.word_logs(p, w, np.array([c[x] for x in w]), discount).sum() if w else 0.0
        end = np.logaddexp(discount.rest + p.logp[-1], discount.arc(np.array(c["\n"])))
        assert r.score == pytest.approx((logs + end) / math.log(10), rel=1e-6)


def test_no_training_documents_and_empty(docs, no_docs):
    out = lattice.score_corpus(docs, F.lit(True)).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) and r.score < 0 for r in out)
    assert lattice.score_corpus(no_docs, F.lit(False)).count() == 0


def test_a_very_long_word(pieces):
    assert math.isfinite(lattice.word_logs(pieces, ["ab" * 1500], np.zeros(1), lattice.Discount(0, 0, 0, 0))[0])
