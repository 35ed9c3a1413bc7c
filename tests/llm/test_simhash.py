import hashlib
import random

from terracheck.llm import simhash


def expected(rows):
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), md5(r[1])))
    out = []
    for k, (i, t, *_) in enumerate(order):
        text, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        out.append((i, len(text), hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest()))
    return out


def test_edited_texts_and_equal_fingerprints(spark, docs, rows):
    for parts in ("1", "8"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = simhash.fingerprints(docs.selectExpr("*", "1 AS part", "2 AS fp")).collect()
        spark.conf.set("spark.sql.shuffle.partitions", before)
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
        assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(expected(rows), key=key)
    text = {}
    for i, t, _ in rows:
        text.setdefault(i, t or "")
    prints: dict = {}
    for r in got:
        prints.setdefault(text[r.doc_id], set()).add(r.fp)
    assert all(len(p) == 1 for p in prints.values()) and prints[""] == {0}


def test_one_document_and_none(spark, no_docs):
    one = simhash.fingerprints(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.next_fp == one.fp
    assert simhash.fingerprints(no_docs).count() == 0


def test_fingerprint_votes(spark):
    """Against a plain sum of votes over the distinct words."""
    from pyspark.sql import functions as F

    text = "the river the stone of naïve 北京 words words"
    words = sorted(set(text.split()))
    hashes = [r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).orderBy("w").collect()]
    want = 0
    for bit in range(64):
        vote = sum(len(w) * (1 if (h >> bit) & 1 else -1) for w, h in zip(words, hashes))
        want |= int(vote > 0) << bit
    got = simhash.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.fp & (2**64 - 1) == want


def test_search_matches_brute_force(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(60)]
    values = base + [b ^ sum(1 << k for k in r.sample(range(64), r.randrange(6))) for b in base * 3] + [0, 2**64 - 1, 0]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in [*signed, None]], "fp long")
    queries = spark.createDataFrame([(v,) for v in [*signed[:50], signed[0], None]], "fp long")
    for radius, blocks in ((3, 6), (2, 4), (0, 3)):
        got = {(x.query, x.fp, x.distance) for x in simhash.near_fingerprints(prints, queries, radius, blocks).collect()}
        apart = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
        assert got == {(q, v, apart(q, v)) for q in signed[:50] for v in signed if apart(q, v) <= radius}
