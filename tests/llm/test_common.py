import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from terracheck.llm.common import ALNUM_TABLE, BATCH_BYTES, LOWER, SPACE_TABLE, UPPER, fresh_name, pack_texts, read_table, shingle_hashes, text_slices, tokenise, unpack, word_hashes, written

PATTERNS = {SPACE_TABLE: r"[^\x20\x09-\x0D]+", ALNUM_TABLE: r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


def test_words_match_the_patterns(rows):
    texts = [t for _, t, _ in rows] + ["a\x0bb\x1cc\x85d", "Ünï code", "x" * 3000]
    for table, pattern in PATTERNS.items():
        for size in (1, 50, 1 << 20):
            got = []
            for _, _, raw, off in text_slices(pa.array(texts), size):
                w = tokenise(raw, off, table)
                words = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
                got += [words[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
            assert got == [re.findall(pattern, (t or "").translate(str.maketrans(UPPER, LOWER))) for t in texts]


def test_hashes_depend_on_the_words_alone():
    def hashes(texts):
        raw, off = next((raw, off) for _, _, raw, off in text_slices(pa.array(texts)))
        return word_hashes(tokenise(raw, off, SPACE_TABLE))

    a, b = hashes(["x yy zzz"]), hashes(["padding YY", "x", "zzz yy"])
    assert a[1] == b[1] == b[4] and a[0] == b[2] and a[2] == b[3]
    assert len(np.unique(hashes([" ".join(str(i) for i in range(20000))]))) == 20000
    assert shingle_hashes(a, 3)[0] != shingle_hashes(a[::-1].copy(), 3)[0] and len(shingle_hashes(a, 4)) == 0


def test_fresh_name_and_packing(spark, docs, rows):
    assert fresh_name(docs.selectExpr("doc_id AS Runs", "text AS runs_"), "runs") == "runs__"
    packed = pack_texts(docs.select("text", "doc_id")).collect()
    assert sorted(next(unpack(pa.array([r.text]))).decode() for r in packed) == sorted(t or "" for _, t, _ in rows)


def test_batches_of_long_texts_are_bounded(spark, tmp_path):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(conf, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    def longest(df):
        got = df.coalesce(1).mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 3000 and sum(r.size for r in got) >= 30_000_000
        return max(r.size for r in got)

    texts = spark.range(3000).select("id", F.repeat(F.lit("some text "), 1000).alias("text"))
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    try:
        spark.conf.unset(conf)
        assert longest(read_table(spark, str(tmp_path), "documents")) < 1.5 * BATCH_BYTES
        spark.conf.unset(conf)
        assert longest(written(texts, "bounded")) < 1.5 * BATCH_BYTES
        spark.conf.set(conf, str(1 << 20))  # a bound of the session's own stays
        assert longest(read_table(spark, str(tmp_path), "documents")) < 1.5 * (1 << 20)
    finally:
        spark.conf.unset(conf) if before is None else spark.conf.set(conf, before)
