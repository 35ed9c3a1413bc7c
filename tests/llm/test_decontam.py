import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terracheck.llm import decontam
from terracheck.llm.common import ALNUM_TABLE, LOWER, UPPER, text_slices, tokenise

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    return re.findall(PATTERN, (text or "").translate(str.maketrans(UPPER, LOWER)))


def brute(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        w = words_of(t)
        n = min(13, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def case(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    items = [(1, passage), (2, "Short, item!"), (3, None), (4, ""), (5, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15 tail"), (None, "null-id item words"), (2, "w0 w1")]
    texts = [passage, passage.upper() + ".", "x " * 400 + passage, " ".join(passage.split()[:12]), "a short item b", "SHORT-ITEM short item", None, "", "!!", "null id item words", "W0 w1 w0 w1",
             passage + " z " + passage, "y " * 300 + "short item", "é" * 5000]
    docs = spark.createDataFrame([(i, t, "n", 5) for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, runs string, n_hit int")
    return docs, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("block", [10, 40, 500_000])
def test_hits_match_brute_force_for_any_number_of_blocks(case, block):
    docs, bench, items = case
    found, names = decontam.find_hits(docs, bench, block_words=block)
    assert found.columns[:4] == docs.columns
    for r in found.collect():
        assert (r[names["n_words"]], r[names["n_hit"]], r[names["items"]]) == brute(r.text, items), r.text
        assert r["runs"] == "n" and sum(b - a for a, b in zip(r[names["runs"]][::2], r[names["runs"]][1::2])) == r[names["n_hit"]]


def test_documents_and_spans_go(case):
    docs, bench, items = case
    clean = decontam.drop_contaminated(docs, bench)
    want = {r.doc_id for r in docs.collect() if not (brute(r.text, items)[1] > 0 and 20 * brute(r.text, items)[1] >= brute(r.text, items)[0])}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == want
    cut = decontam.remove_spans(docs, bench)
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left[0] == "" and left[3] == "".join(f" w{i}" for i in range(2, 12)) and left[4] == "a  b" and left[6] is None
    again, names = decontam.find_hits(cut.where("doc_id <> 5"), bench)
    assert again.agg(F.sum(names["n_hit"])).first()[0] <= 2  # what stands next to a removed span can meet


def test_empty(case, no_docs):
    docs, bench, _ = case
    assert decontam.drop_contaminated(no_docs, bench).count() == 0
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_a_scan_holds_the_hashes_of_one_small_slice():
    texts = pa.array([f"word{i} " * 1000 for i in range(1000)])  # about 8 MB
    scanner = decontam.Scanner(decontam.build_index([("1", " ".join(f"w{i}" for i in range(30)))]))
    tracemalloc.start()
    for _, _, raw, off in text_slices(texts, decontam.SCAN_BYTES):
        assert scanner.scan(tokenise(raw, off, ALNUM_TABLE)) == ([], {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
