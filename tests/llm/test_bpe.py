"""The BPE codec against the tokenizers library."""

import hashlib
import json
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from terracheck.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary.read(PATH))


def ids_of(codec, texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    ids, spans = codec.encode(np.frombuffer(b"".join(raw), dtype=np.uint8), off)
    return [ids[a:b].tolist() for a, b in zip(spans[:-1], spans[1:])]


def make_texts(seed, n):
    r = random.Random(seed)
    signs = list("aabbccst'''  \n\t\r ,.!?12éü北京日 　\x1c\x85​😀²½ⅷ_") + "'s 't 're 've 'm 'll 'd 'S".split()
    signs += ["<|endoftext|>", "<|endof", "text|>", "the", "ing", "  ", "\r\n", "aaaa", "é", " 'll", "Ᲊ", "\U00010d40", "՘"]
    return ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(n)] + ["", "a" * 99, " " * 50, "\n" * 9 + "x", "'", "'r", "'l"]


@pytest.mark.parametrize("seed", range(8))
def test_ids_and_texts_equal_the_library(codec, library, seed):
    texts = make_texts(seed, 400)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = ids_of(codec, texts)
    for text, g, w in zip(texts, got, want):
        assert g == w, text
        assert codec.decode(np.array(g, dtype=np.int64)).decode("utf-8", "replace") == library.decode(w, skip_special_tokens=False) == text


def digest_rows(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_digests_of_a_table(spark, docs, rows, library):
    odd = docs.selectExpr("doc_id", "1 AS n_tokens", "text", "2 AS ids", "3 AS decoded")
    out = bpe.digests(odd, PATH)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded", "n_tokens_", "ids_sha256", "decoded_sha256"]
    got = sorted(((r.doc_id, r.n_tokens_, r.ids_sha256, r.decoded_sha256) for r in out.collect()), key=str)
    assert got == digest_rows(library, [(r[0], r[1]) for r in rows])


def test_long_texts_are_cut_where_pieces_end(spark, library, monkeypatch):
    texts = make_texts(99, 60)
    rows = list(enumerate(texts + ["".join(texts), None]))
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for size in (1, 40, 500):
        monkeypatch.setattr(bpe, "ENCODE_BYTES", size)
        found = []
        for _, text in rows:
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            codec = bpe.Codec(bpe.Vocabulary.read(PATH)) if not found else codec  # noqa: F821
            found.append([i for part, off, _ in bpe.text_chunks(raw, np.array([0, len(raw)])) for i in codec.encode(part, off)[0].tolist()])
        assert found == [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    monkeypatch.undo()
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(table, PATH).collect()]
    assert sorted(got, key=str) == digest_rows(library, rows)


def test_encode_then_decode(spark, docs, rows):
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert back.columns == ["doc_id", "text", "source", "ids", "decoded"]
    assert sorted(str(r.decoded) for r in back.collect()) == sorted(str(t or "") for _, t, _ in rows)
    strange = spark.createDataFrame([([15496, None, -4, 999999, 995],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(strange, PATH).collect()] == ["Hello world", "", ""]


def test_empty(no_docs):
    assert bpe.digests(no_docs, PATH).count() == 0 and bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0


def test_other_vocabularies(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    few = spec | {"added_tokens": [], "model": spec["model"] | {"merges": [["h", "e"], ["l", "l"], ["he", "ll"]]}}
    path = tmp_path / "few.json"
    path.write_text(json.dumps(few))
    texts = ["hello hell", "llll lll", "<|endoftext|>"]
    assert ids_of(bpe.Codec(bpe.Vocabulary.read(str(path))), texts) == [e.ids for e in Tokenizer.from_file(str(path)).encode_batch(texts)]
    for change in ({"normalizer": {"type": "NFC"}}, {"model": few["model"] | {"merges": [["he", "ll"], ["h", "e"], ["l", "l"]]}}):
        path.write_text(json.dumps(few | change))
        with pytest.raises(ValueError):
            bpe.Vocabulary.read(str(path))
