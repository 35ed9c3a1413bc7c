"""Benchmark decontamination.

Benchmark items are normalised to words; every run of ``n`` consecutive item words is a window, and
an item of fewer words is one window itself. The hashes of all windows are broadcast. A scan over
the documents hashes each document's own windows, looks them up, verifies each hit word by word,
and marks the words inside. Documents are never shuffled.

The benchmark is broadcast in blocks of at most ``BLOCK_WORDS`` words (items are dealt to blocks by
hash of their id). A larger benchmark means more blocks, each scanned against all documents in turn;
what a block finds is merged with what earlier blocks found, so the result is the same for any
number of blocks.

Edge cases: a null or empty text has no words, no hits and is not contaminated; items without words
never occur; items that share an id count once, a null id is listed as an empty string; repeated
rows each get the same result; empty tables give no hits or no rows. All columns of the documents
pass through unchanged, and the names of the added ones avoid them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.llm.common import ALNUM_TABLE, LOWER, UPPER, fresh_name, read_table, shingle_hashes, text_slices, tokenise, word_hashes, written
from terracheck.llm.registry import register

WINDOW = 13
#: Words of benchmark text in one broadcast block (about 40 bytes each in a worker).
BLOCK_WORDS = 500_000
#: A document is contaminated when at least one word in so many is hit.
SHARE = 20
#: Bytes of text scanned at once: their hashes take some 40 bytes of memory for each.
SCAN_BYTES = 1 << 19
_FILTER_BITS = 22


def build_index(items: list[tuple[str, str | None]], n: int = WINDOW) -> dict:
    """Window length -> sorted distinct window hashes, the words of each, and its items."""
    found: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        words = (text or "").encode().translate(ALNUM_TABLE).split()
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            found.setdefault(size, {}).setdefault(tuple(words[i : i + size]), set()).add(item or "")
    index = {}
    for size, windows in found.items():
        texts = [b" ".join(w) for w in windows]
        raw = np.frombuffer(b" ".join(texts), dtype=np.uint8)
        hashes = shingle_hashes(word_hashes(tokenise(raw, np.array([0, len(raw)]), ALNUM_TABLE)), size)[::size]
        order = np.argsort(hashes, kind="stable")
        index[size] = (hashes[order], [texts[i] for i in order], [sorted(v) for v in np.array(list(windows.values()), dtype=object)[order]])
    return index


class Scanner:
    """Finds the windows of one index in slices of texts."""

    def __init__(self, index: dict):
        self.index = index
        self.maybe = {}
        for size, (hashes, _, _) in index.items():
            bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
            bits[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.maybe[size] = bits

    def scan(self, words) -> tuple[list[tuple[int, int]], dict[int, set[str]]]:
        """Hit word ranges over the slice, and the items of each row."""
        runs: list[tuple[int, int]] = []
        items: dict[int, set[str]] = {}
        h = word_hashes(words)
        for size, (hashes, texts, owners) in self.index.items():
            s = shingle_hashes(h, size)
            at = np.flatnonzero(self.maybe[size][s >> np.uint64(64 - _FILTER_BITS)])
            row = np.searchsorted(words.first, at, side="right") - 1
            fits = at + size <= words.first[row + 1]
            at, row = at[fits], row[fits]
            lo, hi = np.searchsorted(hashes, s[at], side="left"), np.searchsorted(hashes, s[at], side="right")
            for i, r, a, b in zip(*(x[lo < hi].tolist() for x in (at, row, lo, hi))):
                text = b" ".join(words.data[x:y].tobytes() for x, y in zip(words.starts[i : i + size].tolist(), words.ends[i : i + size].tolist()))
                for k in range(a, b):
                    if texts[k] == text:  # the hash only proposes
                        runs.append((i, i + size))
                        items.setdefault(r, set()).update(owners[k])
        return runs, items


def _flags(n: int, runs: list[tuple[int, int]]) -> np.ndarray:
    change = np.zeros(n + 1, dtype=np.int64)
    if runs:
        edges = np.array(runs, dtype=np.int64)
        np.add.at(change, edges[:, 0], 1)
        np.add.at(change, edges[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def _runs_of(hit: np.ndarray) -> list[int]:
    """Start and end of each run of hit words, one after the other."""
    edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.flatnonzero(edges).tolist()


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, dict[str, str]]:
    """All columns of ``docs`` and, under fresh names, ``n_words``, ``n_hit``, ``runs`` (start and
    end word of each hit run, in turn) and ``items``; the dict tells the fresh names."""
    spark = docs.sparkSession
    names = {k: fresh_name(docs, k) for k in ("n_words", "n_hit", "runs", "items")}
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    # a word takes two bytes at least with its separator
    total = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    blocks = max(1, int(-(-total // block_words)))
    plain = ", ".join(f"{names[k]} {kind}" for k, kind in (("n_words", "long"), ("n_hit", "long"), ("runs", "array<int>"), ("items", "array<string>")))
    schema = T.StructType(docs.schema.fields + T._parse_datatype_string(plain).fields)
    text_at, width = [c.lower() for c in docs.columns].index("text"), len(docs.columns)
    out = docs
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # bounded by block_words
        index = spark.sparkContext.broadcast(build_index([(r.item, r.text) for r in part], n))

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(index.value)
            for batch in batches:
                before = (batch.column(width + 2).to_pylist(), batch.column(width + 3).to_pylist()) if batch.num_columns > width else None
                n_words, n_hit, all_runs, all_items = [], [], [], []
                for i, j, raw, off in text_slices(batch.column(text_at), SCAN_BYTES):
                    words = tokenise(raw, off, ALNUM_TABLE)
                    runs, owners = scanner.scan(words)
                    if before:
                        runs += [(int(words.first[r]) + x, int(words.first[r]) + y) for r in range(j - i) for x, y in zip(before[0][i + r][::2], before[0][i + r][1::2])]
                    hit = _flags(len(words.starts), runs)
                    count = np.concatenate(([0], np.cumsum(hit)))
                    n_words += np.diff(words.first).tolist()
                    hits = np.diff(count[words.first]).tolist()
                    n_hit += hits
                    for r in range(j - i):
                        all_runs.append(_runs_of(hit[words.first[r] : words.first[r + 1]]) if hits[r] else [])
                        all_items.append(sorted(owners.get(r, set()) | (set(before[1][i + r]) if before else set())))
                new = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(all_runs, pa.list_(pa.int32())), pa.array(all_items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(batch.columns[:width] + new, names=schema.names)

        out = out.mapInArrow(scan, schema)
        if blocks > 1:
            out = written(out, "decontam")
    return out, names


def is_contaminated(n_hit, n_words):
    return (n_hit > 0) & (n_hit * SHARE >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``docs``."""
    found, names = find_hits(docs, benchmark)
    return found.where(~is_contaminated(F.col(names["n_hit"]), F.col(names["n_words"]))).drop(*names.values())


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without their hit runs: from each run's first word to its last one."""
    found, names = find_hits(docs, benchmark)
    text_at, runs_at = [c.lower() for c in docs.columns].index("text"), found.columns.index(names["runs"])
    schema = docs.schema

    def cut(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for r, runs in enumerate(batch.column(runs_at).to_pylist()):
                if runs:
                    raw = texts[r].encode()
                    w = tokenise(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), ALNUM_TABLE)
                    edges = [0, *(int(e) for a, b in zip(runs[::2], runs[1::2]) for e in (w.starts[a], w.ends[b - 1])), len(raw)]
                    texts[r] = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])).decode()
            columns = batch.columns[: len(schema.names)]
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return found.mapInArrow(cut, schema)


_WORDS = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH item_words AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS size, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS i FROM item_words WHERE len(w) > 0)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
hits AS (
  SELECT p.r, p.i, x.size, x.item
  FROM (SELECT p.r, p.i, s.size, array_to_string(p.w[p.i : p.i + s.size - 1], ' ') AS gram
        FROM places p, (SELECT DISTINCT size FROM item_windows) s WHERE p.i + s.size - 1 <= len(p.w)) p
  JOIN item_windows x ON x.size = p.size AND x.gram = p.gram
),
hit_words AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS word FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


@register("op6_benchmark_decontamination", SQL)
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside benchmark windows, and the items they come from."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = find_hits(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )
