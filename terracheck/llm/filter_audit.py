"""Filter interaction audit: what each of five filters removes, in every order of application.

A document fails some of the filters, and survives a subset of filters when it fails none of them.
Its truth table over all 32 subsets is one 32-bit word: bit ``S`` is set when the document survives
subset ``S``. Tasks add the words of a part up by carry-save positional popcounts: full adders on
whole words take three words to a sum and a carry of double weight, so 32 counters advance in a few
bit operations. The sums say how many documents of a part (all, those labelled good, those labelled
toxic) survive each subset, and every figure of the audit is a difference of two of these.

Filters, in the letters of the result: A too few words, B too few distinct words, C too many
capitals, D special characters, E text seen under a smaller id. For E, ids and 128-bit digests of
the texts are grouped by digest; texts themselves are read once and never shuffled.

Edge cases: a null text is the empty text and fails A only (and E as a copy); a null part is the
empty string; a row without id is never a copy and has no label, and no row is a copy of it;
repeated rows of one id are no copies of each other; several labels of one id count as one that has
whatever any of them has; long texts are read in pieces; an empty table has no parts and no rows.
Extra columns are ignored."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.llm.common import read_table, text_slices, written
from terracheck.llm.lookup import look_up
from terracheck.llm.registry import register

LETTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
SPECIALS = b"#$%&*|"
#: Bytes of one text whose words are held as objects at once.
PIECE_BYTES = 1 << 20
#: Parts that a task holds counters of.
HELD_PARTS = 4096

_COPY = 1 << LETTERS.index("E")
_SUBSETS = 1 << len(LETTERS)
_CONTINUATION = bytes(range(0x80, 0xC0))
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Survival word of each set of failed filters.
WORDS = np.array([sum(1 << s for s in range(_SUBSETS) if not s & failed) for failed in range(_SUBSETS)], dtype=np.uint32)


def _pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` cut at white space into runs of about ``PIECE_BYTES``."""
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + PIECE_BYTES)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def text_failures(raw: bytes) -> int:
    """Which of A to D the UTF-8 text fails, as bits."""
    n, distinct = 0, set()
    for piece in _pieces(raw):
        words = piece.split()  # for bytes: at \x20 and \x09-\x0D
        n += len(words)
        distinct.update(words)
    points = len(raw.translate(None, _CONTINUATION))
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return (
        (n < MIN_WORDS)
        | (100 * len(distinct) < MIN_DISTINCT_PERCENT * n) << 1
        | (100 * capitals > MAX_CAPITALS_PERCENT * points) << 2
        | (len(raw.translate(None, SPECIALS)) < len(raw)) << 3
    )


def document_facts(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, failed`` (filters A to D as bits) of each document."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    schema = T.StructType([rows.schema["doc_id"], rows.schema["part"], T.StructField("digest", T.BinaryType()), T.StructField("failed", T.IntegerType())])

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, failed = [], []
            for _, _, raw, off in text_slices(batch.column(2)):
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    text = raw[a:b].tobytes()
                    digests.append(blake2b(text, digest_size=16).digest())
                    failed.append(text_failures(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(failed, pa.int32())], names=schema.names
            )

    return rows.mapInArrow(facts, schema)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, good, toxic`` of each document: all five filters as bits, and its labels."""
    facts = written(document_facts(docs), "audit-facts")
    copies = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    is_copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    rows = look_up(facts, copies.drop("last"), ["digest"]).select(
        "doc_id", "part", F.when(is_copy, F.col("failed").bitwiseOR(_COPY)).otherwise(F.col("failed")).alias("failed")
    )
    marks = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    marked = look_up(written(rows, "audit-rows"), marks.where("good OR toxic"), ["doc_id"])
    return marked.select("part", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, by carry-save adders."""
    counts, weight = np.zeros(32, dtype=np.int64), 1
    while len(words):
        carries = []
        while len(words) >= 3:
            third = len(words) // 3
            a, b, c = words[:third], words[third : 2 * third], words[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * third :]))
        for word in words.tolist():
            counts += weight * ((word >> np.arange(32)) & 1)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def survivors(rows: DataFrame) -> DataFrame:
    """``part, counts``: a map from slots to documents. Slot ``S`` has the survivors of subset
    ``S``; 32 and 64 slots on are those labelled good, and those labelled toxic. Missing is 0."""

    def popcounts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            slots = [np.flatnonzero(v) for v in held.values()]
            parts = pa.array([p for p, s in zip(held, slots) for _ in s], pa.string())
            counts = [v[s] for v, s in zip(held.values(), slots)]
            columns = [parts] + [pa.array(np.concatenate(x) if x else np.zeros(0), t) for x, t in ((slots, pa.int32()), (counts, pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names=["part", "slot", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            named = batch.column(0).dictionary_encode()
            codes = named.indices.to_numpy(zero_copy_only=False)
            words = WORDS[batch.column(1).to_numpy(zero_copy_only=False)]
            marks = [batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (2, 3)]
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(len(named.dictionary)), side="right")
            for part, rows in zip(named.dictionary.to_pylist(), np.split(order, ends[:-1])):
                counts = held.setdefault(part, np.zeros(3 * _SUBSETS, dtype=np.int64))
                counts += np.concatenate([positional_popcount(words[rows]), *(positional_popcount(words[rows[m[rows]]]) for m in marks)])
            if len(held) > HELD_PARTS:
                yield out()
                held.clear()
        yield out()

    sums = rows.mapInArrow(popcounts, "part string, slot int, n long").groupBy("part", "slot").agg(F.sum("n").alias("n"))
    return sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("counts"))  # 96 slots at most


def _orders() -> tuple[list[str], np.ndarray, np.ndarray]:
    """Each order's letters, and for each order and step the filter's bit and the subset before it."""
    orders = list(permutations(range(len(LETTERS))))
    bit = 1 << np.array(orders)
    return ["".join(LETTERS[i] for i in order) for order in orders], bit, np.cumsum(bit, axis=1) - bit


def order_table(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters, and step."""
    schema = "part string, filter_order string, step int, " + ", ".join(
        f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, bit, before = _orders()
        after, everything = before | bit, _SUBSETS - 1
        for batch in batches:
            for part, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                slots = np.zeros(3 * _SUBSETS, dtype=np.int64)
                for slot, n in dict(entries).items():
                    slots[slot] = n
                every, good, toxic = slots.reshape(3, _SUBSETS)
                removed = every[before] - every[after]
                total = np.zeros(_SUBSETS, dtype=np.int64)
                np.add.at(total, bit, removed)
                columns = [
                    every[after], removed, every[0] - every[bit] - removed, every[everything ^ bit] - every[everything],
                    good[before] - good[after], toxic[before] - toxic[after], total[bit],
                ]
                steps = np.tile(np.arange(1, len(LETTERS) + 1, dtype=np.int32), len(names))
                heads = [pa.array([part] * bit.size, pa.string()), pa.array([n for n in names for _ in LETTERS], pa.string()), pa.array(steps)]
                fields = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
                yield pa.RecordBatch.from_arrays(heads + [pa.array(c.ravel()) for c in columns], names=fields)

    return counts.mapInArrow(tables, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The whole audit of ``docs (doc_id, text, lang)`` with ``labels (doc_id, quality, toxic)``."""
    return order_table(survivors(failures(docs, labels)))


SQL = rf"""
WITH facts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), flags AS (
  SELECT part, doc_id, len(words) < {MIN_WORDS} AS a, 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) AS b,
    100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > {MAX_CAPITALS_PERCENT} * length(body) AS c, regexp_matches(body, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e FROM facts
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), kinds AS (
  SELECT part, a, b, c, d, e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY ALL
), failing AS (
  SELECT row_number() OVER () AS kind, part, n, good, toxic, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END ||
    CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed FROM kinds
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.x <> q.x AND p.x <> r.x AND p.x <> s.x AND p.x <> t.x AND q.x <> r.x AND q.x <> s.x AND q.x <> t.x AND r.x <> s.x AND r.x <> t.x AND s.x <> t.x
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS filter, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), outcome AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter, n, good, toxic, failed,
    contains(failed, filter) AS fails, len(translate(failed, before, '')) < len(failed) AS gone FROM failing, steps
), audited AS (
  SELECT part, filter_order, step, filter,
    CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN failed = filter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN NOT gone AND fails THEN n * good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN NOT gone AND fails THEN n * toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM outcome GROUP BY part, filter_order, step, filter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM audited
"""


@register("op11_filter_audit", SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters' audit of all documents."""
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
