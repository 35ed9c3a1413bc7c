"""Suffix-array deduplication: every byte covered by a string of ``length`` bytes that also starts
elsewhere is removed.

Ranks of prefixes grow by doubling, on a sparse set of positions. An anchor is the position of the
smallest 8-byte hash among the ``width`` positions from a window's start on, so windows with equal
bytes have their anchor at the same place, and few positions are anchors. All windows of one anchor
share its core, the ``length - width`` bytes from it on:

1. Anchors are ranked by the first half of the core; unique ranks are dropped.
2. The rest are ranked by the pair of that rank and the next half (offset doubled), and by the
   whole run of bytes that the anchor's windows cover. Runs that occur twice settle all their
   windows; runs whose core rank holds no other run are unique and dropped.
3. Only one of each remaining run (they stand where a repeat begins or ends) is ranked at every
   window, by the whole ``length`` bytes: the threshold, where doubling stops.

Ranks are hashes: positions off the anchors carry no rank of their own, so the second half of a pair
is the hash of its bytes. Equal texts of ``length`` bytes or more are repeats of each other whole.

Hot ranks (a passage of many documents) are counted with partial sums and joined back, which Spark
splits. The window hashes of step 3 are not: all rows of one hash, one for each run that holds the
window, are a window group in one task.

Edge cases: a null text is empty; texts shorter than ``length`` keep all bytes; strings never cross
documents; repeated rows are documents of their own, so long ones remove each other; a null id is
returned as it is; an empty table gives no rows. Only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terracheck.llm import common
from terracheck.llm.common import mix, pack_texts, read_table, text_slices, unpack, written
from terracheck.llm.registry import register

LENGTH = 400
_GRAM = 8
#: Bits of a packed place: anchor, distance to its first and to its last window.
_BITS = 12
_LOW = (1 << (2 * _BITS)) - 1


def width_of(length: int) -> int:
    return min(length * 12 // 25, (1 << _BITS) - 1)


def window_anchors(raw: np.ndarray, width: int) -> np.ndarray:
    """For each position, where the smallest hash of the ``width`` positions from it on stands."""
    n = len(raw)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * common._powers(common._P, n), out=total[1:])
    h = mix((total[_GRAM:] - total[:-_GRAM]) * common._powers(common._PINV, n + 1)[: n - _GRAM + 1])
    m = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # ties: the first
    size = 1
    while size * 2 <= width:
        m, size = np.minimum(m[:-size], m[size:]), size * 2
    if size < width:
        m = np.minimum(m[: len(m) - (width - size)], m[width - size :])
    return (m & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors_of(raw: np.ndarray, off: np.ndarray, length: int, width: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, anchors, their first and their last window) of each row long enough, in row bytes."""
    out = []
    if len(raw) < length:
        return out
    at = window_anchors(raw, width)
    for r in np.flatnonzero(np.diff(off) >= length).tolist():
        own = at[off[r] : off[r + 1] - length + 1]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        out.append((r, own[first] - off[r], first, np.append(first[1:], len(own)) - 1))
    return out


def _long(h: list[int]) -> pa.Array:
    return pa.array(np.array(h, dtype=np.uint64).view(np.int64))


def anchor_rows(texts: DataFrame, length: int, width: int, full: bool) -> DataFrame:
    """``half`` of every anchor, and if ``full`` ``th, place, rest, run``; ``texts`` has ``th, text``."""
    core = length - width
    cut = core // 2

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h64 = xxhash.xxh3_64_intdigest
        for batch in batches:
            for i, j, raw, off in text_slices(batch.column(1)):
                half, th, place, rest, run = [], [], [], [], []
                for r, at, first, last in anchors_of(raw, off, length, width):
                    data = raw[off[r] : off[r + 1]].tobytes()
                    half += [h64(data[a : a + cut]) for a in at.tolist()]
                    if full:
                        th.append(np.full(len(at), batch.column(0)[i + r].as_py()))
                        place.append((at << (2 * _BITS)) | ((at - first) << _BITS) | (at - last))
                        rest += [h64(data[a + cut : a + core]) for a in at.tolist()]
                        run += [h64(data[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]
                if half and full:
                    yield pa.RecordBatch.from_arrays([_long(half), pa.array(np.concatenate(th)), pa.array(np.concatenate(place)), _long(rest), _long(run)], names=["half", "th", "place", "rest", "run"])
                elif half:
                    yield pa.RecordBatch.from_arrays([_long(half)], names=["half"])

    return texts.select("th", "text").mapInArrow(scan, "half long, th long, place long, rest long, run long" if full else "half long")


def _again(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key another row has too."""
    return rows.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), keys, "left_semi")


def repeated_windows(docs: DataFrame, copies: DataFrame, length: int) -> DataFrame:
    """``th, found``: for each text its runs of window starts (``lo``, ``hi``, both included) whose
    windows also start elsewhere; ``copies`` has ``th`` and one ``doc_id`` of each text."""
    width = width_of(length)
    # a table of its own: a join of two shuffles is one that Spark splits where a rank is hot
    half = written(anchor_rows(docs, length, width, full=False).groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half"), "halves")
    rows = written(anchor_rows(docs, length, width, full=True).join(half, "half"), "anchors")
    rows = rows.withColumn("reach", F.col("place").bitwiseAND(F.lit(_LOW)))
    runs = rows.groupBy("half", "rest", "reach", "run").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("th", "place")).alias("one"))
    runs = written(runs.select("half", "rest", "reach", "run", "n", "one.th", "one.place"), "runs")
    settled = rows.join(runs.where("n > 1").select("half", "rest", "reach", "run"), ["half", "rest", "reach", "run"], "left_semi")

    def anchor(place: Column) -> Column:
        return F.shiftright(place, 2 * _BITS)

    back, near = F.shiftright("place", _BITS).bitwiseAND(F.lit((1 << _BITS) - 1)), F.col("place").bitwiseAND(F.lit((1 << _BITS) - 1))
    whole = settled.select("th", (anchor(F.col("place")) - back).alias("lo"), (anchor(F.col("place")) - near).alias("hi"))
    # a text's distinct runs of starts: at most one for each of its bytes
    whole = written(whole.groupBy("th").agg(F.collect_set(F.struct("lo", "hi")).alias("found")), "settled")

    open_runs = _again(runs, ["half", "rest"])
    asked = open_runs.groupBy("th").agg(F.collect_list(F.struct("place", "n")).alias("asked"))
    asked = asked.join(copies.select("th", F.col("doc_id").alias("_doc")), "th").withColumnRenamed("th", "_th")
    own = (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    texts = pack_texts(docs).join(asked, own).select("th", "text", "asked.place", "asked.n")

    def windows(batches):
        h64 = xxhash.xxh3_64_intdigest
        for batch in batches:
            for r, data in enumerate(unpack(batch.column(1))):
                key, where = [], []
                for place, n in zip(batch.column(2)[r].as_py(), batch.column(3)[r].as_py()):
                    a, far, close = place >> (2 * _BITS), (place >> _BITS) & ((1 << _BITS) - 1), place & ((1 << _BITS) - 1)
                    span = range(a - far, a - close + 1)
                    key += [h64(data[p : p + length]) for p in span]
                    # anchor, distance to the window's start, and whether the run occurs once, in one number
                    where += [(a << (_BITS + 1)) | ((a - p) << 1) | (n == 1) for p in span]
                th = np.full(len(key), batch.column(0)[r].as_py())
                yield pa.RecordBatch.from_arrays([_long(key), pa.array(th), pa.array(where, pa.int64())], names=["key", "th", "where"])

    each = texts.mapInArrow(windows, "key long, th long, where long")
    # a window's group has one row for each open run, and a repeat has as many groups as windows
    w = Window.partitionBy("key")
    at = F.shiftright("where", _BITS + 1)
    twice = (F.min("th").over(w) != F.max("th").over(w)) | (F.min(at).over(w) != F.max(at).over(w))
    start = at - F.shiftright("where", 1).bitwiseAND(F.lit((1 << _BITS) - 1))
    single = each.withColumn("twice", twice).where("twice AND `where` % 2 = 1").select("th", start.alias("start")).groupBy("th").agg(F.collect_set("start").alias("starts"))
    single = written(single.select("th", F.transform("starts", lambda x: F.struct(x.alias("lo"), x.alias("hi"))).alias("found")), "edges")
    return whole.unionByName(single).groupBy("th").agg(F.flatten(F.collect_list("found")).alias("found"))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row; ``spans`` holds the
    start and end byte of each removed run in turn."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    copies = written(docs.groupBy("th").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id")), "copies")
    spans = repeated_windows(docs, copies, length)
    per_text = copies.select("th", "copies").join(spans, "th", "left").where("copies > 1 OR found IS NOT NULL").withColumnRenamed("th", "_th")
    joined = pack_texts(docs).join(per_text, F.col("th") == F.col("_th"), "left").select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "found.lo", "found.hi")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r, data in enumerate(unpack(batch.column(1))):
                n = len(data)
                change = np.zeros(n + 1, dtype=np.int64)
                if batch.column(2)[r].as_py() > 1 and n >= length:
                    change[0], change[n] = 1, -1
                elif batch.column(3)[r].is_valid:
                    lo, hi = (np.array(batch.column(c)[r].as_py(), dtype=np.int64) for c in (3, 4))
                    np.add.at(change, lo, 1)
                    np.add.at(change, hi + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                out.append((n, int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest(), edges.tolist()))
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")


@register("op2_suffix_array_dedup")
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document in strings of 400 bytes that occur again."""
    return repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")
