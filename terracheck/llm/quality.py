"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Learning: ``SAMPLE`` labelled rows at most, those with the smallest hash of their id, and none held
out. Their ids are a bounded table, so it is broadcast to a scan that computes their statistics.
The driver bins the statistics and grows the trees by logistic loss. Scoring: every tree is a
complete binary tree flattened into arrays of features, cuts and values; a second scan computes the
statistics of all texts and walks all trees with array operations. Texts are never shuffled, and
labels, language, source and id never reach a score.

Edge cases: null and empty texts have all counts 0 and get a score like any other; labels that are
null or whose document is missing teach nothing; with no labelled rows, or of one class only, every
score is the smoothed share of that class; repeated rows are scored alike; a null id counts as the
empty string. All columns of the documents pass through, and added names avoid theirs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terracheck.llm.common import SPACE_TABLE, fresh_name, read_table, shingle_hashes, text_slices, tokenise, word_hashes
from terracheck.llm.registry import register

#: Bound on the labelled rows that the trees learn from.
SAMPLE = 20_000
#: Bytes of text whose statistics are taken at once: they take some 50 bytes of memory for each.
STATISTICS_BYTES = 1 << 19
FOLDS = 5
CUT = 0.3
TREES, DEPTH, BINS, RATE, LEAST, L2 = 80, 4, 64, 0.15, 8, 1.0

_GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t",
    "line": b"\n\r", "stop": b".", "comma": b",;:", "shout": b"!?", "bar": b"|", "symbol": b"#$%&*+=<>@^~_\\/{}[]", "quote": b"\"'`()-",
}
_CLASS = np.full(256, len(_GROUPS), dtype=np.uint8)  # the rest: bytes of non-ASCII characters, controls
for _k, _chars in enumerate(_GROUPS.values()):
    _CLASS[list(_chars)] = _k
_LINES = bytes(32 if b == 10 else 33 if b == 32 else b for b in range(256))
FEATURES = [f"share_{g}" for g in (*_GROUPS, "other")] + [
    "log_bytes", "log_words", "word_mean", "word_spread", "share_short", "share_long", "distinct_words", "distinct_pairs", "distinct_fives", "share_symbol_end",
    "share_shout_start", "line_mean", "distinct_lines", "words_per_stop",
]


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each row."""
    key = np.unique((rows.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    return np.bincount((key >> np.uint64(40)).astype(np.int64), minlength=n)


def statistics(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The features of each row of a slice."""
    n = len(off) - 1
    size = np.diff(off)
    one = np.maximum(size, 1)
    per_class = np.zeros((n, len(_GROUPS) + 1))
    kinds = _CLASS[raw]
    for c in range(per_class.shape[1]):
        per_class[:, c] = np.diff(np.concatenate(([0], np.cumsum(kinds == c)))[off])
    w = tokenise(raw, off, SPACE_TABLE)
    count = np.diff(w.first)
    words = np.maximum(count, 1)
    rows = np.repeat(np.arange(n), count)
    length = w.ends - w.starts

    def mean(x):
        return np.bincount(rows, weights=x, minlength=n) / words

    lines = tokenise(raw, off, _LINES)
    n_lines = np.diff(lines.first)
    h = word_hashes(w)
    distinct = [_distinct(rows, h, n) / words]
    for k in (2, 5):
        s = shingle_hashes(h, k)
        inside = rows[: len(s)] == rows[k - 1 :][: len(s)] if len(s) else np.zeros(0, bool)
        distinct.append((_distinct(rows[: len(s)][inside], s[inside], n) + 1) / (np.maximum(count - k + 1, 0) + 1))
    average = mean(length)
    first, last = kinds[w.starts], kinds[w.ends - 1]
    names = list(_GROUPS)
    more = [
        np.log1p(size), np.log1p(count), average, np.sqrt(np.maximum(mean(length * length) - average**2, 0)), mean(length <= 3), mean(length >= 12), *distinct,
        mean(last == names.index("symbol")), mean((first == names.index("upper")) | (last == names.index("shout"))),
        np.log1p(size / np.maximum(n_lines, 1)), (_distinct(np.repeat(np.arange(n), n_lines), word_hashes(lines), n) + 1) / (n_lines + 1),
        np.log1p(count / (per_class[:, names.index("stop")] + 1)),
    ]
    return np.column_stack([per_class / one[:, None], *more])


def text_statistics(column: pa.Array) -> np.ndarray:
    parts = [statistics(raw, off) for _, _, raw, off in text_slices(column, STATISTICS_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


class Trees:
    """Complete binary trees in arrays: node ``i`` has children ``2 i + 1`` and ``2 i + 2``."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.cut, self.value = base, feature, cut, value

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost trees on binned features; the best cut of a node comes from its histogram."""
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    base, inner = float(np.log(share / (1 - share))), 2**depth - 1
    feature, cut, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    if not 0 < y.sum() < len(y):
        return Trees(base, feature, cut, value)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    total = np.full(len(y), base)
    n_features = x.shape[1]
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)  # within its level
        for level in range(depth):
            width = 2**level
            hist = np.zeros((3, width, n_features, BINS))
            for f in range(n_features):
                key = node * BINS + bins[:, f]
                for k, weight in enumerate((grad, hess, None)):
                    hist[k, :, f] = np.bincount(key, weights=weight, minlength=width * BINS).reshape(width, BINS)
            left = np.cumsum(hist, axis=3)
            whole = left[..., -1:]
            right = whole - left
            gain = left[0] ** 2 / (left[1] + L2) + right[0] ** 2 / (right[1] + L2) - whole[0] ** 2 / (whole[1] + L2)
            gain[(left[2] < LEAST) | (right[2] < LEAST)] = -1
            flat = gain.reshape(width, -1)
            best = flat.argmax(axis=1)
            f, b = best // BINS, best % BINS
            useful = flat[np.arange(width), best] > 1e-9
            at = 2**level - 1 + np.arange(width)
            feature[t, at] = np.where(useful, f, 0)
            cut[t, at] = [edges[i][j] if ok and j < len(edges[i]) else np.inf for i, j, ok in zip(f, b, useful)]
            goes = useful[node] & (bins[np.arange(len(y)), f[node]] > b[node])
            node = 2 * node + goes
        g, h = np.bincount(node, weights=grad, minlength=inner + 1), np.bincount(node, weights=hess, minlength=inner + 1)
        value[t] = RATE * g / (h + L2)
        total += value[t][node]
    return Trees(base, feature, cut, value)


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Learn from ``sample`` labelled rows at most, none of them held out."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    chosen = known.select(F.col("doc_id").alias("_doc"), F.col(label).cast("double").alias("_y")).orderBy(F.xxhash64("_doc"), "_doc", "_y").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_doc")).select("doc_id", "_y", "text")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("y", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def features(batches):
        for batch in batches:
            x = text_statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    # one row of each label: an id may stand on any number of documents
    one = rows.mapInArrow(features, schema).groupBy("doc_id", "y").agg(F.min("x").alias("x"))
    got = sorted((r.doc_id, r.y, tuple(r.x)) for r in one.collect())  # at most ``sample`` rows
    x = np.array([r[2] for r in got]).reshape(len(got), len(FEATURES))
    return grow(x, np.array([r[1] > 0 for r in got], dtype=float))


def add_score(docs: DataFrame, trees: Trees, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each text in column ``name``."""
    model = docs.sparkSession.sparkContext.broadcast(trees)  # a few tens of KB
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    text_at = [c.lower() for c in docs.columns].index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.value.score(text_statistics(batch.column(text_at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=schema.names)

    return docs.mapInArrow(score, schema)


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents with a score of ``cut`` or more, with the columns of ``docs``."""
    name = fresh_name(docs, "score")
    return add_score(docs, fit(docs, labels), name).where(F.col(name) >= cut).drop(name)


@register("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = add_score(docs, trees)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
