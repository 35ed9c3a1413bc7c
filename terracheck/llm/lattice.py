"""Language-model scoring by subword lattices.

A text is its words and one end. The pieces of an existing subword vocabulary span a lattice over
each word (with a word-start mark); the word's probability is the sum over all its segmentations of
the product of piece probabilities, by a forward recursion in log space. No piece crosses a word, so
the text's marginal probability is the product of its words' and the end's.

The vocabulary's scores are merge ranks; their Zipf weights start the piece probabilities, and two
rounds of expectation maximisation over all distinct words of the training documents re-estimate
them (the vocabulary itself is never trained). Characters outside the vocabulary are spelt in bytes.
Pieces, bytes and end share one distribution that sums to 1.

Each word that the training documents hold adds one more arc, over the whole word: its count less a
discount, out of all training tokens. What the discounts leave is the weight of the subword paths,
so known and unknown words share one distribution, and the discount comes from the numbers of words
seen once and twice.

Plan: one scan counts the words of each slice of text, and Spark sums them into a table of all
distinct words, which is written. Words are scored once each, whatever their count. A second scan
scores documents: words that make up ``1 / HEAD`` of all words or more (so at most ``HEAD``) are
broadcast as arrays, the few other words of a document are joined by their hash. Texts are never shuffled.

Edge cases: a null or empty text is one end; without training documents every count is 0, there are no
word arcs, and piece probabilities are those of the vocabulary; a word of any length is scored whole; repeated rows are
scored alike and each count as training text; a null id counts as the empty string; an empty table
gives no rows. Only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracheck.llm.common import SPACE_TABLE, Words, fresh_name, mix, read_table, text_slices, tokenise, word_hashes, written
from terracheck.llm.registry import register

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
#: Bound on the broadcast words: those that make up one in so many of all words, or more.
HEAD = 1 << 20
ROUNDS = 2
#: Added to every piece's expected count.
SMOOTH = 0.05
_MARK = "▁"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


class Pieces:
    """Piece texts by hash, with log probabilities; the last two entries are a byte and the end."""

    def __init__(self, texts: list[str], logp: np.ndarray):
        self.texts, self.logp = texts, logp
        self.longest = max(map(len, texts))
        hashes = np.array([self._hash(t) for t in texts], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << _BITS, dtype=bool)
        self.maybe[mix(self.hashes) >> np.uint64(64 - _BITS)] = True

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(_STEP) + ord(c) + 1) & (2**64 - 1)
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of the piece with each hash, or -1."""
        out = np.full(h.shape, -1, dtype=np.int32)
        at = np.flatnonzero(self.maybe[mix(h) >> np.uint64(64 - _BITS)])
        place = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        hit = self.hashes[place] == h[at]
        out[at[hit]] = self.order[place[hit]]
        return out

    def with_counts(self, counts: np.ndarray) -> Pieces:
        new = object.__new__(Pieces)
        new.__dict__.update(self.__dict__)
        new.logp = np.log(counts + SMOOTH) - np.log((counts + SMOOTH)[:-2].sum() + 256 * (counts[-2] / 256 + SMOOTH) + counts[-1] + SMOOTH)
        new.logp[-2] = np.log((counts[-2] / 256 + SMOOTH) / np.exp(np.log(counts[-1] + SMOOTH) - new.logp[-1]))
        return new


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The pieces that lower-cased words can use, weighted by 1 / (rank + 10)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, weights = [], []
    for i in range(model.vocab_size()):
        t, score = model.id_to_piece(i), model.get_score(i)
        special = model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        if t and not special and t.strip(_MARK) + _MARK * (t == _MARK) and _MARK not in t[1:] and not any("A" <= c <= "Z" or c.isspace() for c in t):
            texts.append(t)
            weights.append(1 / (10 - score) if -1e8 < score <= 0 else 1e-6)
    counts = np.array([*weights, weights[-1], weights[0]]) * 1e6
    return Pieces(texts, np.zeros(len(counts))).with_counts(counts)


def _batches(words: list[str], limit: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indices, code points with the mark) of words of one length, at most ``limit`` characters."""
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(length, kind="stable")
    edges = np.flatnonzero(np.diff(length[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)]):
        n = int(length[order[a]])
        step = max(1, limit // (n + 1))
        for i in range(a, b, step):
            at = order[i : min(i + step, b)]
            chars = np.frombuffer("".join(_MARK + words[k] for k in at).encode("utf-32-le"), dtype=np.uint32).reshape(len(at), n + 1)
            yield at, chars


class Lattice:
    """The lattices of words of one length: ``arcs[(i, j)]`` holds piece indices and log weights."""

    def __init__(self, pieces: Pieces, chars: np.ndarray):
        n = chars.shape[1]
        self.n, self.rows, self.arcs, self.bytes = n, len(chars), {}, {}
        plus = chars.astype(np.uint64) + np.uint64(1)
        for i in range(n):
            h = np.zeros(self.rows, dtype=np.uint64)
            for j in range(i + 1, min(n, i + pieces.longest) + 1):
                h = h * _STEP + plus[:, j - 1]
                found = pieces.find(h)
                weight = np.where(found >= 0, pieces.logp[found], -np.inf)
                if j == i + 1:
                    spelt = found < 0
                    size = 1 + (chars[:, i] >= 0x80) + (chars[:, i] >= 0x800) + (chars[:, i] >= 0x10000)
                    weight = np.where(spelt, size * pieces.logp[-2], weight)
                    self.bytes[i] = np.where(spelt, size, 0)
                elif not (found >= 0).any():
                    continue
                self.arcs[i, j] = found, weight
        self.forward = np.full((n + 1, self.rows), -np.inf)
        self.forward[0] = 0
        for j in range(1, n + 1):
            for i in range(max(0, j - pieces.longest), j):
                if (i, j) in self.arcs:
                    self.forward[j] = np.logaddexp(self.forward[j], self.forward[i] + self.arcs[i, j][1])

    def add_counts(self, times: np.ndarray, counts: np.ndarray, longest: int) -> None:
        """Add the expected number of uses of each piece, ``times`` as often."""
        back = np.full((self.n + 1, self.rows), -np.inf)
        back[self.n] = 0
        for i in range(self.n - 1, -1, -1):
            for j in range(i + 1, min(self.n, i + longest) + 1):
                if (i, j) in self.arcs:
                    found, weight = self.arcs[i, j]
                    through = np.exp(self.forward[i] + weight + back[j] - self.forward[self.n]) * times
                    known = found >= 0
                    counts += np.bincount(found[known], weights=through[known], minlength=len(counts))
                    if j == i + 1:
                        counts[-2] += (through * self.bytes[i]).sum()
                    back[i] = np.logaddexp(back[i], weight + back[j])


class Discount:
    """Weights of the whole-word arcs and of the subword paths."""

    def __init__(self, n: int, v: int, once: int, twice: int):
        self.n, self.off = n, once / (once + 2 * twice) if once else 0.5
        self.rest = float(np.log(self.off * v / n)) if n else 0.0

    def arc(self, count: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(np.maximum(count - self.off, 0) / max(self.n, 1))


def word_logs(pieces: Pieces, words: list[str], counts: np.ndarray, discount: Discount) -> np.ndarray:
    """Natural log of each word's marginal probability over all paths of its lattice."""
    out = np.zeros(len(words))
    for at, chars in _batches(words):
        out[at] = np.logaddexp(discount.rest + Lattice(pieces, chars).forward[-1], discount.arc(counts[at]))
    return out


def expected_counts(pieces: Pieces, words: list[str], times: np.ndarray) -> np.ndarray:
    counts = np.zeros(len(pieces.logp))
    for at, chars in _batches(words):
        Lattice(pieces, chars).add_counts(times[at], counts, pieces.longest)
    return counts


def fold(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % FOLDS


def count_words(docs: DataFrame) -> DataFrame:
    """``(hash, word, train_count, total)`` of every distinct word; ``train`` is a column of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, raw, off in text_slices(batch.column(0)):
                w = tokenise(raw, off, SPACE_TABLE)
                if not len(w.starts):
                    continue
                h = word_hashes(w)
                order = np.argsort(h)
                edges = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
                seen = np.repeat(train[i:j].astype(np.int64), np.diff(w.first))[order]
                at, data = order[edges], w.data.tobytes()
                words = [data[a:b] for a, b in zip(w.starts[at].tolist(), w.ends[at].tolist())]
                total = np.diff(np.append(edges, len(h)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[at].view(np.int64)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(np.add.reduceat(seen, edges)), pa.array(total)],
                    names=["hash", "word", "train_count", "total"],
                )

    each = docs.select("text", "train").mapInArrow(count, "hash long, word string, train_count long, total long")
    return each.groupBy("hash", "word").agg(F.sum("train_count").alias("train_count"), F.sum("total").alias("total"))


def fit(words: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Re-estimate the piece probabilities from the words that training documents hold, once each:
    the subword paths are there for words whose counts say little."""
    spark = words.sparkSession
    for _ in range(rounds):
        current = spark.sparkContext.broadcast(pieces)

        def expect(batches, current=current):
            p = current.value
            counts = np.zeros(len(p.logp))
            for batch in batches:
                counts += expected_counts(p, batch.column(0).to_pylist(), np.ones(batch.num_rows))
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["piece", "uses"])

        uses = words.where("train_count > 0").select("word").mapInArrow(expect, "piece long, uses double")
        counts = np.zeros(len(pieces.logp))
        # one row for each piece of the vocabulary at most
        for r in uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            counts[r.piece] = r.uses
        counts[-1] = 1.0
        pieces = pieces.with_counts(counts)
    return pieces


def score_documents(docs: DataFrame, words: DataFrame, n: int, v: int, train_docs: int, pieces: Pieces, discount: Discount) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, base_score, score`` of every row."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(pieces)

    def lattice(batches):
        for batch in batches:
            logs = word_logs(model.value, batch.column(1).to_pylist(), batch.column(2).to_numpy(), discount) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(logs)], names=["hash", "train_count", "total", "log"])

    scored = written(words.select("hash", "word", "train_count", "total").mapInArrow(lattice, "hash long, train_count long, total long, log double"), "word-scores")
    every = scored.agg(F.sum("total")).first()[0] or 0
    head = scored.where(F.col("total") * HEAD >= every).toPandas().sort_values("hash")  # so HEAD rows at most
    below = float(n + v + 1)
    hashes = head["hash"].to_numpy()
    table = spark.sparkContext.broadcast((hashes, head["train_count"].to_numpy() > 0, np.log10((head["train_count"].to_numpy() + 1) / below), head["log"].to_numpy()))
    end = (int(train_docs > 0), float(np.log10((train_docs + 1) / below)), float(np.logaddexp(discount.rest + pieces.logp[-1], discount.arc(np.array(train_docs))) / np.log(10)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, known, base, score = table.value
        for batch in batches:
            for i, j, raw, off in text_slices(batch.column(2)):
                w: Words = tokenise(raw, off, SPACE_TABLE)
                h, count = word_hashes(w).view(np.int64), np.diff(w.first)
                rows = np.repeat(np.arange(j - i), count)
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                sums = [np.bincount(rows[hit], weights=x[at[hit]], minlength=j - i) + e for x, e in zip((known, base, score), end)]
                tail = np.rec.fromarrays([rows[~hit], h[~hit]], names="row,hash")
                tail, times = np.unique(tail, return_counts=True)
                edges = np.searchsorted(tail["row"], np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(count + 1), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.ascontiguousarray(tail["hash"]))),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(times)),
                    ],
                    names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score", "hashes", "times"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, train boolean, n_tokens long, n_known long, base_score double, score double, hashes array<long>, times array<long>"
    parts = docs.select("doc_id", "train", "text").mapInArrow(scan, schema)
    # one row with a document's own sums, whose key matches no word, and one for each other word
    row = F.monotonically_increasing_id()
    own = F.struct((F.xxhash64("row")).alias("hash"), F.lit(0).cast("long").alias("times"), *[F.col(c) for c in ("doc_id", "train", "n_tokens", "n_known", "base_score", "score")])
    other = F.transform(
        F.arrays_zip("hashes", "times"),
        lambda x: F.struct(x["hashes"].alias("hash"), x["times"].alias("times"), *[F.lit(None).cast(t).alias(c) for c, t in (("doc_id", id_type), ("train", "boolean"), ("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double"))]),
    )
    each = parts.withColumn("row", row).select("row", F.explode(F.concat(F.array(own), other)).alias("x")).select("row", "x.*")
    known = scored.select(F.col("hash").alias("word_hash"), "train_count", "log")
    joined = each.join(known, each["hash"] == known["word_hash"], "left")
    log_base = F.log10((F.col("train_count") + 1) / F.lit(below))
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), (~F.max("train")).alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum(F.when(F.col("train_count") > 0, F.col("times")).otherwise(0))).alias("n_known"),
        (F.max("base_score") + F.sum(F.when(F.col("times") > 0, F.col("times") * log_base).otherwise(0.0))).alias("base_score"),
        (F.max("score") + F.sum(F.when(F.col("times") > 0, F.col("times") * F.col("log")).otherwise(0.0))).alias("score"),
    ).drop("row")


def score_corpus(docs: DataFrame, held_out: Column, vocabulary: str = VOCABULARY) -> DataFrame:
    """Learn from the rows that are not held out and score all; see :func:`score_documents`, and
    ``train_tokens``."""
    train = fresh_name(docs, "train")
    docs = docs.select("doc_id", "text", (~held_out).alias(train)).withColumnRenamed(train, "train")
    words = written(count_words(docs), "words")
    held = [F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in (("v", F.col("train_count") > 0), ("once", F.col("train_count") == 1), ("twice", F.col("train_count") == 2))]
    sums = words.agg(F.sum("train_count").alias("n"), *held).first()
    train_docs = docs.where("train").count()
    n, v = (sums.n or 0) + train_docs, (sums.v or 0) + (train_docs > 0)
    pieces = fit(words, load_pieces(vocabulary)) if train_docs else load_pieces(vocabulary)
    discount = Discount(n, v, sums.once or 0, sums.twice or 0)
    return score_documents(docs, words, n, v, train_docs, pieces, discount).withColumn("train_tokens", F.lit(n).cast("long"))


@register("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lattice score of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_corpus(docs, fold(F.col("doc_id")) == HELD_OUT)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
