"""Secret scans: three pattern kinds, and character Markov models for what patterns miss.

Two first-order character models are trained from labelled samples: random strings (digests in
hex, base 64 and upper-case alphabets, and the keys that the patterns find in the documents) and
ordinary ones (the other long tokens of the documents, and identifiers made of their words). All
documents with an id count: their tokens and words are counted first, then the character pairs of
each different one. A long token is a secret when its log-likelihood ratio of the
two models, summed over its character pairs, is above ``LLR`` nats, which outweighs a prior of one
secret in a million tokens. The models are one array of 66 * 66 log ratios inside the
expression; all scanning is DataFrame expressions, row by row, without a shuffle of texts.

Spans are code points, end exclusive. Model spans never overlap pattern spans.

Edge cases: null and empty texts have no spans; results depend on the text and the models alone, so
repeated rows agree; null ids are scanned like others but never learnt from; without documents
the ordinary model is uniform; empty tables give no rows. ``redact`` keeps all columns."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracheck.llm.common import fresh_name, read_table
from terracheck.llm.registry import register

#: Kind, pattern, group whose length counts, least length. All matches are taken
#: first, and too short ones dropped after. A run of hex digits or of an access key's characters
#: is one match whole, so there the least length can stand in the pattern.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Tokens that the models judge.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RANDOM = 3_000
LLR = 14.0
#: Weight, in characters, of how often a character follows any other one.
BACKOFF = 4.0


def matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Array of (start, kind, end) of the matches whose group is long enough, in order."""
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    rows = F.arrays_zip(found.alias("m"), F.slice(pieces, 1, F.size(found)).alias("p"), judged.alias("g"))

    def step(acc, x):
        start = acc["at"] + F.length(x["p"])
        end = start + F.length(x["m"])
        keep = F.when(F.length(x["g"]) >= least, F.concat(F.lit(" "), start, F.lit(":"), end)).otherwise("")
        return F.struct(end.cast("int").alias("at"), F.concat(acc["out"], keep).alias("out"))

    # places are added up as text, which costs no copy of an array for each match
    places = F.aggregate(rows, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: acc["out"])
    spans = F.transform(
        F.filter(F.split(places, " "), lambda s: s != ""),
        lambda s: F.struct(F.split_part(s, F.lit(":"), F.lit(1)).cast("int").alias("start"), F.lit(kind).alias("kind"), F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("end")),
    )
    return F.coalesce(F.when(text.rlike(pattern), spans), _no_spans())


def _no_spans() -> Column:
    return F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")


def base_spans(text: Column) -> Column:
    """All pattern spans, by start, then kind."""
    return F.array_sort(F.concat(*[matches(text, pattern, group, least, k) for k, (_, pattern, group, least) in enumerate(KINDS)]))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS], F.lit("markov"))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


def labelled_items(docs: DataFrame) -> DataFrame:
    """(kind, item, n): how often all documents hold each long token (t), each key (k) and each word
    with the last character of the word before it in front, or a space (w)."""
    long_token = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{6,}"
    # a column of its own: the words are looked for once
    found = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.regexp_extract_all("text", F.lit(long_token), F.lit(0)).alias("t"), F.regexp_extract_all("text", F.lit("[A-Za-z]{3,}"), F.lit(0)).alias("w"),
        *[F.regexp_extract_all("text", F.lit(p), F.lit(g)).alias(f"k{g}{i}") for i, (_, p, g, _) in enumerate(KINDS[1:])],
    )
    before = F.concat(F.array(F.lit(" ")), F.transform("w", lambda x: F.right(x, F.lit(1))))
    words = F.zip_with(F.col("w"), F.slice(before, F.lit(1), F.size("w")), lambda x, y: F.concat(F.lit("w"), y, x))
    keys = [F.transform(c, lambda x: F.concat(F.lit("k"), x)) for c in found.columns[2:]]
    items = F.concat(F.transform("t", lambda x: F.concat(F.lit("t"), x)), words, *keys)
    counted = found.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    # a token that holds a key is no ordinary one
    kept = counted.select(F.substring("item", 1, 1).alias("kind"), F.expr("substring(item, 2)").alias("item"), "n")
    return kept.where(f"NOT (kind = 't' AND item RLIKE '{KINDS[1][1]}|{KINDS[2][1]}')")


def drawn_keys(spark: SparkSession) -> DataFrame:
    """(kind, item, n) of random strings."""
    digest = F.sha2(F.concat(F.lit("random|"), F.col("id").cast("string")), 256)
    base64 = F.regexp_replace(F.base64(F.unhex(digest)), "[=\\s]", "")
    drawn = F.array(digest, base64, F.translate(base64, "+/", "-_"), F.regexp_replace(base64, "[^A-Z0-9]", ""))
    return spark.range(RANDOM).select(F.lit("k").alias("kind"), F.explode(drawn).alias("item"), F.lit(1).cast("long").alias("n"))


def pair_counts(docs: DataFrame) -> dict[tuple[bool, str], int]:
    """How often each pair of characters stands in random (True) and ordinary (False) strings."""

    def pairs(token: Column) -> Column:
        chars, rest = F.split(token, ""), F.length(token) - 1
        return F.zip_with(F.slice(chars, F.lit(1), rest), F.slice(chars, F.lit(2), rest), lambda x, y: F.concat(x, y))

    def weighted(strings: Column, weight: int) -> Column:
        return F.transform(strings, lambda p: F.struct(p.alias("pair"), (F.col("n") * weight).alias("n")))

    # identifiers of the documents' words, as they are written in code and paths: the words of a text
    # joined by _, - or /, and with capitals
    word, before, joins = F.expr("substring(item, 2)"), F.substring("item", 1, 1), ("_", "-", "/")
    joints = F.array(*[F.concat(before, F.lit(j)) for j in joins], *[F.concat(F.lit(j), F.substring(word, 1, 1)) for j in joins], F.concat(F.lower(before), F.upper(F.substring(word, 1, 1))))
    none = F.expr("cast(array() as array<struct<pair:string,n:bigint>>)")
    of_word = F.concat(weighted(pairs(word), len(joins)), weighted(pairs(F.initcap(word)), 1), F.when(before != " ", weighted(joints, 1)).otherwise(none))
    each = F.when(F.col("kind") == "w", of_word).when(F.length("item") > 1, weighted(pairs(F.col("item")), 1)).otherwise(none)
    rows = labelled_items(docs).unionByName(drawn_keys(docs.sparkSession)).select((F.col("kind") == "k").alias("random"), F.explode(each).alias("p"))
    counted = rows.select("random", "p.*").groupBy("random", "pair").agg(F.sum("n").alias("n"))
    return {(r.random, r.pair): r.n for r in counted.collect()}  # 2 * 66 * 66 rows at most


def train(docs: DataFrame) -> list[float]:
    """Log ratio of P(next character | character) of the two models, by first and next character."""
    counts = pair_counts(docs)
    rows = {}
    for k in (True, False):
        after = {b: sum(counts.get((k, a + b), 0) for a in ALPHABET) + 1 for b in ALPHABET}
        total = sum(after.values())
        for a in ALPHABET:
            seen = [counts.get((k, a + b), 0) for b in ALPHABET]
            rows[k, a] = [(c + BACKOFF * after[b] / total) / (sum(seen) + BACKOFF) for c, b in zip(seen, ALPHABET)]
    return [log(p / q) for a in ALPHABET for p, q in zip(rows[True, a], rows[False, a])]


def ratio(token: Column, model: list[float]) -> Column:
    """Summed log-likelihood ratio of the character pairs of a token."""
    place = {c: i for i, c in enumerate(ALPHABET)}
    codes = F.split(F.lit(" ".join(str(place.get(chr(c), 0)) for c in range(128))), " ").cast("array<int>")
    table = F.split(F.lit(" ".join(map(repr, model))), " ").cast("array<double>")
    chars = F.transform(F.split(token, ""), lambda c: F.element_at(codes, F.ascii(c) + 1))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc, c):
        more = F.when(acc["last"] >= 0, F.element_at(table, acc["last"] * len(ALPHABET) + c + 1)).otherwise(0.0)
        return F.struct(c.alias("last"), (acc["sum"] + more).alias("sum"))

    return F.aggregate(chars, start, step, lambda acc: acc["sum"])


def add_spans(docs: DataFrame, model: list[float], base: str = "base", spans: str = "spans") -> DataFrame:
    """All columns of ``docs``, the pattern spans and all spans, each (start, kind, end) by start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    judged = F.transform(
        matches(text, TOKEN, 0, 20, len(KINDS)),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.substring(text, s["start"] + 1, s["end"] - s["start"]).alias("token")),
    )
    free = lambda s: ~F.exists(F.col(base), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    odd = F.filter(judged, lambda s: free(s) & (ratio(s["token"], model) > LLR))
    plain = F.transform(odd, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return docs.withColumn(base, base_spans(text)).withColumn(spans, F.array_sort(F.concat(F.col(base), plain)))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with each run of secret characters replaced by ``mark``; other columns stay,
    and ``n_chars``, where there is one, is counted anew for the changed rows."""
    base, spans = fresh_name(docs, "base"), fresh_name(docs, "spans")
    found = add_spans(docs, train(docs), base, spans)

    def step(acc, s):
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    def rest(acc):
        return F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))

    clean = F.aggregate(F.col(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)
    changed = F.size(spans) > 0
    out = found.withColumn("text", F.when(changed, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.drop(base, spans)


@register("op9_secret_scans")
def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = add_spans(docs, train(docs))
    counts = [F.expr(f"size(filter(base, s -> s.kind = {k}))").cast("long").alias(f"n_{name}") for k, (name, *_) in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))
