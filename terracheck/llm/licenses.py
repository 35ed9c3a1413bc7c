"""License scans: an exact containment join between text blocks and license templates.

Blocks are of two kinds. ``op8_license_scans`` takes the lines of a text, as its SQL does. A notice that
is wrapped over lines is in none of them, and a line of any length is one bag of words; so
``op8_license_notices`` takes overlapping word windows of the whole text instead. The windows of a
template start every ``s`` words and hold ``2 s``, ``s`` being the template's number of words, rounded
up to a power of two: ``s + 1`` words in a row are always in one window, however lines are broken.

A block matches a template when it holds at least ``NUM / DEN`` of the template's distinct words.
Template words are put in one global order, by how many blocks of the corpus hold them, rarest
first. A template with ``t`` words that needs ``o`` of them must share one of its first
``t - o + 1`` words with a matching block (prefix filter); the block must hold ``o`` words (length
filter); and both must have ``o`` words left from the shared one on (positional filter). What
passes is verified by the size of the intersection. All steps are DataFrame expressions and joins;
texts are not shuffled, only the few blocks that pass the filters.

The base phrases are found by word position in the whole text. Case is ASCII case.

Edge cases: null and empty texts have 0 words, no labels and score 0; results depend on the text
alone, so repeated rows and null ids get their own row with the same result; empty tables give no
rows. Only ``doc_id`` and ``text`` are read, so other columns can have any name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracheck.llm.common import LOWER, UPPER, ascii_lower, read_table
from terracheck.llm.registry import register

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Short notices, as normalised words. A template is any text: with word windows a caller
#: can pass whole licenses, with lines only what stands in one line.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Containment threshold 4 / 5.
NUM, DEN = 4, 5

_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    """Distinct words of a template in order."""
    return list(dict.fromkeys(text.split()))


def _words(lowered: Column) -> Column:
    """Words of a lower-cased text, with an empty string where it starts or ends with a gap."""
    return F.split(lowered, _GAP)


def _strings(values: list[str]) -> Column:
    return F.split(F.lit(" ".join(values)), " ")


def blocks_of(docs: DataFrame, key: Column) -> DataFrame:
    """(key, block) of every line."""
    return docs.select(key.alias("key"), F.explode(F.split(ascii_lower(F.col("text")), "\n")).alias("block"))


def word_order(blocks: DataFrame, templates=TEMPLATES) -> list[str]:
    """All template words, those in the fewest blocks first. Bounded by the templates' words."""
    vocabulary = sorted({w for _, text in templates for w in template_words(text)})
    held = F.explode(F.array_intersect(_words(F.col("block")), _strings(vocabulary)))
    counts = {r.word: r["count"] for r in blocks.select(held.alias("word")).groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _has_word(block: Column, words: list[str]) -> Column:
    return block.rlike(rf"(?<![0-9a-z\x{{80}}-\x{{10FFFF}}])({'|'.join(words)})(?![0-9a-z\x{{80}}-\x{{10FFFF}}])")


def find_templates(blocks: DataFrame, templates=TEMPLATES, num: int = NUM, den: int = DEN, order: list[str] | None = None, span: int | None = None) -> DataFrame:
    """Every (key, block, label, containment) at or above the threshold. With ``span`` the blocks are
    cut into word windows first."""
    spark = blocks.sparkSession
    order = order or word_order(blocks, templates)
    rank = {w: i for i, w in enumerate(order)}
    entries, prefix = [], []
    for i, (label, text) in enumerate(templates):
        words = sorted(template_words(text), key=rank.__getitem__)
        need = -(-len(words) * num // den)
        entries.append((i, label, words))
        prefix += [(w, i, len(words), need, p) for p, w in enumerate(words[: len(words) - need + 1])]
    least = min(p[3] for p in prefix)
    starters = sorted({p[0] for p in prefix})
    has_starter = _has_word(F.col("block"), starters)
    if span:
        blocks = windows_of(blocks.where(has_starter), span)
    # array_intersect keeps the order of its first argument: the block's template words, rarest first
    shared = blocks.where(has_starter).select("key", "block", F.array_intersect(_strings(order), _words(F.col("block"))).alias("held"))
    shared = shared.where(F.size("held") >= least)
    prefixes = spark.createDataFrame(prefix, "word string, template int, size int, need int, place int")
    table = spark.createDataFrame(entries, "template int, label string, words array<string>")
    each = shared.select("key", "block", "held", F.posexplode("held").alias("at", "word"))
    candidates = each.join(F.broadcast(prefixes), "word").where((F.size("held") - F.col("at") >= F.col("need")) & (F.col("size") - F.col("place") >= F.col("need")))
    candidates = candidates.select("key", "block", "held", "template", "size", "need").distinct()
    verified = candidates.join(F.broadcast(table), "template").withColumn("overlap", F.size(F.array_intersect("words", "held")))
    return verified.where("overlap >= need").select("key", "block", "label", (F.col("overlap") / F.col("size")).alias("containment"))


def windows_of(blocks: DataFrame, span: int) -> DataFrame:
    """(key, block) of the windows of ``2 * span`` words that start every ``span`` words."""
    words = blocks.select("key", F.array_remove(_words(F.col("block")), "").alias("words")).where(F.size("words") > 0)
    # a start whose words are all in the window before gives none
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - span - 1, F.lit(0)), F.lit(span))
    windows = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, F.lit(2 * span)), " "))
    return words.select("key", F.explode(windows).alias("block"))


def find_in_lines(texts: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(key, block, label, containment) of the lines of ``(key, text)``."""
    return find_templates(blocks_of(texts, F.col("key")), templates)


def find_in_windows(texts: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(key, block, label, containment) of the word windows of ``(key, text)``."""
    whole = texts.select("key", ascii_lower(F.col("text")).alias("block"))
    order = word_order(whole, templates)
    by_span: dict[int, list[tuple[str, str]]] = {}
    for label, text in templates:
        by_span.setdefault(1 << (len(text.split()) - 1).bit_length(), []).append((label, text))
    found = [find_templates(whole, part, order=[w for w in order if any(w in t.split() for _, t in part)], span=span) for span, part in sorted(by_span.items())]
    return reduce(DataFrame.unionByName, found)


def phrase_places(text: Column, phrase: str) -> Column:
    """Number of places of a phrase, its first and its last start in words; null if there is none."""
    n = len(phrase.split())
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text), _GAP, " ")), F.lit(" "))
    near = text.rlike("(?i)" + _GAP.join(phrase.split()))
    pieces = F.split(spaced, f" {phrase}(?= )")

    def spaces(c):
        return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))

    found = F.struct(
        (F.size(pieces) - 1).cast("long").alias("n"),
        spaces(F.element_at(pieces, 1)).cast("long").alias("first"),
        # words of the text, less those after the last place, less the phrase
        (spaces(spaced) - 1 - (spaces(F.element_at(pieces, -1)) - 1) - n).cast("long").alias("last"),
    )
    return F.when(near & (F.size(pieces) > 1), found)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, find=find_in_lines) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of each row."""
    key = F.md5(F.col("text"))
    matched = find(docs.where("text IS NOT NULL").select(key.alias("key"), "text"), templates)
    per_text = matched.groupBy("key").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    names = [f"p{i}" for i in range(len(PHRASES))]
    rows = docs.select(
        "doc_id", key.alias("text_key"), F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"),
        *[phrase_places(F.col("text"), p).alias(n) for n, p in zip(names, PHRASES)],
    )
    base = F.array_sort(F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(label)) for n, label in zip(names, PHRASES.values())])))
    joined = rows.join(per_text, rows.text_key == per_text.key, "left")
    every = F.array_sort(F.array_union(base, F.coalesce("more", F.expr("cast(array() as array<string>)"))))
    return joined.select(
        "doc_id", "n_words", sum((F.coalesce(F.col(f"{n}.n"), F.lit(0)) for n in names), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[F.col(f"{n}.first") for n in names]).alias("first_word"), F.greatest(*[F.col(f"{n}.last") for n in names]).alias("last_word"),
        F.concat_ws(",", base).alias("base_labels"), F.concat_ws(",", every).alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    words = "regexp_extract_all(translate({}, '" + UPPER + "', '" + LOWER + "'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
    templates = ", ".join(f"('{label}', [{', '.join(repr(w) for w in template_words(text))}])" for label, text in TEMPLATES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce({words.format("text")}, []) AS w FROM documents),
phrases(phrase, label, n) AS (VALUES {phrases}),
templates(label, t) AS (VALUES {templates}),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
base AS (SELECT r, i - 1 AS place, label FROM places, phrases WHERE i + n - 1 <= len(w) AND array_to_string(w[i : i + n - 1], ' ') = phrase),
per_base AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM base GROUP BY r),
blocks AS (SELECT r, list_distinct({words.format("block")}) AS b FROM (SELECT r, unnest(string_split(text, chr(10))) AS block FROM docs)),
method AS (
  SELECT r, label, CAST(len(list_intersect(t, b)) AS DOUBLE) / len(t) AS containment FROM blocks, templates
  WHERE {DEN} * len(list_intersect(t, b)) >= {NUM} * len(t)
),
base_labels AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT r, label FROM base) GROUP BY r),
all_labels AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM base UNION SELECT r, label FROM method) GROUP BY r),
best AS (SELECT r, max(containment) AS containment FROM method GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
FROM docs LEFT JOIN per_base USING (r) LEFT JOIN base_labels b USING (r) LEFT JOIN all_labels a USING (r) LEFT JOIN best USING (r)
"""


@register("op8_license_scans", _sql())
def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op8_license_notices")
def op8_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document, notices by word windows of the whole text."""
    return scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"), find=find_in_windows)
