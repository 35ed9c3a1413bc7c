"""Document fingerprints: 64-bit SimHash and a search within a Hamming radius.

Terms are a text's distinct words, weighted by their length: each votes with its weight for or
against every bit of its hash, and a bit is set when its yes votes outweigh the others. Two bits
share one 64-bit sum (32 bits each hold any text's votes), so a fingerprint is 33 sums of one
aggregation, whose rows are already partitioned for it.

The search cuts fingerprints into ``blocks`` blocks. Fingerprints within ``radius`` bits agree on
``blocks - radius`` whole blocks at least, so one table for each choice of that many blocks, keyed by
their bits, proposes every pair; a bit count verifies it. Copies are one entry of a table.

The neighbour in id order comes from one shuffle: rows are dealt to ranges of ids, and the first row
of each range is also sent to the range whose last row it follows. Bounds and firsts are a few
values for each of ``RANGES`` ranges for a shuffle partition.

All of it is DataFrame expressions. Edge cases: null and empty texts have no votes and fingerprint
0; equal texts have equal fingerprints; rows without an id come after all others; rows that share an
id are ordered by the digest of their text; a single document is its own next one; an empty table
gives no rows. Only ``doc_id`` and ``text`` are read."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terracheck.llm.common import read_table, written
from terracheck.llm.registry import register

RADIUS, BLOCKS = 3, 6
#: Ranges of ids for each shuffle partition.
RANGES = 4
_SPACE = r"[\x20\x09-\x0D]+"


def terms(text: Column) -> Column:
    """Distinct words, perhaps with an empty string, which weighs nothing."""
    return F.array_distinct(F.split(text, _SPACE))


def votes(term: Column) -> list[Column]:
    """The aggregates of a fingerprint: 32 sums of two bits' votes, and the sum of weights."""
    weight, h = F.length(term).cast("long"), F.xxhash64(term)
    pairs = [F.sum(weight * (F.shiftrightunsigned(h, i).bitwiseAND(F.lit(1)) + F.shiftleft(F.shiftrightunsigned(h, i + 32).bitwiseAND(F.lit(1)), 32))) for i in range(32)]
    return [c.alias(f"v{i}") for i, c in enumerate(pairs)] + [F.sum(weight).alias("weight")]


def fingerprint_of_votes() -> Column:
    """The fingerprint of a row of :func:`votes`, as a long."""
    out = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{i}", 32)
        for value, bit in ((low, i), (high, i + 32)):
            out = out.bitwiseOR(F.shiftleft((value * 2 > F.col("weight")).cast("long"), bit))
    return out


def hex64(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def with_next(docs: DataFrame) -> DataFrame:
    """``part, place, doc_id, text, next_text, ghost``: every document and the text that follows it
    in descending id order (the first follows the last). ``ghost`` rows end a range and are copies
    of the row that follows it."""
    spark = docs.sparkSession
    docs = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("oid")
    ).withColumn("digest", F.md5("text"))
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("oid", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    step = max(1, int(len(cuts) ** 0.5))

    def literal(values, kind):
        return F.split(F.lit(" ".join(map(str, values))), " ").cast(f"array<{kind}>") if values else F.expr(f"cast(array() as array<{kind}>)")

    coarse = F.size(F.filter(literal(cuts[step - 1 :: step], "long"), lambda c: c < F.col("oid")))
    docs = docs.withColumn("coarse", coarse)
    fine = F.filter(F.slice(literal(cuts, "long"), F.col("coarse") * step + 1, F.lit(step)), lambda c: c < F.col("oid"))
    docs = docs.withColumn("part", F.col("coarse") * step + F.size(fine)).drop("coarse")
    firsts = docs.groupBy("part").agg(F.min(F.struct(F.bitwise_not("oid").alias("order"), "digest")).alias("first")).orderBy("part").collect()
    parts = [r.part for r in firsts]
    first, target = {r.part: r.first for r in firsts}, dict(zip(parts, [*parts[1:], *parts[:1]]))
    slots = range(len(cuts) + 1)
    at = F.col("part") + 1
    is_first = (F.bitwise_not("oid") == F.element_at(literal([first[p].order if p in first else 0 for p in slots], "long"), at)) & (
        F.col("digest") == F.element_at(literal([first[p].digest if p in first else "-" for p in slots], "string"), at)
    )
    goes = F.element_at(literal([target.get(p, -1) for p in slots], "int"), at)
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("ghost"), F.lit(False).alias("wrap"))
    copy = F.struct(goes.alias("part"), F.lit(True).alias("ghost"), (goes <= F.col("part")).alias("wrap"))
    rows = docs.select("doc_id", "text", "oid", "digest", F.explode(F.array_compact(F.array(own, F.when(is_first, copy)))).alias("to"))
    rows = rows.select("doc_id", "text", "oid", "digest", "to.part", "to.ghost", "to.wrap")
    w = Window.partitionBy("part").orderBy("wrap", F.bitwise_not("oid"), "ghost", "digest")
    return rows.select("part", F.row_number().over(w).alias("place"), "doc_id", "text", F.lead("text").over(w).alias("next_text"), "ghost")


def edited_text(text: Column, next_text: Column) -> Column:
    """The last third of the code points replaced by the first as many of the next text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(next_text, F.lit(1), third))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fp, edited_fp, next_fp`` of every document."""
    rows = with_next(docs)
    rows = rows.select("part", "place", "doc_id", "ghost", "text", F.when(~F.col("ghost"), edited_text(F.col("text"), F.coalesce("next_text", F.lit("")))).alias("edited"))
    rows = rows.select("part", "place", "doc_id", "ghost", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.array("text", "edited").alias("texts"))
    keys = ["part", "place", "doc_id", "ghost", "n_chars", "edited_sha256"]
    each = rows.select(*keys, F.posexplode("texts").alias("kind", "text")).where("text IS NOT NULL")
    words = each.select(*keys, "kind", F.explode(terms(F.col("text"))).alias("term"))
    voted = words.groupBy(*keys, "kind").agg(*votes(F.col("term"))).select(*keys, "kind", fingerprint_of_votes().alias("fp"))
    w = Window.partitionBy("part").orderBy("place")
    one = voted.groupBy(*keys).agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    return one.withColumn("next_fp", F.lead("fp").over(w)).where("NOT ghost").drop("part", "place", "ghost")


def near_fingerprints(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``(query, fp, distance)`` of every distinct ``fp`` of ``prints`` within ``radius`` bits of a
    distinct ``fp`` of ``queries``; both columns are longs and null matches nothing."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]

    def tables(df, name):
        keys = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed]))
        return df.where("fp IS NOT NULL").select("fp").distinct().select(F.col("fp").alias(name), keys.alias("table", "key"))

    pairs = tables(queries, "query").join(tables(prints, "fp"), ["table", "key"])
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fp")))
    return pairs.where(distance <= radius).select("query", "fp", distance.alias("distance")).distinct()


@register("op3_document_fingerprints")
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text. ``n_within``, for ids divisible by
    100, counts the documents whose fingerprint is within the radius (itself too)."""
    prints = written(fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text")), "fingerprints")
    asked = prints.where("doc_id % 100 = 0").select("fp")
    counts = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    within = near_fingerprints(prints, asked).join(counts, "fp").groupBy("query").agg(F.sum("n").alias("n_within"))
    out = prints.join(within, (prints.fp == within["query"]) & (prints.doc_id % 100 == 0), "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", hex64(F.col("fp")).alias("fingerprint"), hex64(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "n_within",
    )
