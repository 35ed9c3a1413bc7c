"""Mixing sources to target weights.

Tokens are summed per source, each source's target becomes a repetition rate
``target / tokens``, and each document is taken ``floor(rate)`` times plus once more when a uniform
number hashed from its id is below the fraction. The hash makes reruns and retried tasks agree.

Targets: the budget is shared by weight; a source stops at ``cap`` times its own size and what it
leaves goes to the others by weight, until none is above. That is the common level ``L`` with
``target = min(cap * size, L * weight)``: with sources in order of ``cap * size / weight`` the
capped ones form a prefix, so one running sum finds it.

Edge cases: a null text has size 0; a null source is a source of its own and comes last; a source
without tokens has target 0 and its documents are taken 0 times; repeated rows share their id's
draw; a null id is hashed as an empty string; an empty table gives an empty result. Extra columns
are kept by ``mix`` and ignored by ``plan_mix``; helper columns never clash with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terracheck.llm.common import fresh_name, read_table, written
from terracheck.llm.registry import register

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2
SEED = 17
#: Sources whose rates are sent to all tasks; more are joined by a shuffle, with the same result.
BROADCAST_SOURCES = 10_000


def text_size(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``(source, source_size)``, one row per source, to ``(source, source_size, target, rate)``.

    The table has one row per source and no texts, so one sorted pass over it is enough."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.row_number().over(order) - 1) % n + 1)
    limit = F.col("source_size") * cap
    by_level = Window.orderBy((limit / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    t = sizes.select("source", F.col("source_size").cast("long"), pick.alias("weight"))
    t = t.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum(limit).over(before), F.lit(0)).alias("capped_size"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("capped_weight"),
    )
    # the level if all sources before this one, in order of their own level, stop at their cap
    level = (F.col("total") * budget - F.col("capped_size")) / (F.col("weights") - F.col("capped_weight"))
    t = t.withColumn("level", level).withColumn("stops", F.col("weight") * level >= limit)
    # after the first source that does not stop, levels only fall
    t = t.withColumn("common", F.max(F.when(~F.col("stops"), F.col("level"))).over(everything))
    target = F.when(F.col("stops"), limit.cast("double")).otherwise(F.col("weight") * F.col("common"))
    return t.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """U[0, 1) from the first 48 bits of an md5 digest of seed and id."""
    text = F.concat(F.lit(f"mix|{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint") / F.lit(281474976710656.0)


def plan_mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies, taken``."""
    sized = docs.select("doc_id", "source", text_size(F.col("text")).alias("size"))
    return _with_copies(sized, sized, weights, budget, cap, seed)


def _with_copies(rows: DataFrame, sized: DataFrame, weights, budget, cap, seed) -> DataFrame:
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(totals, weights, budget, cap).withColumnRenamed("source", "_source"), "targets")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    whole = F.floor("rate")
    extra = (draw(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .withColumn("copies", whole + extra)
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mix itself: every column of ``docs``, each row as often as it is taken."""
    kept = fresh_name(docs, "_row")
    narrow = docs.select("doc_id", "source", text_size(F.col("text")).alias("size"))
    rows = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(kept), F.lit(0).alias("size"))
    taken = _with_copies(rows, narrow, weights, budget, cap, seed).where("copies > 0")
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select(kept, each.alias("_copy")).select(f"{kept}.*")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM sources
), running AS (
  SELECT *, source_size * {CAP} AS lim, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
    CAST(coalesce(sum(source_size * {CAP}) OVER w, 0) AS BIGINT) AS capped_size, CAST(coalesce(sum(weight) OVER w, 0) AS BIGINT) AS capped_weight
  FROM ranked
  WINDOW w AS (ORDER BY source_size * {CAP} / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (CAST(total AS DOUBLE) * {BUDGET}::DOUBLE - capped_size) / (weights - capped_weight) AS level FROM running
), stopped AS (
  SELECT *, weight * level >= lim AS stops FROM levels
), targets AS (
  SELECT source, source_size, CASE WHEN stops THEN CAST(lim AS DOUBLE) ELSE weight * max(CASE WHEN NOT stops THEN level END) OVER () END AS target FROM stopped
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST('0x' || substr(md5('mix|{SEED}|' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM rated
"""


@register("op10_mix_sources", SQL)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return plan_mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
