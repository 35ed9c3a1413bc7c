"""Connected components of a link table, by hooking and pointer jumping.

Each round every label takes its smallest neighbour, takes that one's smallest neighbour in turn,
and links are carried over to the new labels; chains shorten by a factor each round, so the number
of rounds grows with the logarithm of the longest one. Tables are written between rounds; the
driver sees counts only. A link of a row with itself or with null changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracheck.llm.common import written


def merge_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels (id, label)`` after uniting the ids that ``links (a, b)`` connect; a label is the
    smallest one united."""
    at = labels.select(F.col("id").alias("_id"), F.col("label").alias("_label"))

    def relabel(df, column):
        return df.join(at, df[column] == F.col("_id")).drop(column, "_id").withColumnRenamed("_label", column)

    edges = _between(relabel(relabel(links.select("a", "b"), "a"), "b"))
    jumps = []
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low")).select("u", F.least("u", "low").alias("up"))
        further = least.select(F.col("u").alias("via"), F.col("up").alias("top"))
        jump = written(least.join(further, least["up"] == further["via"]).select("u", F.col("top").alias("to")), "jumps")
        jumps.append(jump)
        for column in ("a", "b"):
            edges = edges.join(jump, edges[column] == jump["u"]).drop(column, "u").withColumnRenamed("to", column)
        edges = _between(edges)
    for jump in jumps:
        labels = labels.join(jump, labels["label"] == jump["u"], "left").select("id", F.coalesce("to", "label").alias("label"))
    return written(labels, "labels") if jumps else labels


def _between(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
    return written(pairs.distinct(), "edges")
