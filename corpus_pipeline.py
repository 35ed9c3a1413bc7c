"""The corpus pipeline: five stages over ``documents``, each on what the one before kept.

1. quality: documents that the classifier (trained on the labels of its own input) rejects go.
2. near_duplicates: one document of each group of linked word-shingle sets stays.
3. decontamination: documents contaminated by the benchmark go.
4. secrets: secret spans are replaced by a mark, all documents stay.
5. mix: documents are taken as often as their source's target weight asks.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame with the columns of ``docs``; the
last one repeats rows. Between stages the result is a Parquet table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terracheck.llm import decontam, jaccard, mixing, quality, secrets
from terracheck.llm.common import read_table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
]

#: SQL expresses neither the trained stages nor the components; the tests hold each stage against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
