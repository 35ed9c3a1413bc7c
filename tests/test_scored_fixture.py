"""The injected table with stand-in scores: how often it is derived."""

from pyspark.sql import functions as F

from terracheck.operators import sampling as SA
from terracheck.plans import queries_report as QR
from tests.conftest import SF_SMALL


def test_ranks_by_a_table_of_ids(spark, assets_small):
    df = assets_small.select("row_id", "country")
    plain = SA.with_hash_rank(df, 40, 9, "s")
    by_ids = SA.with_hash_rank(df, 40, 9, "s", ids=df.select("row_id"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, by_ids.collect()))


def test_the_scored_fixture_is_derived_once(spark):
    """Its consumers scan it several times; none of them reads the source tables again."""
    plan = QR.scored_fixture(spark, SF_SMALL).select(F.col("latitude"))._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()
