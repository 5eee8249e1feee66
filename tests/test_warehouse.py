"""Warehouse checks not covered by the oracle defaults."""

from pyspark.sql import functions as F

from flight_engine.operators.warehouse import expectations


def test_expectations_with_explicit_as_of(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    from flight_engine.sources.testdata import table
    h = history(spark, SF_SMALL)
    newest = h.agg(F.max("timestamp")).first()[0]
    nation = table(spark, SF_SMALL, "nation").select("n_name")
    as_of = newest - 86400  # one day before the newest row
    got = {r.expectation: r for r in expectations(h, nation, as_of=as_of).collect()}
    future = h.where(F.col("timestamp") > as_of + 60).count()
    assert got["no_future_timestamps"].failures == future > 0
    assert not got["no_future_timestamps"].passed
    assert got["recency"].passed and got["relationships_origin_country"].failures == 0
    late = {r.expectation: r for r in expectations(h, nation, as_of=newest + 7200).collect()}
    assert late["recency"].failures == 1 and late["no_future_timestamps"].failures == 0
