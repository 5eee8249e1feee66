"""Plan properties that matter at scale, checked on the physical plans."""

import pytest

import __spark_entry__ as entry
from flight_engine.plans.catalog import QUERIES

# queries that run a stream or write a table while being built
SIDE_EFFECTS = {
    "stream_read_raw", "consume_processed", "scan_history_table", "read_from_beginning_bounded",
    "publish_raw", "stream_write_processed", "sink_append_table", "ensure_table", "reset_table",
    "archive_hourly", "archive_retention", "replay", "continuous_agg", "emergency_descent_stream",
    "latest_state_stream", "dedup_stream", "congestion_stream", "trajectory_stream",
    "pipeline_counters_stream", "stream_progress", "merge_corrections_table",
    "recent_flights_table", "latest_state_ttl_stream", "retain_window",
    "alerts_stream", "insert_errors", "agg_hourly_routes_stored", "dim_airports_scd2",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_cartesian_or_nested_loop(spark, name):
    from conftest import SF_SMALL
    p = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_previous_rows_never_window_a_whole_aircraft(spark):
    from conftest import SF_SMALL
    from flight_engine.operators.anomalies import position_jump
    from flight_engine.plans.catalog import history
    p = plan_of(position_jump(history(spark, SF_SMALL)))
    # the sorted rows are read back as they stand; the one window is over the partitions' borders
    assert p.count("Window [") == 1 and "EqualTo(_at,0)" in p and "IsNotNull(_end)" in p
    assert "SortMergeJoin" not in p and "Exchange rangepartitioning" not in p


def test_stored_table_scans_prune_and_push(spark):
    from conftest import SF_SMALL
    from flight_engine.operators import sink as sk
    from flight_engine.operators.spatial import bbox_filter
    from flight_engine.plans.catalog import history
    from flight_engine.session import scratch_path
    path = scratch_path(spark, "t-plan")
    sk.append_batch(history(spark, SF_SMALL), path)
    t = spark.read.parquet(path)
    p = plan_of(bbox_filter(t, 35.0, 72.0, -25.0, 45.0).select("icao24"))
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude), GreaterThanOrEqual(latitude" in p
    assert "ReadSchema: struct<icao24:string,longitude:double,latitude:double>" in p
    p2 = plan_of(t.where("dt >= '2024-01-20'").select("icao24"))
    assert "PartitionFilters: [isnotnull(dt" in p2


def test_airport_join_is_an_equi_join(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    from flight_engine.operators.spatial import airport_broadcast_join
    from flight_engine.sources.testdata import airports
    p = plan_of(airport_broadcast_join(history(spark, SF_SMALL), airports(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in p or "SortMergeJoin" in p


def test_bounded_broadcast_falls_back_above_the_bound(spark):
    from flight_engine.operators.joins import bounded_broadcast
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        ok = big.join(bounded_broadcast(small, max_rows=10), "k")
        refused = big.join(bounded_broadcast(small, max_rows=9), "k")
        assert "BroadcastHashJoin" in plan_of(ok)
        assert "BroadcastHashJoin" not in plan_of(refused) and "SortMergeJoin" in plan_of(refused)
        assert ok.count() == refused.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        if prev_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", prev_aqe)
