"""The alerts topic: stream equals batch; restarts, replays and late rows."""

import pytest
from pyspark.sql import functions as F

from flight_engine.functions.columns import event_time
from flight_engine.operators.anomalies import alerts
from flight_engine.session import STATE_STORE, scratch_path
from flight_engine.streaming import alerts as al
from flight_engine.streaming.pipeline import run_until_caught_up

SCHEMA = "icao24 string, timestamp long, time_position long, longitude double, latitude double, vertical_rate double, callsign string, velocity_kmh double"


def same(got, want):
    want = want.select(*got.columns)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


class Topic:
    """A source folder, the topic and its checkpoint; every feed is a run of its own (a restart)."""

    def __init__(self, spark):
        self.spark, self.paths = spark, [scratch_path(spark, n) for n in ("t-al-src", "t-al-topic", "t-al-ck")]

    def feed(self, rows):
        df = self.spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
        df.write.mode("append").parquet(self.paths[0])
        stream = self.spark.readStream.schema(df.schema).parquet(self.paths[0]).withColumn("event_time", event_time())
        run_until_caught_up(al.write_alerts(al.alert_messages(stream), self.paths[1], self.paths[2]))
        return sorted((r.alert_type, r.icao24, r.timestamp) for r in al.read_alerts(self.spark, self.paths[1]).collect())


def fix(aircraft, t, vr=0.0, lon=0.0, callsign="AAL1", v=500.0, tp=None):
    return (aircraft, t, t if tp is None else tp, lon, 0.0, vr, callsign, v)


def test_stream_equals_batch_in_any_layout(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    h = history(spark, SF_SMALL, 60)
    hot = h.withColumn("icao24", F.when(F.col("timestamp") % 3 == 0, F.lit("hot")).otherwise(F.col("icao24")))
    hot = hot.withColumn("vertical_rate", F.when(F.col("timestamp") % 5 > 0, F.lit(-20.0)).otherwise(F.col("vertical_rate")))
    mixed = hot.orderBy(F.xxhash64(*hot.columns)).repartition(5)
    want = alerts(hot)
    assert want.select("alert_type").distinct().count() == 4
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        assert same(al.alerts_stream(spark, mixed), want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_state_survives_restarts(spark):
    """A run of three falling fixes and a jump, one fix a run of the query."""
    topic, t = Topic(spark), 1_000_000
    assert topic.feed([fix("a", t, -20.0), fix("b", t)]) == []
    assert topic.feed([fix("a", t + 10, -20.0)]) == []
    assert topic.feed([fix("a", t + 20, -20.0)]) == [("EMERGENCY_DESCENT", "a", t + 20)]
    # the run goes on: no second alert; the other aircraft jumps 40 degrees in a minute
    want = [("EMERGENCY_DESCENT", "a", t + 20), ("POSITION_JUMP", "b", t + 60)]
    assert topic.feed([fix("a", t + 30, -20.0), fix("b", t + 60, lon=40.0)]) == want


def test_replayed_rows_alert_once(spark):
    topic, t = Topic(spark), 1_000_000
    rows = [fix("a", t, callsign=None), fix("a", t + 5, v=2000.0), fix("a", t + 10), fix("a", t + 10)]
    want = [("GHOST_NULL_CALLSIGN", "a", t), ("VELOCITY_OUTLIER", "a", t + 5)]
    assert topic.feed(rows) == want
    assert topic.feed(rows) == want
    assert topic.feed([fix("a", t + 20), *rows]) == want


def test_late_rows(spark):
    """Late rows within the watermark meet the rules on single rows; behind it they are dropped."""
    topic, t = Topic(spark), 1_000_000
    topic.feed([fix("a", t), fix("b", t)])
    topic.feed([fix("a", t + 300, lon=1.0), fix("b", t + 300)])
    want = [("GHOST_NULL_CALLSIGN", "a", t + 100)]
    # far from both neighbours, but its place in the sequence is past
    assert topic.feed([fix("a", t + 100, lon=90.0, callsign=None)]) == want
    # the newest fix stays the one that the next fix is compared with
    assert topic.feed([fix("a", t + 360, lon=1.0)]) == want
    topic.feed([fix("b", t + 9000)])
    topic.feed([fix("b", t + 9001)])
    assert topic.feed([fix("a", t + 400, callsign=None)]) == want


def test_silent_aircraft_are_forgotten(spark):
    topic, t = Topic(spark), 1_000_000
    topic.feed([fix("a", t, -20.0), fix("b", t)])
    topic.feed([fix("a", t + 1, -20.0)])
    later = t + 8 * 86400
    topic.feed([fix("b", later)])
    topic.feed([fix("b", later + 1)])  # the timer fires on the watermark that the batch before set
    topic.feed([fix("b", later + 2)])
    assert topic.feed([fix("a", later + 3, -20.0)]) == []  # a new run, not the third fix of the old one


@pytest.mark.parametrize("column", ["callsign", "velocity_kmh", "vertical_rate", "time_position"])
def test_null_columns(spark, column):
    at = SCHEMA.split(", ").index(next(c for c in SCHEMA.split(", ") if c.startswith(column)))
    rows = [tuple(None if i == at else x for i, x in enumerate(fix("a", 1_000_000 + 60 * k, -20.0))) for k in range(4)]
    got = Topic(spark).feed(rows)
    assert got == sorted((r.alert_type, r.icao24, r.timestamp) for r in alerts(spark.createDataFrame(rows, SCHEMA)).collect())


def test_alerts_in_a_session_with_the_default_state_store(spark):
    old = spark.conf.get(STATE_STORE)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_STORE, plain)
    try:
        assert Topic(spark).feed([fix("a", 1_000_000, callsign=None)]) == [("GHOST_NULL_CALLSIGN", "a", 1_000_000)]
        assert spark.conf.get(STATE_STORE) == plain
    finally:
        spark.conf.set(STATE_STORE, old)
