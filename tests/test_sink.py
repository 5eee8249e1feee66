"""Sink: normalize, guard, append/idempotence, retention."""

import json

from pyspark.sql import functions as F

from flight_engine.operators import sink as sk
from flight_engine.operators.sink import (
    append_batch, filter_sinkable, normalize_record, retain_window, sink_counts,
)
from flight_engine.session import scratch_path


def msgs(spark, *payloads):
    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string")


def test_normalize_full_and_missing(spark):
    full = {"icao24": "a", "callsign": "X", "origin_country": "C", "time_position": 1, "last_contact": 2,
            "longitude": 1.0, "latitude": 2.0, "baro_altitude": 3.0, "on_ground": "false", "velocity": 4.0,
            "true_track": 5.0, "vertical_rate": 6.0, "timestamp": 7, "velocity_kmh": 14.4, "status": "CLIMBING"}
    rows = normalize_record(msgs(spark, full, {"icao24": "b", "timestamp": 1})).collect()
    a = [r for r in rows if r.icao24 == "a"][0]
    b = [r for r in rows if r.icao24 == "b"][0]
    assert a.asDict() == full
    assert b.callsign is None and b.status is None and b.on_ground is None


def test_normalize_boolean_flag(spark):
    d = msgs(spark, {"icao24": "a", "on_ground": True, "timestamp": 1},
             {"icao24": "b", "on_ground": False, "timestamp": 1}, {"icao24": "c", "on_ground": None, "timestamp": 1})
    got = {r.icao24: r.on_ground for r in normalize_record(d, bool_case="title").collect()}
    assert got == {"a": "True", "b": "False", "c": None}
    low = {r.icao24: r.on_ground for r in normalize_record(d).collect()}
    assert low == {"a": "true", "b": "false", "c": None}


def test_filter_sinkable(spark):
    d = spark.createDataFrame([("a", 0), ("", 1), (None, 1), ("b", None)], "icao24 string, timestamp bigint")
    assert [r.icao24 for r in filter_sinkable(d).collect()] == ["a"]
    c = sink_counts(d).first()
    assert (c.consumed, c.success, c.skipped) == (4, 1, 3)


def test_append_is_idempotent_per_batch(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    h = history(spark, SF_SMALL)
    path = scratch_path(spark, "t-append")
    append_batch(h, path, batch_id=0)
    append_batch(h, path, batch_id=0)  # replayed batch
    append_batch(h.limit(3), path, batch_id=1)
    assert spark.read.parquet(path).count() == h.count() + 3


def test_retain_window(spark):
    d = spark.createDataFrame([(i * 86400,) for i in range(20)], "timestamp bigint")
    assert retain_window(d, days=7).count() == 8
    assert retain_window(d, days=7, as_of=10 * 86400).count() == 17  # days 3..19 kept


def test_two_checkpoints_do_not_overwrite_each_other(spark):
    """A stream restarted on a new checkpoint counts its batches from 0 again; nothing stored is lost."""
    from conftest import SF_SMALL
    from flight_engine.operators.transform import process
    from flight_engine.sources.testdata import flight_states
    from flight_engine.streaming import pipeline as pl
    s = process(flight_states(spark, SF_SMALL))
    table = scratch_path(spark, "t-two")
    for i in range(2):
        src = scratch_path(spark, f"t-two-src{i}")
        pl.write_messages(s.where(F.col("timestamp") % 2 == i), src, keyed=True)
        ck = scratch_path(spark, f"t-two-ck{i}")
        for _ in range(2):  # the second run of a checkpoint finds nothing new
            pl.run_until_caught_up(pl.stream_sink_table(pl.file_source(spark, src, "json"), table, ck))
    assert spark.read.parquet(table).count() == s.count()


def test_new_table_is_readable_and_stays_one_table(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    from flight_engine.schema import PROCESSED_COLUMNS
    h = history(spark, SF_SMALL)
    path = scratch_path(spark, "t-one")
    sk.ensure_table(spark, path)
    empty = spark.read.parquet(path)
    assert empty.count() == 0 and set(PROCESSED_COLUMNS) <= set(empty.columns)
    append_batch(h, path)
    append_batch(h.limit(5), path, "x-0")
    append_batch(h.limit(5), path, "x-0")
    assert spark.read.parquet(path).count() == h.count() + 5
    sk.reset_table(spark, path)
    assert spark.read.parquet(path).count() == 0 and sk.table_days(spark, path) == []
    append_batch(h, path)
    assert spark.read.parquet(path).select(*PROCESSED_COLUMNS).exceptAll(h).count() == 0


def test_retention_removes_rows_and_files(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    h = history(spark, SF_SMALL)
    path = scratch_path(spark, "t-retain")
    append_batch(h, path)
    gone = sk.retain_table(spark, path, days=7)
    want = retain_window(h, days=7)
    got = spark.read.parquet(path).select(*h.columns)
    assert gone and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert not set(gone) & set(sk.table_days(spark, path))
    sk.retain_table(spark, path, days=7, as_of=10 ** 10)
    assert spark.read.parquet(path).count() == 0


def test_compaction_keeps_the_rows(spark):
    from conftest import SF_SMALL
    from flight_engine.files import folders
    from flight_engine.plans.catalog import history
    h = history(spark, SF_SMALL)
    path = scratch_path(spark, "t-compact")
    for i in range(4):
        append_batch(h.where(F.col("timestamp") % 4 == i), path, f"s-{i}")
    days = sk.compact_table(spark, path, max_batches=2)
    got = spark.read.parquet(path).select(*h.columns)
    assert days and got.exceptAll(h).count() == 0 and h.exceptAll(got).count() == 0
    assert all(len(folders(spark, f"{path}/dt={d}")) == 1 for d in days)
