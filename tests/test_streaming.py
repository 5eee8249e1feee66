"""Stream equals batch, and a checkpointed restart loses and duplicates nothing."""

import pytest
from pyspark.sql import functions as F

from flight_engine.operators.transform import process
from flight_engine.session import scratch_path
from flight_engine.streaming import pipeline as pl


def states(spark):
    from conftest import SF_SMALL
    from flight_engine.sources.testdata import flight_states
    return flight_states(spark, SF_SMALL)


def test_stream_transform_equals_batch(spark):
    s = states(spark)
    raw = scratch_path(spark, "t-raw")
    pl.write_messages(s, raw)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    pl.run_until_caught_up(pl.stream_transform(pl.file_source(spark, raw, "json"), out, ck))
    got = spark.read.schema("key string, value string").json(out)
    exp = process(s)
    from flight_engine.schema import PROCESSED_SCHEMA
    parsed = got.select(F.from_json("value", PROCESSED_SCHEMA).alias("r")).select("r.*")
    assert parsed.exceptAll(exp).count() == 0 and exp.exceptAll(parsed).count() == 0


def test_restart_from_checkpoint(spark):
    s = states(spark)
    mid = s.select(F.percentile_approx("timestamp", 0.5)).first()[0]
    raw = scratch_path(spark, "t-raw2")
    proc = scratch_path(spark, "t-proc")
    table, ck = scratch_path(spark, "t-table"), scratch_path(spark, "t-table-ck")
    pl.write_messages(process(s.where(F.col("timestamp") <= mid)), proc, keyed=True)
    pl.run_until_caught_up(pl.stream_sink_table(pl.file_source(spark, proc, "json"), table, ck))
    n1 = spark.read.parquet(table).count()
    # second run, same checkpoint: only new files are consumed
    pl.write_messages(process(s.where(F.col("timestamp") > mid)), proc, keyed=True)
    pl.run_until_caught_up(pl.stream_sink_table(pl.file_source(spark, proc, "json"), table, ck))
    t = spark.read.parquet(table)
    assert n1 > 0 and t.count() == process(s).count()
    assert t.groupBy("icao24", "timestamp", "time_position").count().where("count > 1").count() == 0
    _ = raw


def test_stateful_descent_equals_batch(spark):
    from conftest import SF_MID
    from flight_engine.operators.anomalies import emergency_descent
    from flight_engine.plans.catalog import history
    from flight_engine.streaming.stateful import descent_stream
    h = history(spark, SF_MID)
    a, b = descent_stream(spark, h), emergency_descent(h)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_latest_state_ttl_evicts_silent_aircraft(spark, monkeypatch):
    from conftest import SF_SMALL
    from flight_engine.operators.anomalies import latest_state
    from flight_engine.plans.catalog import history
    from flight_engine.streaming import stateful
    seen = {}
    real = stateful.latest_from_upserts

    def spy(spark_, out, columns, ttl_s=60):
        seen["path"] = out
        return real(spark_, out, columns, ttl_s)
    monkeypatch.setattr(stateful, "latest_from_upserts", spy)
    h = history(spark, SF_SMALL, 60)
    got = stateful.latest_state_ttl_stream(spark, h)
    exp = latest_state(h)
    assert got.exceptAll(exp.select(*got.columns)).count() == 0
    assert exp.exceptAll(got.select(*exp.columns)).count() == 0
    emitted = spark.read.parquet(seen["path"])
    evicted = emitted.where("evicted").select("icao24").distinct().count()
    assert evicted > 0  # state of silent aircraft was dropped, not kept forever


def test_late_rows_are_dropped_and_counted(spark):
    """Rows behind the watermark are dropped once a batch has set it (Spark judges late
    rows against the previous batch's watermark) and counted in the progress metrics,
    per partially aggregated group."""
    from conftest import SF_SMALL
    from flight_engine.functions.columns import event_time
    from flight_engine.plans.catalog import history
    from flight_engine.streaming.stateful import WATERMARK
    h = history(spark, SF_SMALL)
    mid, q3 = h.agg(F.percentile_approx("timestamp", 0.5), F.percentile_approx("timestamp", 0.75)).first()
    src_path = scratch_path(spark, "t-late-src")
    newer = h.where(F.col("timestamp") >= mid)
    newer.where(F.col("timestamp") < q3).write.mode("append").parquet(src_path)   # batch 0
    newer.where(F.col("timestamp") >= q3).write.mode("append").parquet(src_path)  # batch 1
    late = h.where(F.col("timestamp") < mid - 7200)                              # batch 2: late
    late.write.mode("append").parquet(src_path)
    stream = (spark.readStream.schema(h.schema).option("maxFilesPerTrigger", 1).parquet(src_path)
              .withColumn("event_time", event_time()))
    counts = (stream.withWatermark("event_time", WATERMARK)
              .groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.count("*").alias("n")))
    out, ck = scratch_path(spark, "t-late-out"), scratch_path(spark, "t-late-ck")
    events = pl.run_logged(spark, lambda: pl.stream_upserts(counts, out, ck))
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for e in events for op in e.get("stateOperators", []))
    late_windows = late.select(F.window(event_time(), "1 hour")).distinct().count()
    assert dropped == late_windows > 0
    got = pl.read_upserts(spark, out, ["w"]).agg(F.sum("n")).first()[0]
    assert got == newer.count()  # late rows never reach the result


LAYOUTS = [(1, 10_000), (4, 50), (16, 7)]


@pytest.mark.parametrize("files,arrow_rows", LAYOUTS)
def test_stateful_streams_do_not_depend_on_files_or_arrow_batches(spark, files, arrow_rows):
    """Every stateful stream equals its batch operator however the input is split, in any order."""
    from conftest import SF_SMALL
    from flight_engine.operators import anomalies as an
    from flight_engine.operators import warehouse as wh
    from flight_engine.plans.catalog import dirty, history
    from flight_engine.operators.sink import filter_sinkable
    from flight_engine.streaming import stateful as st
    mixed = lambda df: df.orderBy(F.xxhash64(*df.columns)).repartition(files)
    h, fast = history(spark, SF_SMALL), history(spark, SF_SMALL, 60)
    hot = h.withColumn("icao24", F.when(F.col("timestamp") % 3 == 0, F.lit("hot")).otherwise(F.col("icao24")))
    hot = hot.withColumn("vertical_rate", F.when(F.col("timestamp") % 5 > 0, F.lit(-20.0)).otherwise(F.col("vertical_rate")))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        pairs = [
            (st.descent_stream(spark, mixed(hot)), an.emergency_descent(hot)),
            (st.latest_state_ttl_stream(spark, mixed(fast.withColumn("time_position", F.when(F.col("timestamp") % 2 == 0, F.col("time_position"))))), None),
            (st.dedup_stream(spark, mixed(filter_sinkable(dirty(spark, SF_SMALL)))), an.dedup_states(filter_sinkable(dirty(spark, SF_SMALL)))),
            (st.congestion_stream(spark, mixed(fast), deg=90.0, min_aircraft=1), an.congestion(fast, deg=90.0, min_aircraft=1)),
            (st.trajectory_stream(spark, mixed(fast)), wh.trajectory_window(fast)),
            (st.latest_state_stream(spark, mixed(fast)), an.latest_state(fast)),
        ]
        for got, want in pairs:
            assert got.count() > 0
            if want is not None:
                want = want.select(*got.columns)
                assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        total = st.continuous_hourly(spark, mixed(h)).agg(F.sum("states")).first()[0]
        assert total == h.count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
