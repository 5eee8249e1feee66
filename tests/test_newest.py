"""The newest rows kept beside a table: pages equal the scan after every write and change."""

from pyspark.sql import functions as F

from flight_engine.files import create_new, names
from flight_engine.operators import newest as nw
from flight_engine.operators import serve as sv
from flight_engine.operators import sink as sk
from flight_engine.schema import PROCESSED_COLUMNS
from flight_engine.session import scratch_path


def hist(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    return history(spark, SF_SMALL)


def right(spark, path):
    """The kept rows serve the pages that a scan of the whole table gives."""
    table = spark.read.parquet(path)
    assert nw.kept_rows(spark, path, lambda: sk.table_days(spark, path)) is not None
    for limit in ("", "500"):
        assert sv.recent_flights_from_table(spark, path, limit).collect() == sv.recent_flights(table, limit).collect()


def test_page_equals_scan_after_each_maintenance_step(spark):
    h = hist(spark).cache()
    path = scratch_path(spark, "t-newest")
    old = h.where("timestamp < 1705000000")
    sk.append_batch(old, path)
    right(spark, path)
    sk.append_batch(h.where("timestamp >= 1705000000"), path, "s-0")
    right(spark, path)
    sk.append_batch(h.where("timestamp >= 1706000000").limit(40), path, "s-1")
    sk.append_batch(h.where("timestamp >= 1706000000").limit(30), path, "s-1")
    right(spark, path)
    sk.compact_table(spark, path, max_batches=1)
    right(spark, path)
    sk.retain_table(spark, path, days=3)
    right(spark, path)
    sk.reset_table(spark, path)
    assert sv.recent_flights_from_table(spark, path, 500).count() == 0
    sk.append_batch(old.limit(7), path)
    right(spark, path)
    h.unpersist()


def test_folds_and_replays(spark):
    path = scratch_path(spark, "t-newest-fold")
    h = hist(spark).limit(400).cache()
    for k in range(4):
        sk.append_batch(h.where(F.col("timestamp") % 4 == k), path, f"s-{k}")
    nw.fold(spark, path)
    entries = names(spark, f"{path}/{nw.FOLDER}")
    assert len(entries) == 1 and entries[0].startswith(nw.FOLD)
    right(spark, path)
    # a replay of a folded batch counts once, also with other rows
    sk.append_batch(h.where(F.col("timestamp") % 4 == 3), path, "s-3")
    right(spark, path)
    nw.fold(spark, path)
    sk.append_batch(h.where(F.col("timestamp") % 4 == 2).withColumn("timestamp", F.col("timestamp") + 1), path, "s-2")
    right(spark, path)
    # while another folds, rows stay as they are
    create_new(spark, f"{path}/{nw.FOLDER}/{nw.LOCK}")
    before = names(spark, f"{path}/{nw.FOLDER}")
    nw.fold(spark, path)
    assert names(spark, f"{path}/{nw.FOLDER}") == before
    h.unpersist()


def test_batch_whose_writer_died_is_served(spark):
    """Rows that were written without being kept are read from the batch; older tables from a scan."""
    path = scratch_path(spark, "t-newest-dead")
    h = hist(spark)
    sk.append_batch(h.where("timestamp < 1705000000"), path)
    try:
        with nw.batch_written(spark, path, "bx-0", lambda: sk.table_days(spark, path)):
            (sk.with_partition_columns(h.where("timestamp >= 1705000000").select(*PROCESSED_COLUMNS).withColumn("created_at", F.current_timestamp()))
             .withColumn("batch", F.lit("bx-0")).write.mode("append").partitionBy("dt", "batch").parquet(path))
            raise RuntimeError("lost")
    except RuntimeError:
        pass
    right(spark, path)
    from flight_engine.files import delete
    delete(spark, f"{path}/{nw.FOLDER}")
    assert nw.kept_rows(spark, path, lambda: []) is None
    table = spark.read.parquet(path)
    for limit, lookback in (("", 60), ("500", 60), ("25", 10 ** 9)):
        assert sv.recent_flights_from_table(spark, path, limit, lookback).collect() == sv.recent_flights(table, limit).collect()
    sk.append_batch(h.limit(3), path)
    right(spark, path)


def test_merge_changes_the_kept_rows(spark):
    from flight_engine.operators import warehouse as wh
    h = hist(spark)
    path = scratch_path(spark, "t-newest-merge")
    sk.append_batch(h, path)
    newest = sv.recent_flights(h, 500).agg(F.max("timestamp")).first()[0]
    corrections = h.where(F.col("timestamp") >= newest - 86400).withColumn("last_contact", F.col("last_contact") + 9)
    corrections = corrections.withColumn("callsign", F.lit("FIXED")).withColumn("created_at", F.current_timestamp())
    wh.merge_into_partitioned(spark, path, corrections, scratch_path(spark, "t-newest-merge-stage"))
    right(spark, path)
    assert sv.recent_flights_from_table(spark, path, 1).first().callsign == "FIXED"


def test_many_batches_are_folded(spark, monkeypatch):
    monkeypatch.setattr(nw, "MAX_SIDECARS", 3)
    path = scratch_path(spark, "t-newest-many")
    h = hist(spark).limit(60).cache()
    for k in range(5):
        sk.append_batch(h.where(F.col("timestamp") % 5 == k), path, f"s-{k}")
        right(spark, path)
        assert len(names(spark, f"{path}/{nw.FOLDER}")) <= 4
    h.unpersist()
