"""Table maintenance: partitioned merge, retention, JDBC, pruned serving, stream counters."""

import uuid

from pyspark.sql import functions as F

from flight_engine.operators import serve as sv
from flight_engine.operators import sink as sk
from flight_engine.operators import warehouse as wh
from flight_engine.schema import PROCESSED_COLUMNS
from flight_engine.session import scratch_path


def hist(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    return history(spark, SF_SMALL)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_into_partitioned_equals_batch_merge(spark):
    from flight_engine.plans.catalog import _corrections
    h = hist(spark)
    path = scratch_path(spark, "t-merge")
    sk.append_batch(h, path)
    before = {r.dt: r.n for r in spark.read.parquet(path).groupBy("dt").agg(F.count("*").alias("n")).collect()}
    corr = _corrections(h).withColumn("created_at", F.current_timestamp())
    wh.merge_into_partitioned(spark, path, corr, scratch_path(spark, "t-merge-stage"))
    got = spark.read.parquet(path).select(*PROCESSED_COLUMNS)
    assert same(got, wh.merge_corrections(h, _corrections(h)))
    after = {r.dt: r.n for r in spark.read.parquet(path).groupBy("dt").agg(F.count("*").alias("n")).collect()}
    assert before == after  # corrections replace rows, they never add or lose any


def test_merge_keeps_rows_without_corrections_and_works_on_streamed_tables(spark):
    h = hist(spark)
    twice = h.union(h.where("timestamp % 13 = 1"))  # duplicated transponders, no correction for them
    path = scratch_path(spark, "t-merge-sink")
    sk.append_batch(twice, path, "stream-0")
    corr = h.where("timestamp % 13 = 0").withColumn("last_contact", F.col("last_contact") + 2)
    wh.merge_into_partitioned(spark, path, corr.withColumn("created_at", F.current_timestamp()), scratch_path(spark, "t-merge-sink-stage"))
    got = spark.read.parquet(path).select(*PROCESSED_COLUMNS)
    assert same(got, twice.where("timestamp % 13 <> 0").union(corr))
    sk.append_batch(h.limit(1), path, "stream-1")
    assert spark.read.parquet(path).count() == twice.count() + 1


def test_drop_expired_partitions(spark):
    h = hist(spark)
    name = f"t_archive_{uuid.uuid4().hex[:8]}"
    (wh.archive_partitions(h).write.partitionBy("year", "month", "day", "hour")
     .option("path", scratch_path(spark, name)).saveAsTable(name))
    as_of = h.agg(F.max("timestamp")).first()[0]
    dropped = wh.drop_expired_partitions(spark, name, as_of, days=10)
    kept = spark.table(name)
    cutoff = as_of - 10 * 86400
    hour_end = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(3600)) + 3600
    expected = h.where(hour_end > cutoff).count()
    assert dropped and kept.count() == expected < h.count()
    path = next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r[0] == "Location")
    assert spark.read.parquet(path).count() == expected  # the files are gone too


def test_jdbc_round_trip(spark):
    url = "jdbc:derby:memory:fe_test;create=true"
    table = f"T_{uuid.uuid4().hex[:8].upper()}"
    h = hist(spark)
    sk.append_jdbc(h, url, table, "org.apache.derby.jdbc.EmbeddedDriver", max_connections=2)
    back = sk.read_jdbc(spark, url, table, "org.apache.derby.jdbc.EmbeddedDriver",
                        partition_column="timestamp", lower=1704067200, upper=1706745600,
                        num_partitions=4).select(*PROCESSED_COLUMNS)
    assert same(back, h)


def test_recent_flights_from_table_equals_scan(spark):
    h = hist(spark)
    path = scratch_path(spark, "t-served")
    sk.append_batch(h, path)
    for limit, lookback in (("", 60), ("500", 60), ("25", 10 ** 9)):
        a = sv.recent_flights_from_table(spark, path, limit, lookback_s=lookback)
        b = sv.recent_flights(h, limit)
        assert a.collect() == b.collect()


def test_observed_sink_counters_equal_batch(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import q_pipeline_counters_stream, dirty
    from flight_engine.operators.transform import process
    got = q_pipeline_counters_stream(spark, SF_SMALL).first()
    exp = sk.sink_counts(process(dirty(spark, SF_SMALL))).first()
    assert (got.consumed, got.success, got.skipped) == (exp.consumed, exp.success, exp.skipped)


def test_rows_of_the_first_epoch_day(spark):
    """Timestamp 0 is an ordinary row: it can be reset, retained, compacted and served."""
    h = hist(spark).limit(3)
    base = [r.asDict() for r in h.collect()]
    rows = [base[k] | {"timestamp": t} for k, t in enumerate((0, 100, 1_706_000_000))]
    df = spark.createDataFrame([tuple(r[c] for c in PROCESSED_COLUMNS) for r in rows], h.schema)

    def times(path):
        return sorted(r.timestamp for r in spark.read.parquet(path).collect())

    for ensured in (False, True):
        path = scratch_path(spark, "t-epoch")
        if ensured:
            sk.ensure_table(spark, path)
        sk.append_batch(df, path)
        assert sk.table_days(spark, path) == ["1970-01-01", "2024-01-23"]
        assert [r.timestamp for r in sv.recent_flights_from_table(spark, path, 500).collect()] == [1_706_000_000, 100, 0]
        sk.append_batch(df.where("timestamp = 100"), path)
        assert sk.compact_table(spark, path, max_batches=1) == ["1970-01-01"] and times(path) == [0, 100, 100, 1_706_000_000]
        sk.retain_table(spark, path, as_of=604_800 + 50, days=7)
        assert times(path) == [100, 100, 1_706_000_000]
        sk.retain_table(spark, path, days=7)
        assert times(path) == [1_706_000_000]
        sk.append_batch(df, path)
        sk.reset_table(spark, path)
        assert times(path) == [] and sk.table_days(spark, path) == []
        sk.append_batch(df, path)
        assert times(path) == [0, 100, 1_706_000_000]
