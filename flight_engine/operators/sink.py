"""Sink side: normalize processed messages, guard, append, maintain the table."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flight_engine.files import delete, exists, folders
from flight_engine.operators.newest import batch_written, rows_changed
from flight_engine.schema import PROCESSED_COLUMNS, PROCESSED_SCHEMA
from flight_engine.session import scratch_path


def normalize_record(df: DataFrame, value_col: str = "value", bool_case: str = "lower") -> DataFrame:
    """Processed JSON -> the 15 stored columns; absent fields become null.

    ``on_ground`` is kept as text.  ``bool_case="title"`` renders boolean
    flags as ``True``/``False`` (the spelling a Python ``str(bool)`` gives).
    """
    out = (df.select(F.from_json(F.col(value_col).cast("string"), PROCESSED_SCHEMA).alias("r"))
           .select("r.*"))
    if bool_case == "title":
        og = F.col("on_ground")
        out = out.withColumn("on_ground", F.when(F.lower(og).isin("true", "false"), F.initcap(og))
                             .otherwise(og))
    return out


def sinkable_condition():
    return (F.col("icao24").isNotNull() & (F.col("icao24") != "") & F.col("timestamp").isNotNull())


def filter_sinkable(df: DataFrame) -> DataFrame:
    """Reject null/empty icao24 and null timestamp (timestamp 0 is accepted)."""
    return df.where(sinkable_condition())


def sink_counts(df: DataFrame) -> DataFrame:
    """Insert outcome counters of one batch: consumed / success / skipped."""
    ok = sinkable_condition()
    return df.agg(F.count(F.lit(1)).alias("consumed"),
                  F.count(F.when(ok, 1)).alias("success"),
                  F.count(F.when(~ok | ok.isNull(), 1)).alias("skipped"))


def with_partition_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Date/hour partition columns derived from epoch seconds."""
    t = F.timestamp_seconds(F.col(ts))
    return (df.withColumn("dt", F.date_format(t, "yyyy-MM-dd"))
              .withColumn("hr", F.hour(t)))


TABLE_PARTITIONS = ("dt", "batch")
#: Folder of the file without rows: the null day, which no stored row can have.
SCHEMA_DAY = "dt=__HIVE_DEFAULT_PARTITION__"


def ensure_table(spark: SparkSession, path: str) -> None:
    """Create the empty history table if absent: PROCESSED + created_at, by day and batch.

    One file without rows carries the schema, so the table is readable at once.
    """
    if any(f.startswith("dt=") for f in folders(spark, path)):
        return
    empty = spark.createDataFrame([], PROCESSED_SCHEMA).withColumn("created_at", F.current_timestamp())
    empty.withColumn("hr", F.lit(None).cast("int")).coalesce(1).write.mode("append").parquet(f"{path}/{SCHEMA_DAY}/batch=schema")


def append_batch(df: DataFrame, path: str, batch_id: str | int | None = None) -> None:
    """Append one batch of processed states to the history table.

    Rows are guarded, stamped with ``created_at`` and partitioned by day and batch,
    in one layout for all writers. With a ``batch_id`` the write is idempotent: the
    same id replaces only its own rows. Without one, the batch gets a new id. The
    batch's newest rows are kept beside the table for pages.
    """
    spark = df.sparkSession
    batch = f"batch-{uuid.uuid4().hex[:12]}" if batch_id is None else f"b{batch_id}"
    out = with_partition_columns(filter_sinkable(df).select(*PROCESSED_COLUMNS)
                                 .withColumn("created_at", F.current_timestamp()))
    with batch_written(spark, path, batch, lambda: table_days(spark, path)):
        (out.withColumn("batch", F.lit(batch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*TABLE_PARTITIONS).parquet(path))


def table_days(spark: SparkSession, path: str) -> list[str]:
    """Days that the table has folders of, oldest first (a listing, no file is opened)."""
    return [f[3:] for f in folders(spark, path) if f.startswith("dt=") and f != SCHEMA_DAY]


def replace_days(spark: SparkSession, path: str, rows: DataFrame, days: list[str], name: str) -> None:
    """Put ``rows`` in the place of whole days.

    The rows are written first, under a new batch; the days' other batches go after.
    """
    batch = f"{name}-{uuid.uuid4().hex[:12]}"
    with rows_changed(spark, path, lambda: table_days(spark, path)):
        (rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*TABLE_PARTITIONS).parquet(path))
        for day in days:
            for old in folders(spark, f"{path}/dt={day}"):
                if old.startswith("batch=") and old != f"batch={batch}":
                    delete(spark, f"{path}/dt={day}/{old}")


def compact_table(spark: SparkSession, path: str, max_batches: int = 24) -> list[str]:
    """Rewrite days that more than ``max_batches`` batches were written to as one batch each."""
    days = [d for d in table_days(spark, path) if len(folders(spark, f"{path}/dt={d}")) > max_batches]
    if days:
        rows = spark.read.parquet(path).where(F.col("dt").cast("string").isin(days)).drop("batch")
        staging = scratch_path(spark, "compact")
        rows.write.partitionBy("dt").parquet(staging)
        replace_days(spark, path, spark.read.parquet(staging), days, "compact")
        delete(spark, staging)
    return days


def retain_table(spark: SparkSession, path: str, days: int = 7, as_of: int | None = None) -> list[str]:
    """Delete the rows older than ``days`` before ``as_of`` (default: newest timestamp) from the table.

    Days before the cutoff go as folders; the day that the cutoff falls in is rewritten.
    """
    if as_of is None:
        as_of = spark.read.parquet(path).select(F.max("timestamp")).first()[0]
    if as_of is None:
        return []
    cutoff = as_of - days * 86400
    edge = datetime.datetime.fromtimestamp(cutoff, datetime.timezone.utc).strftime("%Y-%m-%d")
    old = [d for d in table_days(spark, path) if d < edge]
    with rows_changed(spark, path, lambda: table_days(spark, path)):
        if edge in table_days(spark, path) and cutoff % 86400:
            staging = scratch_path(spark, "retain")
            (spark.read.parquet(path).where((F.col("dt").cast("string") == edge) & (F.col("timestamp") >= cutoff)).drop("batch")
             .write.partitionBy("dt").parquet(staging))
            kept = spark.read.schema(spark.read.parquet(path).drop("batch").schema).parquet(staging)
            replace_days(spark, path, kept, [edge], "retain")
            delete(spark, staging)
        ensure_schema_file(spark, path)
        for day in old:
            delete(spark, f"{path}/dt={day}")
    return old


def ensure_schema_file(spark: SparkSession, path: str) -> None:
    """The file without rows that keeps an emptied table readable."""
    if not exists(spark, f"{path}/{SCHEMA_DAY}/batch=schema"):
        (spark.read.parquet(path).drop(*TABLE_PARTITIONS).limit(0).coalesce(1)
         .write.mode("overwrite").parquet(f"{path}/{SCHEMA_DAY}/batch=schema"))


def retain_window(df: DataFrame, days: int = 7, as_of: int | None = None) -> DataFrame:
    """Rows no older than ``days`` before ``as_of`` (default: newest timestamp)."""
    ref = df.select(F.max("timestamp")).scalar() if as_of is None else F.lit(as_of)
    return df.where(F.col("timestamp") >= ref - F.lit(days * 86400))


def reset_table(spark: SparkSession, path: str) -> None:
    """Delete every row of the table; it stays a readable, empty table."""
    ensure_schema_file(spark, path)
    with rows_changed(spark, path, lambda: table_days(spark, path)):
        for day in table_days(spark, path):
            delete(spark, f"{path}/dt={day}")


#: Greatest and least event time that a day folder can be named for: years 1 to 9999.
MAX_TIMESTAMP, MIN_TIMESTAMP = 253402300799, -62135596800
REFUSALS = ("undecodable", "time_range", "text_nul")
TEXT_COLUMNS = [f.name for f in PROCESSED_SCHEMA.fields if f.dataType.simpleString() == "string"]


def refusal_reason(columns: list[str], undecodable: Column | None = None) -> Column:
    """Why the table refuses a record with these columns (null: it does not), in order of precedence.

    undecodable: the message is no JSON object; time_range: no day folder can be named for the
    event time; text_nul: a NUL character, which text columns of databases do not hold.
    """
    nul = F.lit(False)
    for c in (c for c in TEXT_COLUMNS if c in columns):
        nul = nul | F.coalesce(F.contains(F.col(c), F.lit("\x00")), F.lit(False))
    out_of_range = ~F.col("timestamp").between(MIN_TIMESTAMP, MAX_TIMESTAMP)
    return (F.when(F.lit(False) if undecodable is None else undecodable, "undecodable").when(sinkable_condition() & out_of_range, "time_range")
            .when(sinkable_condition() & nul, "text_nul"))


def judged_records(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages -> record columns, the message itself, its outcome and the reason of an error.

    outcome: success, skipped (guarded away: no aircraft or time) or error (the write refuses it).
    """
    value = F.col(value_col).cast("string")
    parsed = df.select(value.alias("message"), F.from_json(value, PROCESSED_SCHEMA).alias("r"),
                       F.coalesce(~F.trim(value).rlike(r"(?s)^\{.*\}$") | F.try_parse_json(value).isNull(), F.lit(True)).alias("undecodable"))
    judged = parsed.select("message", "undecodable", "r.*").withColumn("reason", refusal_reason(PROCESSED_COLUMNS, F.col("undecodable"))).drop("undecodable")
    ok = F.coalesce(sinkable_condition(), F.lit(False))
    return judged.withColumn("outcome", F.when(F.col("reason").isNotNull(), "error").when(ok, "success").otherwise("skipped"))


def write_dead_letters(judged: DataFrame, path: str, batch_id: str) -> None:
    """Store refused messages with their reason; the same batch id replaces its own letters."""
    letters = judged.where("outcome = 'error'").select("reason", "message", F.lit(batch_id).alias("batch"))
    (letters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


DEAD_LETTER_SCHEMA = "reason string, message string, batch string"


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The stored letters; a sink that never refused a row has none."""
    if not any(f.startswith("batch=") for f in folders(spark, path)):
        return spark.createDataFrame([], DEAD_LETTER_SCHEMA)
    return spark.read.schema(DEAD_LETTER_SCHEMA).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None,
                batch_size: int = 10_000, max_connections: int | None = None) -> None:
    """Append guarded rows to a JDBC table (one transaction per task partition).

    ``max_connections`` coalesces the frame so at most that many tasks write
    concurrently; the database, not Spark, is the bottleneck of this sink.
    """
    out = filter_sinkable(df).select(*PROCESSED_COLUMNS).withColumn("created_at",
                                                                    F.current_timestamp())
    if max_connections:
        out = out.coalesce(max_connections)
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size),
            "isolationLevel": "READ_COMMITTED"}
    if driver:
        opts["driver"] = driver
    out.write.format("jdbc").options(**opts).mode("append").save()


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Scan a JDBC table; with a numeric partition column the read is split in ranges."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if driver:
        r = r.option("driver", driver)
    if partition_column and num_partitions:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    return r.load()
