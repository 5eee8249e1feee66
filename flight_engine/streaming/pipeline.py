"""Streaming jobs: raw topic -> transform -> processed topic -> table.

Kafka is the production transport (``kafka_source`` / ``kafka_sink``); the
file formats with the same ``(key, value)`` envelope are the test twins.
Every query has a checkpoint under the shared checkpoint root, so a lost
executor or a restarted driver resumes from the last committed offsets.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flight_engine.files import read_text, write_text
from flight_engine.operators.sink import (
    REFUSALS, append_batch, judged_records, normalize_record, sinkable_condition, write_dead_letters,
)
from flight_engine.operators.transform import process_raw, serialize_keyed, serialize_unkeyed
from flight_engine.schema import ENVELOPE_SCHEMA


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """Subscribe to a topic; ``value`` as string (needs the Kafka connector jar)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def kafka_read_bounded(spark: SparkSession, servers: str, topic: str, n: int) -> DataFrame:
    """Batch read from the earliest offsets, first ``n`` messages by (partition, offset)."""
    df = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic).option("startingOffsets", "earliest")
          .option("endingOffsets", "latest").load())
    return (df.orderBy("partition", "offset").limit(n)
            .select(F.col("key").cast("string"), F.col("value").cast("string")))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint)
            .outputMode("append").start())


def file_source(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """File twin of a topic: ``text`` (value per line) or ``json``/``parquet`` envelopes."""
    if fmt == "text":
        return spark.readStream.format("text").load(path)
    return spark.readStream.schema(ENVELOPE_SCHEMA).format(fmt).load(path)


def write_messages(df: DataFrame, path: str, keyed: bool = False, fmt: str = "json") -> None:
    """Land messages (batch) in a topic's file twin."""
    out = serialize_keyed(df) if keyed else serialize_unkeyed(df).withColumn(
        "key", F.lit(None).cast("string")).select("key", "value")
    out.write.mode("append").format(fmt).save(path)


def run_until_caught_up(q: StreamingQuery) -> StreamingQuery:
    """Wait, as long as it takes, until an availableNow query has read all there was."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def stream_transform(source: DataFrame, out_path: str, checkpoint: str,
                     available_now: bool = True, fmt: str = "json") -> StreamingQuery:
    """Raw envelopes -> processed keyed envelopes (append, checkpointed)."""
    w = (serialize_keyed(process_raw(source)).writeStream.format(fmt)
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


SINK_METRICS = "sink_counters"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name of the stream that lives and dies with its checkpoint folder.

    Batch numbers start at 0 again under a new checkpoint; with this name beside
    them, a replayed batch still replaces itself and never another stream's rows.
    """
    path = f"{checkpoint.rstrip('/')}/sink_stream_id"
    found = read_text(spark, path)
    if found is None:
        found = uuid.uuid4().hex[:12]
        write_text(spark, path, found)
    return found


def stream_sink_table(source: DataFrame, table_path: str, checkpoint: str,
                      available_now: bool = True) -> StreamingQuery:
    """Processed envelopes -> guarded, idempotent appends to the history table.

    Insert outcome counters (consumed / success / skipped) are computed in
    the same pass with ``DataFrame.observe`` and reported in each batch's
    progress under ``sink_counters``.
    """
    ok = sinkable_condition()
    stream = stream_id(source.sparkSession, checkpoint)
    rows = normalize_record(source).observe(
        SINK_METRICS, F.count(F.lit(1)).alias("consumed"),
        F.count(F.when(ok, 1)).alias("success"),
        F.count(F.when(~ok, 1)).alias("skipped"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, table_path, f"{stream}-{batch_id}")
    w = (rows.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stream_sink_checked(source: DataFrame, table_path: str, dead_path: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """``stream_sink_table`` with a dead-letter store: rows that the table refuses go there with a reason.

    Outcomes are counted in the same pass, also by reason, under ``sink_counters``. Both writes of a
    batch replace their own earlier try, so a replayed batch is stored and counted once.
    """
    stream = stream_id(source.sparkSession, checkpoint)
    kinds = [F.count(F.when(F.col("outcome") == o, 1)).alias(o) for o in ("success", "skipped", "error")]
    reasons = [F.count(F.when(F.col("reason") == r, 1)).alias(f"error_{r}") for r in REFUSALS]
    rows = judged_records(source).observe(SINK_METRICS, F.count(F.lit(1)).alias("consumed"), *kinds, *reasons)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # two writes of one batch; whoever loses a block reads the batch's source again
        append_batch(batch.where("outcome = 'success'"), table_path, f"{stream}-{batch_id}")
        write_dead_letters(batch, dead_path, f"{stream}-{batch_id}")
        batch.unpersist()
    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stream_to_parquet(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append",
                      available_now: bool = True) -> StreamingQuery:
    w = (df.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode(mode))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def stream_upserts(df: DataFrame, out_path: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Update-mode aggregate -> per-batch files tagged with batch id (merge on read)."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(int(batch_id))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out_path))
    w = (df.writeStream.outputMode("update").foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_upserts(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Latest emitted version of every key (max batch id wins)."""
    df = spark.read.parquet(path)
    cols = [c for c in df.columns if c not in keys and c != "batch"]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("batch"))
    return (df.groupBy(*keys).agg(best.alias("r"))
            .select(*keys, *[F.col(f"r.{c}").alias(c) for c in cols]))


class ProgressLog(StreamingQueryListener):
    """Keeps every progress event of the queries it watches (one per micro-batch)."""

    def __init__(self):
        self.events: list[dict] = []
        self.ended: set[str] = set()

    def onQueryStarted(self, event):  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        self.events.append(json.loads(event.progress.json))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.ended.add(str(event.runId))


def run_logged(spark: SparkSession, start) -> list[dict]:
    """Start a query with a progress listener attached; return its progress events.

    Listener events arrive in order on one bus, so once the end of the run has been
    reported, all its batches have; a run that found nothing new reports no batch.
    """
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        q = start()
        run_until_caught_up(q)
        until = time.monotonic() + 60
        while str(q.runId) not in log.ended and time.monotonic() < until:
            time.sleep(0.1)
        return [e for e in log.events if e["id"] == str(q.id)]
    finally:
        spark.streams.removeListener(log)


def progress_table(spark: SparkSession, events: list[dict]) -> DataFrame:
    """Per-batch progress as rows: batch id, input rows, rates and durations."""
    rows = [(int(e["batchId"]), int(e["numInputRows"]),
             float(e.get("inputRowsPerSecond") or 0.0), float(e.get("processedRowsPerSecond") or 0.0),
             int(e["durationMs"].get("triggerExecution", 0)), json.dumps(e.get("observedMetrics", {})))
            for e in events]
    return spark.createDataFrame(rows, "batch_id bigint, input_rows bigint, input_rows_per_s double, "
                                       "processed_rows_per_s double, trigger_ms bigint, "
                                       "observed string")
