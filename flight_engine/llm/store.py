"""Intermediate tables in the shared folder, and freeing what is done with."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from flight_engine.files import delete
from flight_engine.session import scratch_path

#: Folders written in the pipeline stage that ran last, by application.
_STAGE_TABLES: dict[str, list[str]] = {}
_RECORDING: set[str] = set()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage and survives lost executors: the files are in the folder
    that the cluster names in spark.checkpoint.dir.
    """
    spark = df.sparkSession
    path, app = scratch_path(spark, name), spark.sparkContext.applicationId
    if app in _RECORDING:
        _STAGE_TABLES[app].append(path)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished phases now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def pipeline_stage(spark: SparkSession) -> Iterator[None]:
    """Free the tables and shuffles of the pipeline stage before, and note those of this one.

    A stage starts when the rows of the one before are written and read again, so nothing
    reads that one's intermediate tables any more. Tables of queries outside are never touched.
    """
    app = spark.sparkContext.applicationId
    for path in _STAGE_TABLES.get(app, []):
        delete(spark, path)
    _STAGE_TABLES[app] = []
    release(spark)
    _RECORDING.add(app)
    try:
        yield
    finally:
        _RECORDING.discard(app)


#: Texts a batch between Spark and Python holds at most.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def lean_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batches to ``rows``, a memory setting without effect on results.

    Rows that hold whole texts are wide: a batch of the usual 10,000 takes tens of
    MB four times over, in the executor's buffers and in its Python workers.
    """
    now = int(spark.conf.get(_BATCH))
    if now <= 0 or now > rows:
        spark.conf.set(_BATCH, rows)
