"""Newest rows of a stored table, kept beside it so that a page needs no scan.

Each written batch leaves its newest KEPT rows in ``_newest/<batch>`` (Spark passes
over such folders when it reads the table). A page is the top of these small files.
Over MAX_SIDECARS of them are folded into one. What changes other rows of the
table (retention, reset, merge, compaction) drops the folder first and makes it anew
at its end; without a fold, which a whole folder always has, a page comes from the
table. A batch that is being written, or whose writer died, is named by a marker and
read from its own files.
"""

from __future__ import annotations

import contextlib
import datetime
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flight_engine.files import create_new, delete, exists, names, rename
from flight_engine.schema import API_COLUMNS, PROCESSED_SCHEMA

#: Rows kept of each batch: the greatest page.
KEPT = 500
MAX_SIDECARS = 16
#: Columns of a page and of its order, and the batch that a row is from.
COLUMNS = [*dict.fromkeys([*API_COLUMNS, "timestamp", "icao24", "time_position"])]
FOLDER, FOLD, PENDING, LOCK = "_newest", "fold-", "_pending-", "_folding"
#: Marker in place of the fold of a table without rows; any other fold comes after it.
EMPTY = FOLD + "00000000"


def newest_first():
    """Deterministic newest-first order (snapshot rows share a timestamp)."""
    return [F.col("timestamp").desc(), F.col("icao24").asc(), F.col("time_position").desc()]


def newest_window(spark: SparkSession, path: str, days: list[str], n: int, lookback_s: int = 3600) -> DataFrame:
    """Rows of the table that hold its newest ``n``, from as few days as that takes.

    ``days`` are the table's day folders. The newest timestamp is read from the newest day
    only, the rows from ``timestamp >= newest - lookback``: a literal predicate, so it
    prunes ``dt`` partitions and skips row groups by their min/max. If that
    window holds fewer rows than asked for, the lookback grows 4x per round;
    once it reaches the oldest partition the bound is dropped.
    """
    table = spark.read.parquet(path)
    if not days:
        return table
    newest = table.where(F.col("dt") == days[-1]).agg(F.max("timestamp")).first()[0]
    span = lookback_s
    while newest is not None:
        lo = newest - span
        if lo < -62135596800:
            break
        day = (datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=lo)).strftime("%Y-%m-%d").rjust(10, "0")
        if day <= days[0]:
            break
        window = table.where((F.col("dt") >= day) & (F.col("timestamp") >= F.lit(lo)))
        if window.limit(n).count() >= n:
            return window
        span *= 4
    return table


def _name(spark: SparkSession, batch: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch)


_TYPES = {f.name: f.dataType.simpleString() for f in PROCESSED_SCHEMA.fields}
STORED = ", ".join(f"`{c}` {_TYPES[c]}" for c in COLUMNS)
KEPT_SCHEMA = f"{STORED}, batch string"


def _batch_rows(spark: SparkSession, path: str, days: list[str], name: str) -> DataFrame | None:
    """Rows of a batch's newest days, KEPT or more where it has so many."""
    parts, found, read = [], 0, spark.read.schema(STORED)
    for day in reversed(days):
        part = f"{path}/dt={day}/batch={name}"
        if exists(spark, part):
            parts.append(part)
            found += read.parquet(part).count()
            if found >= KEPT:
                break
    if not found:
        return None
    return read.parquet(*parts).withColumn("batch", F.lit(name))


def _last_fold(entries: list[str]) -> list[str]:
    return [e for e in sorted(entries) if e.startswith(FOLD) and e != EMPTY][-1:]


def _kept(spark: SparkSession, path: str, entries: list[str], days: list[str] | None) -> DataFrame | None:
    """All rows kept under ``entries`` of the folder, each batch once, and pending batches' own."""
    own = [e for e in entries if not e.startswith((FOLD, "_", "."))]
    folds = _last_fold(entries)
    pending = [e[len(PENDING):] for e in entries if e.startswith(PENDING)] if days is not None else []
    read = spark.read.schema(KEPT_SCHEMA)
    parts = [read.parquet(*[f"{path}/{FOLDER}/{e}" for e in own if e not in pending])] if set(own) - set(pending) else []
    if folds:
        fold = read.parquet(f"{path}/{FOLDER}/{folds[0]}")
        again = sorted(set(own) | set(pending))
        parts.append(fold.where(~F.col("batch").isin(again)) if again else fold)
    parts += [r for name in pending if (r := _batch_rows(spark, path, days, name)) is not None]
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def kept_rows(spark: SparkSession, path: str, list_days) -> DataFrame | None:
    """Rows that hold the newest KEPT ones of the table; None where they are not kept.

    ``list_days`` gives the table's days and is called only if a batch is pending.
    """
    entries = names(spark, f"{path}/{FOLDER}")
    if not any(e.startswith(FOLD) for e in entries):
        return None
    return _kept(spark, path, entries, list_days() if any(e.startswith(PENDING) for e in entries) else [])


def rebuild(spark: SparkSession, path: str, days: list[str]) -> None:
    """Keep the newest rows of the whole table anew (an empty fold where it has none)."""
    delete(spark, f"{path}/{FOLDER}")
    if days:
        rows = newest_window(spark, path, days, KEPT).select(*COLUMNS, F.col("batch").cast("string").alias("batch"))
        _write(spark, rows, f"{path}/{FOLDER}", f"{FOLD}{0:08d}-{uuid.uuid4().hex[:8]}")
    else:
        create_new(spark, f"{path}/{FOLDER}/{EMPTY}")


def _write(spark: SparkSession, rows: DataFrame, folder: str, name: str) -> bool:
    """Write under a hidden name and rename, so that a reader meets whole files only.

    False if the folder was dropped meanwhile by a change of the table.
    """
    hidden = f"{folder}/_writing-{uuid.uuid4().hex[:8]}"
    rows.orderBy(*newest_first()).limit(KEPT).coalesce(1).write.parquet(hidden)
    delete(spark, f"{folder}/{name}")
    return rename(spark, hidden, f"{folder}/{name}")


def fold(spark: SparkSession, path: str) -> None:
    """Put all kept rows in one file of KEPT rows; one caller at a time, others leave it."""
    folder = f"{path}/{FOLDER}"
    if not create_new(spark, f"{folder}/{LOCK}"):
        return
    try:
        entries = names(spark, folder)
        pending = {e[len(PENDING):] for e in entries if e.startswith(PENDING)}
        done = [e for e in entries if not e.startswith(("_", ".")) and e not in pending]
        rows = _kept(spark, path, done, None)
        if rows is not None:
            last = max((int(e.split("-")[1]) for e in done if e.startswith(FOLD) and e != EMPTY), default=0)
            if _write(spark, rows, folder, f"{FOLD}{last + 1:08d}-{uuid.uuid4().hex[:8]}"):
                for e in done:
                    delete(spark, f"{folder}/{e}")
    finally:
        delete(spark, f"{folder}/{LOCK}")


@contextlib.contextmanager
def batch_written(spark: SparkSession, path: str, batch: str, list_days) -> Iterator[None]:
    """Around the write of a batch: its newest rows are kept when it ends."""
    name, folder = _name(spark, batch), f"{path}/{FOLDER}"
    entries = names(spark, folder)
    if not any(e.startswith(FOLD) for e in entries):
        rebuild(spark, path, list_days())
        entries = names(spark, folder)
    folds = _last_fold(entries)
    # a replayed batch whose rows were folded may have pushed out others' rows
    folded = bool(folds) and not spark.read.schema(KEPT_SCHEMA).parquet(f"{folder}/{folds[0]}").where(F.col("batch") == name).isEmpty()
    create_new(spark, f"{folder}/{PENDING}{name}")
    yield
    days = list_days()
    if folded:
        rebuild(spark, path, days)
        return
    rows = _batch_rows(spark, path, days, name)
    if rows is not None and not _write(spark, rows, folder, name):
        rebuild(spark, path, days)
    delete(spark, f"{folder}/{PENDING}{name}")
    if sum(not e.startswith("_") for e in entries) >= MAX_SIDECARS:
        fold(spark, path)


@contextlib.contextmanager
def rows_changed(spark: SparkSession, path: str, list_days) -> Iterator[None]:
    """Around a change of rows already in the table: what is kept goes first and is made anew after."""
    had = delete(spark, f"{path}/{FOLDER}")
    yield
    if had:
        rebuild(spark, path, list_days())
