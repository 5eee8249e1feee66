"""Stateful streaming operators and their stream-equals-batch harness.

Inputs are landed as time-ordered chunks and every chunk is one micro-batch, however
many files it was written as: the query runs on its checkpoint under
``availableNow`` each time a chunk has landed, so its state is carried from chunk
to chunk and no row of a chunk can be late against the chunk's own watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flight_engine.files import delete
from flight_engine.functions.columns import event_time
from flight_engine.functions.geo import grid_cell
from flight_engine.operators.anomalies import DESCENT_RATE, DESCENT_TICKS, LATEST_TTL_S
from flight_engine.session import scratch_path
from flight_engine.streaming.pipeline import (
    read_upserts, run_until_caught_up, stream_to_parquet, stream_upserts,
)

WATERMARK = "10 minutes"
#: Silence after which a run of descending fixes is forgotten (the retention of the table).
IDLE_TIMEOUT_MS = 7 * 86400 * 1000


def run_in_chunks(spark: SparkSession, df: DataFrame, name: str,
                  start: Callable[[DataFrame], StreamingQuery], chunks: int = 4) -> None:
    """Feed ``df`` to a streaming query, one micro-batch for each of ``chunks`` spans of time.

    ``df`` is derived and written once, by chunk; each chunk is then landed in the
    source folder and the query started on what is new.
    """
    staged, source = scratch_path(spark, f"{name}-staged"), scratch_path(spark, f"{name}-src")
    bounds = df.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    span = bounds.select(F.struct("lo", ((F.col("hi") - F.col("lo")) / chunks + 1).cast("bigint").alias("step")).alias("s"))
    lo_step = span.scalar()
    chunk = ((F.col("timestamp") - lo_step["lo"]) / lo_step["step"]).cast("int")
    df.where(F.col("timestamp").isNotNull()).withColumn("chunk", chunk).write.partitionBy("chunk").parquet(staged)
    df.limit(0).coalesce(1).write.parquet(source)
    for i in range(chunks):
        part = spark.read.schema(f"chunk int, {_ddl(df)}").parquet(staged).where(F.col("chunk") == i).drop("chunk")
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source).withColumn("event_time", event_time())
        run_until_caught_up(start(stream))
    delete(spark, staged)
    delete(spark, source)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


# ---- continuous aggregate --------------------------------------------------

def continuous_hourly(spark: SparkSession, states: DataFrame) -> DataFrame:
    """Hourly (window, country) aggregates maintained incrementally; merged on read."""
    from flight_engine.operators.transform import process
    out, ck = scratch_path(spark, "cagg"), scratch_path(spark, "cagg-ck")

    def start(stream: DataFrame) -> StreamingQuery:
        agg = (process(stream).withWatermark("event_time", WATERMARK)
               .groupBy(F.window("event_time", "1 hour").alias("w"), "origin_country")
               .agg(F.count(F.lit(1)).alias("states"), F.sum("velocity_kmh").alias("kmh_sum"),
                    F.count("velocity_kmh").alias("kmh_n"))
               .select(F.unix_seconds(F.col("w.start")).alias("hour_start"), "origin_country",
                       "states", "kmh_sum", "kmh_n"))
        return stream_upserts(agg, out, ck)

    run_in_chunks(spark, states, "cagg", start)
    r = read_upserts(spark, out, ["hour_start", "origin_country"])
    return r.select("hour_start", "origin_country", "states",
                    F.round(F.col("kmh_sum") / F.col("kmh_n"), 6).alias("avg_velocity_kmh"))


# ---- dedup ------------------------------------------------------------------

def dedup_stream(spark: SparkSession, states: DataFrame) -> DataFrame:
    """Latest last_contact per (icao24, timestamp); state expires behind the watermark."""
    cols = [c for c in states.columns if c not in ("icao24", "timestamp")]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]),
                    F.struct(F.col("last_contact"), F.col("time_position")))
    out, ck = scratch_path(spark, "dedup"), scratch_path(spark, "dedup-ck")

    def start(stream: DataFrame) -> StreamingQuery:
        agg = (stream.withWatermark("event_time", WATERMARK)
               .groupBy("icao24", "timestamp", "event_time").agg(best.alias("r"))
               .select("icao24", "timestamp", *[F.col(f"r.{c}").alias(c) for c in cols]))
        return stream_upserts(agg, out, ck)

    run_in_chunks(spark, states, "dedup", start)
    return read_upserts(spark, out, ["icao24", "timestamp"]).select(*states.columns)


# ---- latest state -------------------------------------------------------------

def latest_state_stream(spark: SparkSession, history: DataFrame,
                        ttl_s: int = LATEST_TTL_S) -> DataFrame:
    """Newest row per aircraft kept as streaming aggregate state; TTL applied on read."""
    cols = [c for c in history.columns if c != "icao24"]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]),
                    F.struct(F.col("timestamp"), F.col("time_position")))
    out, ck = scratch_path(spark, "latest"), scratch_path(spark, "latest-ck")

    def start(stream: DataFrame) -> StreamingQuery:
        agg = (stream.groupBy("icao24").agg(best.alias("r"))
               .select("icao24", *[F.col(f"r.{c}").alias(c) for c in cols]))
        return stream_upserts(agg, out, ck)

    run_in_chunks(spark, history, "latest", start)
    latest = read_upserts(spark, out, ["icao24"]).select(*history.columns)
    ref = latest.select(F.max("timestamp")).scalar()
    return latest.where(F.col("timestamp") >= ref - F.lit(ttl_s))


# ---- congestion -----------------------------------------------------------------

def congestion_stream(spark: SparkSession, history: DataFrame, deg: float = 0.5,
                      min_aircraft: int = 3) -> DataFrame:
    """(minute, cell) counts of distinct aircraft, exact.

    The state is one row per (minute, cell, aircraft) within the watermark, so a
    crowded cell is spread over its aircraft; the read-back counts them.
    """
    out, ck = scratch_path(spark, "cong"), scratch_path(spark, "cong-ck")

    def start(stream: DataFrame) -> StreamingQuery:
        agg = (stream.withWatermark("event_time", WATERMARK)
               .groupBy(F.window("event_time", "1 minute").alias("w"), grid_cell(deg=deg).alias("cell"), "icao24")
               .agg(F.count(F.lit(1)).alias("states"))
               .select(F.unix_seconds(F.col("w.start")).alias("window_start"), "cell", "icao24", "states"))
        return stream_upserts(agg, out, ck)

    run_in_chunks(spark, history, "cong", start)
    return (read_upserts(spark, out, ["window_start", "cell", "icao24"])
            .groupBy("window_start", "cell").agg(F.count("icao24").alias("aircraft"))
            .where(F.col("aircraft") >= min_aircraft))


# ---- trajectories -----------------------------------------------------------------

def trajectory_stream(spark: SparkSession, history: DataFrame, minutes: int = 5) -> DataFrame:
    """Tracks of ``trajectory_window``, from one fix per aircraft and second kept as stream state.

    The state value is one position, whatever an aircraft sends; tracks are put
    together on read, at most 60 * ``minutes`` points each.
    """
    from flight_engine.operators.warehouse import tracks
    out, ck = scratch_path(spark, "traj"), scratch_path(spark, "traj-ck")

    def start(stream: DataFrame) -> StreamingQuery:
        agg = (stream.withWatermark("event_time", WATERMARK)
               .groupBy("icao24", "timestamp", "event_time")
               .agg(F.max_by(F.struct("longitude", "latitude"), F.col("time_position")).alias("p"))
               .select("icao24", "timestamp", "p.longitude", "p.latitude"))
        return stream_upserts(agg, out, ck)

    run_in_chunks(spark, history, "traj", start)
    return tracks(read_upserts(spark, out, ["icao24", "timestamp"]), minutes)


# ---- emergency descent (custom state) -----------------------------------------

DESCENT_OUT = ("icao24 string, start_timestamp bigint, timestamp bigint, longitude double, "
               "latitude double, vertical_rate double")
DESCENT_STATE = "icao24 array<string>, run array<long>, run_start array<long>, last_ts array<long>, last_tp array<long>"
#: Groups that aircraft are dealt into for custom state. An address has 24 bits, so that a group
#: holds some 16,384 aircraft at most; a call of Python handles a group's rows at once, not one aircraft's.
BUCKETS = 1024
NO_TIME = -(1 << 53)
#: Earlier than any fix.
NEVER = np.iinfo("int64").min


def bucket() -> Column:
    """The group of aircraft that a row's state is kept with."""
    return F.pmod(F.xxhash64("icao24"), F.lit(BUCKETS)).cast("int")


def _timeout(state: GroupState, at_ms: int) -> None:
    """Event-time timeout, never behind the watermark."""
    state.setTimeoutTimestamp(max(at_ms, state.getCurrentWatermarkMs() + 1))


def _times(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(timestamp, time_position); a null position time counts as the earliest."""
    return pdf["timestamp"].to_numpy("int64"), pdf["time_position"].fillna(NO_TIME).to_numpy("int64")


def places(aircraft: pd.Series, known: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each row's aircraft, the aircraft by number, their places in ``known``, -1 if not there)."""
    code, names = pd.factorize(aircraft.astype(object), use_na_sentinel=False)
    return code, names, pd.Index(known, dtype=object).get_indexer(names)


def known_of(values: list, at: np.ndarray, absent) -> np.ndarray:
    """A value of each aircraft's state by ``places``, or ``absent``."""
    return np.array([*values, absent], dtype=np.asarray(absent).dtype)[at]


def behind(ts: np.ndarray, tp: np.ndarray, last_ts: np.ndarray, last_tp: np.ndarray) -> np.ndarray:
    """Whether (ts, tp) is before (last_ts, last_tp)."""
    return (ts < last_ts) | ((ts == last_ts) & (tp < last_tp))


def first_rows(code: np.ndarray) -> np.ndarray:
    """The place of the first row of each row's aircraft, in rows ordered by aircraft."""
    starts = np.concatenate(([True], code[1:] != code[:-1])) if len(code) else np.zeros(0, dtype=bool)
    return np.maximum.accumulate(np.where(starts, np.arange(len(code)), 0)) if len(code) else np.zeros(0, dtype="int64")


def last_rows(code: np.ndarray) -> np.ndarray:
    """Places of the last row of each aircraft, in rows ordered by aircraft."""
    return np.flatnonzero(np.concatenate((code[1:] != code[:-1], [True]))) if len(code) else np.zeros(0, dtype="int64")


def run_lengths(falling: np.ndarray, first: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length of the run of falling rows that ends in each row, place of the last row before it that is not falling).

    Rows are ordered by aircraft and time; ``run`` is the length that the aircraft's run had before
    its first row here. A place before ``first`` means that the run goes back to the state.
    """
    at = np.arange(len(falling))
    broken = np.maximum(np.maximum.accumulate(np.where(falling, -1, at)) if len(at) else at, first - 1)
    return np.where(falling, at - broken + np.where(broken < first, run, 0), 0), broken


def _descent_fn(rate: float, ticks: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = [list(x) for x in state.get] if state.exists else [[], [], [], [], []]
        watermark = state.getCurrentWatermarkMs()
        due = np.array(known[3], dtype="int64") * 1000 + IDLE_TIMEOUT_MS
        stay = due >= watermark  # aircraft that were silent for longer are forgotten, unless they have rows now
        if not state.hasTimedOut:
            # the rows of a micro-batch come as any number of Arrow batches in any order
            pdf = pd.concat(list(pdfs), ignore_index=True)
            code, names, at = places(pdf["icao24"], known[0])
            ts, tp = _times(pdf)
            order = np.lexsort((tp, ts, code))
            pdf, code, ts, tp = pdf.iloc[order], code[order], ts[order], tp[order]
            last_ts, last_tp = known_of(known[3], at, NEVER)[code], known_of(known[4], at, NEVER)[code]
            new = ~behind(ts, tp, last_ts, last_tp) & ((ts != last_ts) | (tp != last_tp))  # neither late nor replayed
            stay[at[at >= 0]] = True
            pdf, code, ts, tp = pdf[new], code[new], ts[new], tp[new]
            falling = pdf["vertical_rate"].to_numpy("float64", na_value=np.nan) < rate
            first, run = first_rows(code), known_of(known[1], at, 0)[code]
            length, broken = run_lengths(falling, first, run)
            start = np.where((broken < first) & (run > 0), known_of(known[2], at, 0)[code], ts[np.minimum(broken + 1, len(ts) - 1)])
            hit, found = falling & (length == ticks), pdf
            last = last_rows(code)
            changed = at[code[last]]
            stay[changed[changed >= 0]] = False
            made = [names[code[last]], length[last], start[last], ts[last], tp[last]]
        else:
            made, hit = [np.zeros(0, dtype="int64")] * 5, np.zeros(0, dtype=bool)
        known = [[x for x, s in zip(old, stay) if s] + np.asarray(now).tolist() for old, now in zip(known, made)]
        if known[0]:
            state.update(tuple(known))
            _timeout(state, min(known[3]) * 1000 + IDLE_TIMEOUT_MS)
        else:
            state.remove()
        if hit.any():
            found = found[hit]
            yield pd.DataFrame({"icao24": found["icao24"].to_numpy(), "start_timestamp": start[hit], "timestamp": ts[hit],
                                "longitude": found["longitude"].to_numpy(), "latitude": found["latitude"].to_numpy(),
                                "vertical_rate": found["vertical_rate"].to_numpy()})
    return fn


def descent_stream(spark: SparkSession, history: DataFrame, rate: float = DESCENT_RATE,
                   ticks: int = DESCENT_TICKS) -> DataFrame:
    """Runs of ``ticks`` descending fixes per aircraft, counted across micro-batches."""
    out, ck = scratch_path(spark, "descent"), scratch_path(spark, "descent-ck")

    def start(stream: DataFrame) -> StreamingQuery:
        events = (stream.withWatermark("event_time", WATERMARK).withColumn("bucket", bucket()).groupBy("bucket")
                  .applyInPandasWithState(_descent_fn(rate, ticks), DESCENT_OUT, DESCENT_STATE,
                                          "append", GroupStateTimeout.EventTimeTimeout))
        return stream_to_parquet(events, out, ck)

    cols = ["icao24", "timestamp", "time_position", "longitude", "latitude", "vertical_rate"]
    run_in_chunks(spark, history.select(*cols), "descent", start)
    return spark.read.schema(DESCENT_OUT).parquet(out)


# ---- latest state with TTL eviction (custom state) ----------------------------------

LATEST_STATE = "icao24 array<string>, last_ts array<long>, last_tp array<long>"


def _latest_ttl_fn(columns: list[str], ttl_s: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = [list(x) for x in state.get] if state.exists else [[], [], []]
        gone = (np.array(known[1], dtype="int64") + ttl_s) * 1000 < state.getCurrentWatermarkMs()
        stay, made = ~gone, [np.zeros(0, dtype="int64")] * 3
        if not state.hasTimedOut:
            pdf = pd.concat(list(pdfs), ignore_index=True)
            code, names, at = places(pdf["icao24"], known[0])
            ts, tp = _times(pdf)
            order = np.lexsort((tp, ts, code))
            order = order[last_rows(code[order])]
            code, ts, tp = code[order], ts[order], tp[order]
            last_ts, last_tp = known_of(known[1], at, NEVER)[code], known_of(known[2], at, NEVER)[code]
            newer = behind(last_ts, last_tp, ts, tp)
            gone[at[at >= 0]] = False  # heard of in this batch: looked at again in the next
            stay = ~gone
            changed = at[code[newer]]
            stay[changed[changed >= 0]] = False
            made = [names[code[newer]], ts[newer], tp[newer]]
            if newer.any():
                yield pdf.iloc[order[newer]][columns].assign(evicted=False)
        if gone.any():
            # silent longer than the TTL behind the watermark: evict, emit tombstones
            rows = pd.DataFrame({"icao24": np.array(known[0], dtype=object)[gone], "timestamp": np.array(known[1], dtype="int64")[gone]})
            yield rows.reindex(columns=columns).astype({c: object for c in columns if c != "timestamp"}).assign(evicted=True)
        known = [[x for x, s in zip(old, stay) if s] + np.asarray(now).tolist() for old, now in zip(known, made)]
        if known[0]:
            state.update(tuple(known))
            _timeout(state, (min(known[1]) + ttl_s) * 1000)
        else:
            state.remove()
    return fn


def latest_state_ttl_stream(spark: SparkSession, history: DataFrame,
                            ttl_s: int = LATEST_TTL_S) -> DataFrame:
    """Newest row per aircraft whose state is evicted ``ttl_s`` after it goes silent.

    State is one (timestamp, time_position) pair per *active* aircraft, kept by ``bucket``: the
    event-time timeout fires when the watermark passes the earliest last-seen + TTL, silent
    aircraft are removed and their tombstones emitted.  The read-back keeps each
    aircraft's last emitted version unless it is a tombstone, then applies the
    TTL against the newest fix (as the batch ``latest_state`` does).
    """
    columns = list(history.columns)
    out_schema = f"{_ddl(history)}, evicted boolean"
    out, ck = scratch_path(spark, "latest-ttl"), scratch_path(spark, "latest-ttl-ck")

    def start(stream: DataFrame) -> StreamingQuery:
        upd = (stream.withWatermark("event_time", WATERMARK).withColumn("bucket", bucket()).groupBy("bucket")
               .applyInPandasWithState(_latest_ttl_fn(columns, ttl_s), out_schema, LATEST_STATE, "update",
                                       GroupStateTimeout.EventTimeTimeout))
        return stream_upserts(upd, out, ck)

    run_in_chunks(spark, history, "latest-ttl", start)
    return latest_from_upserts(spark, out, columns, ttl_s)


def latest_from_upserts(spark: SparkSession, out: str, columns: list[str],
                        ttl_s: int = LATEST_TTL_S) -> DataFrame:
    last = read_upserts(spark, out, ["icao24"])
    live = last.where(~F.col("evicted")).select(*columns)
    ref = live.select(F.max("timestamp")).scalar()
    return live.where(F.col("timestamp") >= ref - F.lit(ttl_s))
