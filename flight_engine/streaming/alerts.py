"""The alerts topic as a stream: all four rules over typed state, by bucket of aircraft.

The state processor is the stream's ``with_previous``: it joins each fix to the fix before it
and counts the descending run, across micro-batches and restarts. The rules themselves are the
batch ones (``anomalies.alert_rows``), so batch and stream cannot drift apart.

Late rows: a fix that is older than the aircraft's newest one, but not behind the watermark, is
judged by the rules on single rows; it has no place in the sequence any more, whose alerts are
out. A replayed row (equal in every column that the rules read) within the watermark is
passed over, so an alert is published once. Behind the watermark Spark drops rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from flight_engine.operators.anomalies import ALERT_INPUT, DESCENT_RATE, DESCENT_TICKS, alert_rows
from flight_engine.operators.transform import serialize_keyed
from flight_engine.schema import ALERT_SCHEMA, ENVELOPE_SCHEMA
from flight_engine.session import ROCKSDB, STATE_STORE, scratch_path
from flight_engine.streaming.stateful import (
    IDLE_TIMEOUT_MS, NEVER, NO_TIME, WATERMARK, behind, bucket, first_rows, known_of, last_rows, places, run_in_chunks, run_lengths,
)

#: Watermark delay in ms: rows seen within it are remembered, twice over for the batch in between.
HORIZON_MS = 10 * 60 * 1000
FIX_COLUMNS = ["icao24", "timestamp", "time_position", "longitude", "latitude", "vertical_rate", "callsign", "velocity_kmh"]
FIX_OUT = ("icao24 string, timestamp bigint, longitude double, latitude double, vertical_rate double, callsign string, "
           "velocity_kmh double, prev1_timestamp bigint, prev1_longitude double, prev1_latitude double, descent boolean")


TRACK_STATE = ("icao24 array<string>, ts array<long>, tp array<long>, longitude array<double>, latitude array<double>, "
               "run array<long>")


class TrackProcessor(StatefulProcessor):
    """Fixes in, fixes with their previous fix and the descent flag out; state by ``bucket`` of aircraft.

    track: of each aircraft the newest fix and the length of the descending run that ends in it;
    timer: the one that is set; seen: time and fingerprint of the rows within the horizon.
    """

    def __init__(self, rate: float = DESCENT_RATE, ticks: int = DESCENT_TICKS):
        self.rate, self.ticks = rate, ticks

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.track = handle.getValueState("track", TRACK_STATE)
        self.timer = handle.getValueState("timer", "at long")
        self.seen = handle.getValueState("seen", "ts array<long>, print array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the rows of a micro-batch come as any number of Arrow batches in any order
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf["tp"] = pdf["time_position"].fillna(NO_TIME).astype("int64")
        pdf = pdf.sort_values(["timestamp", "tp", "print"]).drop_duplicates(["timestamp", "print"])
        seen_ts, seen = (list(x) for x in (self.seen.get() if self.seen.exists() else ([], [])))
        pdf = pdf[~pdf["print"].isin(set(seen))]
        if not len(pdf):
            return
        track = [list(x) for x in self.track.get()] if self.track.exists() else [[] for _ in range(6)]
        code, names, at = places(pdf["icao24"], track[0])
        order = np.argsort(code, kind="stable")
        pdf, code = pdf.iloc[order], code[order]
        ts, tp = pdf["timestamp"].to_numpy("int64"), pdf["tp"].to_numpy("int64")
        late = behind(ts, tp, known_of(track[1], at, NEVER)[code], known_of(track[2], at, NEVER)[code])
        if late.any():
            yield self._fixes(pdf[late], code[late])[0]
        fresh, code = pdf[~late], code[~late]
        if len(fresh):
            out, run = self._fixes(fresh, code, track, at)
            last = last_rows(code)
            ends, changed = fresh.iloc[last], set(at[code[last]].tolist())
            made = [names[code[last]], ends["timestamp"], ends["tp"], ends["longitude"].astype("float64"), ends["latitude"].astype("float64"), run[last]]
            track = [[x for i, x in enumerate(old) if i not in changed] + now.tolist() for old, now in zip(track, made)]
            self.track.update(tuple(track))
            self._look_again(min(track[1]) * 1000 + IDLE_TIMEOUT_MS, timerValues.getCurrentWatermarkInMs())
            yield out
        since = timerValues.getCurrentWatermarkInMs() - HORIZON_MS
        kept = [(t, h) for t, h in zip([*seen_ts, *ts.tolist()], [*seen, *pdf["print"].tolist()]) if t * 1000 >= since]
        self.seen.update(([t for t, _ in kept], [h for _, h in kept]))

    def _fixes(self, pdf: pd.DataFrame, code: np.ndarray, track: list | None = None, at: np.ndarray | None = None) -> tuple[pd.DataFrame, np.ndarray]:
        """(fixes in order of aircraft and time, the descending run that ends in each), each aircraft's first one after
        that of ``track``; without it: fixes that have no place in the order."""
        out = pdf[["icao24", "timestamp", "longitude", "latitude", "vertical_rate", "callsign", "velocity_kmh"]].reset_index(drop=True)
        before = out[["timestamp", "longitude", "latitude"]].astype("float64")
        first, rows = first_rows(code), np.arange(len(out))
        falling = out["vertical_rate"].to_numpy("float64", na_value=np.nan) < self.rate
        if track is None:
            before[:], run = np.nan, np.zeros(len(out), dtype="int64")
        else:
            before, opens = before.shift(1), rows == first
            before[opens] = np.column_stack([known_of(track[i], at, np.nan)[code[opens]] for i in (1, 3, 4)])
            run, _ = run_lengths(falling, first, known_of(track[5], at, 0)[code])
        return out.assign(prev1_timestamp=before["timestamp"].astype("Int64"), prev1_longitude=before["longitude"],
                          prev1_latitude=before["latitude"], descent=falling & (run == self.ticks)), run

    def _look_again(self, due: int, watermark: int) -> None:
        """Set the bucket's timer, or move it to an earlier time."""
        due, timer = max(due, watermark + 1), self.timer.get()[0] if self.timer.exists() else None
        if timer is None or due < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            self.timer.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget aircraft that were silent for the whole timeout; look again later for the others."""
        self.timer.clear()
        if self.track.exists():
            track, now = self.track.get(), expiredTimerInfo.getExpiryTimeInMs()
            stay = [i for i, t in enumerate(track[1]) if t * 1000 + IDLE_TIMEOUT_MS > now]
            if stay:
                track = [[x[i] for i in stay] for x in track]
                self.track.update(tuple(track))
                self._look_again(min(track[1]) * 1000 + IDLE_TIMEOUT_MS, timerValues.getCurrentWatermarkInMs())
            else:
                self.track.clear()
                self.seen.clear()
        return iter([])

    def close(self) -> None:
        pass


def alert_messages(fixes: DataFrame, rate: float = DESCENT_RATE, ticks: int = DESCENT_TICKS) -> DataFrame:
    """A stream of stored states (with event_time) -> keyed alert messages."""
    rows = fixes.select(*FIX_COLUMNS, F.xxhash64(*FIX_COLUMNS).alias("print"), "event_time").withWatermark("event_time", WATERMARK)
    tracked = rows.withColumn("bucket", bucket()).groupBy("bucket").transformWithStateInPandas(
        TrackProcessor(rate, ticks), FIX_OUT, "Append", "EventTime")
    return serialize_keyed(alert_rows(tracked.select(*ALERT_INPUT)))


def write_alerts(messages: DataFrame, topic: str, checkpoint: str) -> StreamingQuery:
    """Append alert messages to the topic's file twin.

    Typed state with timers needs a store of several column families, which Spark's default one has not;
    a query keeps the settings that it was started with.
    """
    conf = messages.sparkSession.conf
    store = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB if store.endswith("HDFSBackedStateStoreProvider") else store)
    try:
        return (messages.writeStream.format("json").option("path", topic).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())
    finally:
        conf.set(STATE_STORE, store)


def read_alerts(spark: SparkSession, topic: str) -> DataFrame:
    """Alerts back from the topic's messages."""
    return (spark.read.schema(ENVELOPE_SCHEMA).json(topic)
            .select(F.from_json("value", ALERT_SCHEMA).alias("a")).select("a.*"))


def alerts_stream(spark: SparkSession, history: DataFrame) -> DataFrame:
    """Every alert of ``history``, published to one keyed topic micro-batch by micro-batch and read back."""
    topic, ck = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-ck")
    run_in_chunks(spark, history.select(*FIX_COLUMNS), "alerts", lambda s: write_alerts(alert_messages(s), topic, ck))
    return read_alerts(spark, topic)
