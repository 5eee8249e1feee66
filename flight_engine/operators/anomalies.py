"""Anomaly detection: ghosts, jumps, descents, outliers, congestion,
coverage gaps, latest state, data-quality flags and the alert union.

Per-aircraft ordering goes through ``with_previous`` (range-partitioned, so
a hot icao24 is spread over many tasks); per-key reductions use
aggregates with map-side partial combine (``max_by``) instead of
``row_number`` windows over whole keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flight_engine.functions.geo import grid_cell, haversine_km
from flight_engine.operators.sequence import with_previous
from flight_engine.schema import ALERT_COLUMNS

# Thresholds of the specified anomaly rules.
JUMP_KM_PER_MIN = 500.0
DESCENT_RATE = -15.0
DESCENT_TICKS = 3
MAX_KMH = 1100.0
LATEST_TTL_S = 60
SILENCE_S = 60
CONGESTION_MIN_AIRCRAFT = 3

# Data-quality flags in precedence order.
QUALITY_FLAGS = ["MISSING_POSITION", "BAD_VELOCITY", "NO_CALLSIGN", "OK"]


def quality_flag_col():
    v = F.col("velocity")
    return (F.when(F.col("longitude").isNull() | F.col("latitude").isNull(), "MISSING_POSITION")
            .when(v.isNull() | (v < 0) | (v * 3.6 > MAX_KMH), "BAD_VELOCITY")
            .when(F.col("callsign").isNull() | (F.trim(F.col("callsign")) == ""), "NO_CALLSIGN")
            .otherwise("OK"))


def quality_flag(states: DataFrame) -> DataFrame:
    return states.select("icao24", "timestamp", "time_position",
                         quality_flag_col().alias("quality_flag"))


def dedup_states(states: DataFrame, keys=("icao24", "timestamp"),
                 order=("last_contact", "time_position")) -> DataFrame:
    """One row per (icao24, timestamp): the one with the latest last_contact.

    ``max_by`` aggregates partially on the map side, so a replay storm of
    one key collapses before the shuffle.
    """
    cols = [c for c in states.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))
    return (states.groupBy(*keys).agg(best.alias("r"))
            .select(*keys, *[F.col(f"r.{c}").alias(c) for c in cols])
            .select(*states.columns))


def ghost_null_callsign(history: DataFrame) -> DataFrame:
    return history.where(F.col("callsign").isNull()).select(
        "icao24", "timestamp", "time_position", "longitude", "latitude")


def ghost_duplicate(history: DataFrame) -> DataFrame:
    """Same icao24 reported at two different positions in one snapshot."""
    return (history.groupBy("icao24", "timestamp")
            .agg(F.count(F.lit(1)).alias("reports"),
                 F.countDistinct("longitude", "latitude").alias("positions"))
            .where(F.col("positions") > 1))


def _sequence(history: DataFrame, n: int, extra: tuple[str, ...] = (), before: tuple[str, ...] = ()) -> DataFrame:
    """Fixes with their previous ``n`` timestamps, positions, descent flags and ``before`` columns."""
    d = (history.select("icao24", "timestamp", "time_position", "longitude", "latitude",
                        "vertical_rate", *extra, *before)
         .withColumn("dsc", F.coalesce(F.col("vertical_rate") < DESCENT_RATE, F.lit(False))))
    return with_previous(d, "icao24", "timestamp", ["timestamp", "longitude", "latitude", "dsc", *before],
                         n=n, tiebreak=("time_position",))


def _jump_exprs(km_per_min: float):
    """(condition, distance km, km per minute) from the previous-fix columns."""
    dt = F.col("timestamp") - F.col("prev1_timestamp")
    km = haversine_km("prev1_latitude", "prev1_longitude", "latitude", "longitude")
    speed = F.try_divide(km, dt / 60.0)  # same-second fixes: null, never a divide error
    return (dt > 0) & (speed > km_per_min), km, speed


def _descent_cond(n: int = DESCENT_TICKS):
    cond = F.col("dsc")
    for i in range(1, n):
        cond = cond & F.coalesce(F.col(f"prev{i}_dsc"), F.lit(False))
    return cond & ~F.coalesce(F.col(f"prev{n}_dsc"), F.lit(False))


def _jumps(seq: DataFrame, km_per_min: float) -> DataFrame:
    cond, km, speed = _jump_exprs(km_per_min)
    return (seq.where(cond)
            .select("icao24", "timestamp", F.col("prev1_timestamp").alias("prev_timestamp"),
                    "longitude", "latitude",
                    F.round(km, 6).alias("distance_km"),
                    F.round(speed, 6).alias("km_per_min")))


def _descents(seq: DataFrame, n: int = DESCENT_TICKS) -> DataFrame:
    return seq.where(_descent_cond(n)).select(
        "icao24", F.col(f"prev{n - 1}_timestamp").alias("start_timestamp"), "timestamp",
        "longitude", "latitude", "vertical_rate")


def position_jump(history: DataFrame, km_per_min: float = JUMP_KM_PER_MIN) -> DataFrame:
    """Consecutive fixes implying > km_per_min (time gap > 0 only)."""
    return _jumps(_sequence(history, 1), km_per_min)


def emergency_descent(history: DataFrame) -> DataFrame:
    """Runs of >= 3 consecutive fixes with vertical_rate < -15; one row per run.

    A run is reported at its third fix: that fix and the two before it are
    descending, the one before those is not (or absent).
    """
    return _descents(_sequence(history, DESCENT_TICKS))


def velocity_outliers(history: DataFrame, max_kmh: float = MAX_KMH) -> DataFrame:
    v = F.col("velocity_kmh")
    return history.where((v > max_kmh) | (v < 0)).select(
        "icao24", "timestamp", "time_position", "longitude", "latitude", "velocity_kmh")


def quality_score(history: DataFrame, deg: float = 0.5) -> DataFrame:
    """Share of OK rows per grid cell."""
    return (history.select(grid_cell(deg=deg).alias("cell"), quality_flag_col().alias("f"))
            .groupBy("cell")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.avg(F.when(F.col("f") == "OK", 1.0).otherwise(0.0)), 6)
                 .alias("quality_score")))


def congestion(history: DataFrame, deg: float = 0.5,
               min_aircraft: int = CONGESTION_MIN_AIRCRAFT) -> DataFrame:
    """(minute, cell) with at least ``min_aircraft`` distinct aircraft."""
    win = F.window(F.timestamp_seconds("timestamp"), "1 minute")
    return (history.groupBy(win.alias("w"), grid_cell(deg=deg).alias("cell"))
            .agg(F.countDistinct("icao24").alias("aircraft"))
            .where(F.col("aircraft") >= min_aircraft)
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), "cell", "aircraft"))


def coverage_gaps(history: DataFrame, deg: float = 0.5, silence_s: int = SILENCE_S,
                  as_of: int | None = None) -> DataFrame:
    """Cells silent for more than ``silence_s`` at ``as_of`` (default newest contact)."""
    ref = history.select(F.max("last_contact")).scalar() if as_of is None else F.lit(as_of)
    return (history.groupBy(grid_cell(deg=deg).alias("cell"))
            .agg(F.max("last_contact").alias("last_seen"))
            .select("cell", "last_seen", (ref - F.col("last_seen")).alias("silence_s"))
            .where(F.col("silence_s") > silence_s))


def latest_state(history: DataFrame, ttl_s: int = LATEST_TTL_S,
                 as_of: int | None = None) -> DataFrame:
    """Newest row per aircraft, kept only if within ``ttl_s`` of ``as_of``."""
    cols = [c for c in history.columns if c != "icao24"]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]),
                    F.struct(F.col("timestamp"), F.col("time_position")))
    latest = (history.groupBy("icao24").agg(best.alias("r"))
              .select("icao24", *[F.col(f"r.{c}").alias(c) for c in cols]))
    ref = history.select(F.max("timestamp")).scalar() if as_of is None else F.lit(as_of)
    return latest.where(F.col("timestamp") >= ref - F.lit(ttl_s))


#: Columns that the alert rules read.
ALERT_INPUT = ["icao24", "timestamp", "longitude", "latitude", "vertical_rate", "callsign", "velocity_kmh",
               "prev1_timestamp", "prev1_longitude", "prev1_latitude", "descent"]


def with_alerts(fixes: DataFrame) -> DataFrame:
    """Fixes (at least ALERT_INPUT) with the array of alerts that each raises.

    All four rules are evaluated in one pass. Batch, stream and aggregates share it.
    """
    jump, _, speed = _jump_exprs(JUMP_KM_PER_MIN)
    # materialise the per-fix rule results once; the alert array only references them
    seq = fixes.select("*", F.coalesce(jump, F.lit(False)).alias("_jump"), F.round(speed, 6).alias("_speed"))
    v = F.col("velocity_kmh")

    def alert(kind, cond, metric):
        return F.when(F.coalesce(cond, F.lit(False)), F.struct(
            F.lit(kind).alias("alert_type"), metric.cast("double").alias("metric")))
    found = F.array(
        alert("GHOST_NULL_CALLSIGN", F.col("callsign").isNull(), F.lit(None)),
        alert("POSITION_JUMP", F.col("_jump"), F.col("_speed")),
        alert("EMERGENCY_DESCENT", F.col("descent"), F.col("vertical_rate")),
        alert("VELOCITY_OUTLIER", (v > MAX_KMH) | (v < 0), F.round(v, 6)),
    )
    return seq.select(*fixes.columns, F.filter(found, lambda a: a.isNotNull()).alias("alerts"))


def alert_rows(fixes: DataFrame) -> DataFrame:
    """Alerts of fixes (ALERT_INPUT) that know the fix before and whether a descent is due, a row each."""
    return (with_alerts(fixes).select("icao24", "timestamp", "longitude", "latitude", F.explode("alerts").alias("a"))
            .select(F.col("a.alert_type").alias("alert_type"), "icao24", "timestamp",
                    "longitude", "latitude", F.col("a.metric").alias("metric"))
            .select(*ALERT_COLUMNS))


def alerted_fixes(history: DataFrame, extra: tuple[str, ...] = (), before: tuple[str, ...] = ()) -> DataFrame:
    """Every fix with its alerts, in one ordered pass; also ``extra`` columns and the previous fix's ``before``."""
    seq = _sequence(history, DESCENT_TICKS, ("callsign", "velocity_kmh", *extra), before).withColumn("descent", _descent_cond())
    return with_alerts(seq.select("time_position", *ALERT_INPUT, *extra, *before, *[f"prev1_{c}" for c in before]))


def alerts(history: DataFrame) -> DataFrame:
    """Typed union of every anomaly branch (the alerts topic), in one ordered pass."""
    seq = _sequence(history, DESCENT_TICKS, ("callsign", "velocity_kmh"))
    return alert_rows(seq.withColumn("descent", _descent_cond()).select(*ALERT_INPUT))
