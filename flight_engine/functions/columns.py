"""Scalar column expressions of the flight transform and display layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vertical-rate thresholds (m/s) and km/h factor of the transform.
CLIMB_THRESHOLD = 0.5
DESCENT_THRESHOLD = -0.5
MS_TO_KMH = 3.6

# Display colour per status; anything else gets the cruising colour.
STATUS_COLORS = {"CLIMBING": "#22c55e", "DESCENDING": "#ef4444", "CRUISING": "#f59e0b"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def velocity_kmh_col(velocity="velocity") -> Column:
    """m/s -> km/h; null stays null, no rounding."""
    return _c(velocity) * F.lit(MS_TO_KMH)


def status_col(vertical_rate="vertical_rate") -> Column:
    """> 0.5 CLIMBING, < -0.5 DESCENDING, otherwise (incl. +-0.5 and null) CRUISING."""
    vr = _c(vertical_rate)
    return (F.when(vr > F.lit(CLIMB_THRESHOLD), F.lit("CLIMBING"))
            .when(vr < F.lit(DESCENT_THRESHOLD), F.lit("DESCENDING"))
            .otherwise(F.lit("CRUISING")))


def status_color(status="status") -> Column:
    s = _c(status)
    return (F.when(s == "CLIMBING", F.lit(STATUS_COLORS["CLIMBING"]))
            .when(s == "DESCENDING", F.lit(STATUS_COLORS["DESCENDING"]))
            .otherwise(F.lit(STATUS_COLORS["CRUISING"])))


def js_round(x) -> Column:
    """JavaScript ``Math.round``: floor(x + 0.5) (differs from HALF_UP for negatives)."""
    return F.floor(_c(x) + F.lit(0.5)).cast("bigint")


def is_on_ground(on_ground="on_ground") -> Column:
    """String flag ('true'/'True'/'false') to boolean; null stays null."""
    return F.lower(_c(on_ground)) == F.lit("true")


def event_time(timestamp="timestamp") -> Column:
    """Epoch seconds -> TIMESTAMP for watermarks and windows."""
    return F.timestamp_seconds(_c(timestamp))
