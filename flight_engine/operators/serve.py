"""Serving queries: bounded newest-first pages and their table / map shapes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flight_engine.functions.columns import js_round, status_color
from flight_engine.operators.newest import kept_rows, newest_first, newest_window
from flight_engine.operators.sink import table_days
from flight_engine.schema import API_COLUMNS

# Page size default and maximum, display rows, placeholder.
DEFAULT_LIMIT = 50
MAX_LIMIT = 500
TABLE_ROWS = 100
PLACEHOLDER = "—"

_INT_RE = re.compile(r"[+-]?[0-9]+")
_INT64_MAX = 2**63 - 1


def parse_limit(value: str | None) -> int:
    """Page-size argument: ''/non-integer/<=0 -> 50, >500 -> 500.

    An integer that does not fit in 64 bits is a parse error (-> 50), not a
    clamp.  Only an optional sign and ASCII digits are accepted.
    """
    if not value or not _INT_RE.fullmatch(value):
        return DEFAULT_LIMIT
    n = int(value)
    if n > _INT64_MAX or n < -_INT64_MAX - 1 or n <= 0:
        return DEFAULT_LIMIT
    return min(n, MAX_LIMIT)


def recent_flights(history: DataFrame, limit: int | str | None = DEFAULT_LIMIT) -> DataFrame:
    """API page: 8 columns, newest first, at most ``parse_limit(limit)`` rows.

    Plans as TakeOrderedAndProject: each task keeps its local top-n and only
    n rows per task reach the final merge.
    """
    n = parse_limit(None if limit is None else str(limit))
    return history.orderBy(*newest_first()).limit(n).select(*API_COLUMNS)


def recent_flights_from_table(spark, path: str, limit: int | str | None = DEFAULT_LIMIT,
                              lookback_s: int = 3600) -> DataFrame:
    """``recent_flights`` over a stored, day-partitioned history table.

    The page comes from the newest rows kept beside the table (``operators/newest.py``);
    a table without them is read, by a window that starts at ``lookback_s`` before its
    newest row. Both always equal the unbounded query.
    """
    n = parse_limit(None if limit is None else str(limit))
    kept = kept_rows(spark, path, lambda: table_days(spark, path))
    if kept is None:
        kept = newest_window(spark, path, table_days(spark, path), n, lookback_s)
    return recent_flights(kept, n)


def peek_rows(history: DataFrame, n: int = 5, cols: tuple[str, ...] = (
        "icao24", "callsign", "origin_country", "status", "timestamp")) -> DataFrame:
    """Newest ``n`` rows, a few columns (table sanity check)."""
    return history.orderBy(*newest_first()).limit(n).select(*cols)


def api_json(page: DataFrame) -> DataFrame:
    """One JSON object per record; null fields are omitted."""
    return page.select(F.to_json(F.struct(*[F.col(c) for c in API_COLUMNS])).alias("json"))


def display_table(page: DataFrame) -> DataFrame:
    """Table rows of the dashboard: first 100 rows of the page in page order."""
    callsign = F.trim(F.coalesce(F.col("callsign"), F.lit("")))
    return (page.orderBy(*newest_first()).limit(TABLE_ROWS).select(
        F.when(callsign == "", F.lit(PLACEHOLDER)).otherwise(callsign).alias("callsign_display"),
        "icao24",
        F.coalesce(F.col("origin_country"), F.lit(PLACEHOLDER)).alias("country_display"),
        F.when(F.col("velocity_kmh").isNull(), F.lit(PLACEHOLDER))
         .otherwise(js_round("velocity_kmh").cast("string")).alias("speed_display"),
        F.coalesce(F.col("status"), F.lit(PLACEHOLDER)).alias("status_display"),
        status_color("status").alias("status_color"),
        "timestamp",
    ))


def status_colors(df: DataFrame) -> DataFrame:
    return df.select("icao24", "timestamp", "status", status_color("status").alias("status_color"))


def geojson_features(page: DataFrame) -> DataFrame:
    """Flattened Point features of rows that have a position."""
    return page.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()).select(
        "icao24", "timestamp",
        F.col("longitude").alias("lon"), F.col("latitude").alias("lat"),
        F.trim(F.coalesce(F.col("callsign"), F.lit(""))).alias("callsign"),
        F.coalesce(F.col("origin_country"), F.lit("")).alias("country"),
        F.coalesce(F.col("status"), F.lit("")).alias("status"),
        F.coalesce(F.col("velocity_kmh"), F.lit(0.0)).alias("velocity"),
    )


def geojson_feature_json(features: DataFrame) -> DataFrame:
    """One GeoJSON Feature document per row (distributed, no collect)."""
    return features.select(F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"),
                 F.array("lon", "lat").alias("coordinates")).alias("geometry"),
        F.struct("icao24", "callsign", "country", "status", "velocity").alias("properties"),
    )).alias("feature"))


def geojson_collection(page: DataFrame) -> DataFrame:
    """FeatureCollection document for ONE bounded page; over MAX_LIMIT rows it fails."""
    feats = geojson_feature_json(geojson_features(page.limit(MAX_LIMIT + 1)))
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['),
                     F.concat_ws(",", F.collect_list("feature")), F.lit("]}"))
    return feats.agg(F.when(F.count(F.lit(1)) <= MAX_LIMIT, whole).otherwise(
        F.raise_error(F.lit(f"a page has at most {MAX_LIMIT} rows"))).alias("geojson"))


def popup_label(features: DataFrame) -> DataFrame:
    label = F.when(F.col("callsign") == "", F.col("icao24")).otherwise(F.col("callsign"))
    return features.select("icao24", "timestamp", label.alias("label"),
                           js_round("velocity").alias("speed_kmh_rounded"))


def page_positions(page: DataFrame) -> DataFrame:
    """One position per aircraft within a page: the newest row wins."""
    pos = page.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    # newest fix wins; equal timestamps are broken by position for determinism
    best = F.max_by(F.struct("longitude", "latitude", "timestamp"),
                    F.struct("timestamp", "longitude", "latitude"))
    return (pos.groupBy("icao24").agg(best.alias("p"))
            .select("icao24", F.col("p.longitude").alias("lon"), F.col("p.latitude").alias("lat"),
                    F.col("p.timestamp").alias("timestamp")))


def dashboard_header(page: DataFrame) -> DataFrame:
    """Row count, distinct aircraft and newest timestamp of a page."""
    return page.agg(F.count(F.lit(1)).alias("row_count"),
                    F.countDistinct("icao24").alias("aircraft_count"),
                    F.max("timestamp").alias("latest_timestamp"))


def interpolate_positions(history: DataFrame, steps: int = 4) -> DataFrame:
    """Eased positions between consecutive fixes of each aircraft.

    For t in {0, 1/steps, ..., 1}: ease = 1 - (1 - t)^3 and
    pos = prev + (cur - prev) * ease; with no previous fix the current one.
    """
    from flight_engine.operators.sequence import with_previous
    pos = history.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull()) \
        .select("icao24", "timestamp", "time_position", "longitude", "latitude")
    d = with_previous(pos, "icao24", "timestamp", ["longitude", "latitude"], n=1,
                      tiebreak=("time_position",))
    d = d.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    t = F.col("step") / F.lit(float(steps))
    ease = F.lit(1.0) - F.pow(F.lit(1.0) - t, 3)
    has_prev = F.col("prev1_longitude").isNotNull()

    def interp(c):
        return F.when(has_prev, F.col(f"prev1_{c}") + (F.col(c) - F.col(f"prev1_{c}")) * ease) \
            .otherwise(F.col(c))
    return d.select("icao24", "timestamp", "step", interp("longitude").alias("lon"),
                    interp("latitude").alias("lat"))

