"""Star schema, aggregates, expectations and table maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flight_engine.functions.columns import is_on_ground
from flight_engine.operators.anomalies import MAX_KMH, alerted_fixes, quality_flag_col
from flight_engine.functions.geo import grid_cell
from flight_engine.operators.spatial import airport_tree, ground_dwell_by_day, with_airport

# Hour-of-day buckets of dim_time.
DAY_PARTS = [(0, 5, "night"), (6, 11, "morning"), (12, 17, "afternoon"), (18, 23, "evening")]
DELAYED_AFTER_S = 60 * 86400


def _ts(c="timestamp"):
    return F.timestamp_seconds(F.col(c))


def dim_date(history: DataFrame) -> DataFrame:
    """One row per UTC day between the first and last state (a date spine)."""
    span = history.agg(F.min(F.to_date(_ts())).alias("lo"), F.max(F.to_date(_ts())).alias("hi"))
    d = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    dow = F.dayofweek("d")  # 1 = Sunday
    return d.select(
        F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"),
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        F.year("d").alias("year"), F.quarter("d").alias("quarter"),
        F.month("d").alias("month"), F.dayofmonth("d").alias("day"),
        (F.pmod(dow + 5, F.lit(7)) + 1).alias("iso_dow"),
        dow.isin(1, 7).alias("is_weekend"))


def dim_time(history: DataFrame) -> DataFrame:
    """All 24 hours of the day with their day-part bucket, and the states seen in each."""
    seen = history.groupBy(F.hour(_ts()).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    # at most 24 rows: spread into the spine from one row of counts
    spine = (seen.agg(F.map_from_entries(F.collect_list(F.struct("hour", "n"))).alias("m"))
             .select("m", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")))
    part = F.lit(None).cast("string")
    for lo, hi, name in reversed(DAY_PARTS):
        part = F.when(F.col("hour").between(lo, hi), F.lit(name)).otherwise(part)
    return spine.select("hour", part.alias("day_part"),
                        (F.col("hour") * 3600).cast("bigint").alias("seconds_from_midnight"),
                        F.coalesce(F.try_element_at("m", F.col("hour")), F.lit(0).cast("bigint")).alias("states"))


#: Attributes of the airport dimension that a change feed can change.
AIRPORT_ATTRS = ["airport_code", "country", "utc_offset"]


def dim_airports_scd2(spark, path: str, batches: list[DataFrame]) -> DataFrame:
    """Type-2 airport dimension kept at ``path`` from the batches of a change feed, in any order."""
    from flight_engine.operators.scd2 import apply_changes, read_versions
    for batch in batches:
        apply_changes(spark, path, batch, "airport_id", AIRPORT_ATTRS)
    return read_versions(spark, path)


def dim_airlines(history: DataFrame) -> DataFrame:
    code = F.substring(F.trim(F.col("callsign")), 1, 3)
    return (history.where(F.col("callsign").isNotNull())
            .groupBy(code.alias("airline_code"))
            .agg(F.countDistinct("icao24").alias("aircraft"),
                 F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")))


def flight_sk():
    return F.md5(F.concat_ws("-", F.col("icao24"), F.col("timestamp").cast("string")))


def fact_flights(history: DataFrame, airports: DataFrame, airport_versions: DataFrame) -> DataFrame:
    """One row per state with surrogate, date and hour keys, quality, and the airport with the version valid then."""
    from flight_engine.operators.scd2 import asof_join
    f = asof_join(with_airport(history, airports, how="left"), airport_versions, "airport_id", "timestamp",
                  {"version": "airport_version", "utc_offset": "utc_offset"})
    return f.select(
        flight_sk().alias("flight_sk"),
        F.date_format(_ts(), "yyyyMMdd").cast("int").alias("date_key"),
        F.hour(_ts()).alias("hour"),
        "icao24", "callsign", "timestamp", "time_position", "origin_country",
        "longitude", "latitude", grid_cell().alias("cell"), "airport_id", "airport_version", "utc_offset",
        F.round("velocity_kmh", 6).alias("velocity_kmh"), "baro_altitude", "vertical_rate",
        is_on_ground().alias("on_ground"), "status",
        quality_flag_col().alias("quality_flag"))


#: Columns of a fix that the hourly routes are made of.
ROUTE_FIX = ["icao24", "timestamp", "time_position", "origin_country", "velocity_kmh", "baro_altitude", "on_ground", "n_alerts"]
ROUTE_KEY = ["hour_start", "origin_country"]
ROUTE_SUMS = ["states", "kmh_sum", "kmh_n", "alt_sum", "alt_n", "ground", "alerts"]


def route_fixes(history: DataFrame) -> DataFrame:
    """ROUTE_FIX of every state: with the number of alerts (all rules) that it raises."""
    fixes = alerted_fixes(history, extra=("origin_country", "baro_altitude", "on_ground"))
    return fixes.select(*ROUTE_FIX[:-1], F.size("alerts").alias("n_alerts"))


def route_partials(fixes: DataFrame, n: Column | None = None) -> DataFrame:
    """Mergeable sums per (hour, country) of ROUTE_FIX rows, each counted ``n`` times (once); less than 0 takes them back."""
    n = F.lit(1) if n is None else n
    hour = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(3600))
    v, alt = F.col("velocity_kmh"), F.col("baro_altitude")
    sums = {"states": n, "kmh_sum": v * n, "kmh_n": F.when(v.isNotNull(), n), "alt_sum": alt * n, "alt_n": F.when(alt.isNotNull(), n),
            "ground": F.when(is_on_ground(), n), "alerts": F.col("n_alerts") * n}
    return (fixes.groupBy(hour.alias("hour_start"), "origin_country")
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items()]))


def routes_of(partials: DataFrame) -> DataFrame:
    """(hour, country): states, avg speed/altitude, % on ground and alerts from any number of partial sums."""
    total = partials.groupBy(*ROUTE_KEY).agg(*[F.sum(c).alias(c) for c in ROUTE_SUMS]).where("states > 0")
    return total.select(
        *ROUTE_KEY, F.col("states").cast("bigint").alias("states"),
        F.round(F.try_divide("kmh_sum", "kmh_n"), 6).alias("avg_velocity_kmh"),
        F.round(F.try_divide("alt_sum", "alt_n"), 6).alias("avg_altitude"),
        F.round(F.col("ground") / F.col("states") * 100, 6).alias("pct_on_ground"),
        F.col("alerts").cast("bigint").alias("alert_count"))


def agg_hourly_routes(history: DataFrame) -> DataFrame:
    """(hour, country): states, avg speed/altitude, % on ground, alerts of all rules."""
    return routes_of(route_partials(route_fixes(history)))


def maintain_hourly_routes(path: str, batch: str, old: DataFrame, new: DataFrame) -> None:
    """Bring the stored hourly routes from ``old`` to ``new``: ``route_fixes`` of some aircraft's states, before and after.

    Each must be made of all states of the aircraft in it, since alerts follow from earlier fixes.
    Fixes that differ are added or taken back (a correction, also of the next fix's alerts);
    the difference is written per hour under ``batch``, so hours without one keep their files and
    the same batch replaces itself.
    """
    # one pass over both: equal fixes meet and cancel, what is left was added (n > 0) or is gone
    signed = new.withColumn("n", F.lit(1)).unionByName(old.withColumn("n", F.lit(-1)))
    changed = signed.groupBy(*new.columns).agg(F.sum("n").alias("n")).where("n <> 0")
    delta = route_partials(changed, F.col("n"))
    (delta.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("hour_start", "batch").parquet(path))


def read_hourly_routes(spark, path: str) -> DataFrame:
    """The stored hourly routes, their batches summed."""
    p = spark.read.parquet(path)
    return routes_of(p.withColumn("hour_start", F.col("hour_start").cast("bigint")))


def agg_daily_airport_stats(history: DataFrame, airports: DataFrame) -> DataFrame:
    """Per airport-day: departures, arrivals, ground fixes and dwell, aircraft, quality and alerts.

    Departures (ground->air), arrivals (air->ground) and alerts are found in one ordered pass.
    ground_dwell_avg_min is the mean time on ground of the day's visits; a visit over
    midnight counts for each of its days with the time it has there.
    """
    d = alerted_fixes(history.withColumn("g", is_on_ground()), extra=("on_ground", "velocity"), before=("g",))
    tree = airport_tree(airports)
    d = with_airport(d, tree)
    day = F.date_format(_ts(), "yyyy-MM-dd")
    fixes = (d.groupBy("airport_id", day.alias("day"))
             .agg(F.count(F.when(F.col("prev1_g") & ~F.col("g"), 1)).alias("departures"),
                  F.count(F.when(~F.col("prev1_g") & F.col("g"), 1)).alias("arrivals"),
                  F.count(F.when(F.col("g"), 1)).alias("ground_fixes"),
                  F.count(F.lit(1)).alias("fixes"),
                  F.countDistinct("icao24").alias("aircraft"),
                  F.round(F.avg(F.when(quality_flag_col() == "OK", 1.0).otherwise(0.0)), 6).alias("quality_ok"),
                  F.sum(F.size("alerts")).alias("alert_count")))
    dwell = ground_dwell_by_day(history, tree).select("airport_id", "day", "ground_dwell_avg_min")
    out = fixes.join(dwell, ["airport_id", "day"], "full")
    return out.na.fill(0, ["departures", "arrivals", "ground_fixes", "fixes", "aircraft", "alert_count"])


def agg_delay_patterns(schedule: DataFrame, keys=("carrier",)) -> DataFrame:
    """By carrier, ISO day of week and hour of the schedule: legs, average delay (days), delayed share."""
    delay = F.col("actual") - F.col("scheduled")
    t = _ts("scheduled")
    return (schedule.groupBy(*keys, (F.weekday(t) + 1).cast("int").alias("iso_dow"), F.hour(t).alias("hour"))
            .agg(F.count(F.lit(1)).alias("legs"),
                 F.round(F.avg(delay / 86400.0), 6).alias("avg_delay_days"),
                 F.round(F.avg(F.when(delay > DELAYED_AFTER_S, 1.0).otherwise(0.0)), 6)
                 .alias("delayed_rate")))


def busiest_routes(corridor_rows: DataFrame, windows=(30, 90, 365), top: int = 20,
                   as_of: int | None = None) -> DataFrame:
    """Top routes by states in the last N days for each N (ranked, ties by name)."""
    ref = corridor_rows.select(F.max("timestamp")).scalar() if as_of is None else F.lit(as_of)
    age_days = (ref - F.col("timestamp")) / 86400.0
    spans = F.array(*[F.lit(int(n)) for n in windows])
    per = (corridor_rows
           .select("origin_country", "airport_country", age_days.alias("age"),
                   F.explode(spans).alias("window_days"))
           .where(F.col("age") < F.col("window_days"))
           .groupBy("window_days", "origin_country", "airport_country")
           .agg(F.count(F.lit(1)).alias("states")))
    w = Window.partitionBy("window_days").orderBy(F.col("states").desc(), "origin_country",
                                                  "airport_country")
    return per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def expectations(states: DataFrame, nation_names: DataFrame, as_of: int | None = None,
                 null_rate_max: float = 0.05, max_dimension_rows: int = 100_000) -> DataFrame:
    """Data-quality expectations -> (expectation, failures, total, passed).

    One aggregate pass evaluates every row-level check, including the
    referential one: states are left-joined to the (size-checked, broadcast)
    country dimension and an unmatched country counts as a failure.  The
    default ``as_of`` (newest timestamp) is one more scalar aggregate.
    """
    from flight_engine.operators.joins import bounded_broadcast
    # With no explicit as_of the reference is the data's own newest timestamp;
    # then no row can lie in its future and recency holds, so both checks are
    # read off the aggregate instead of costing a second pass for max().
    dim = bounded_broadcast(nation_names.select(F.col("n_name").alias("_country")).distinct(),
                            max_dimension_rows)
    s = states.join(dim, states["origin_country"] == dim["_country"], "left")
    v = F.col("velocity_kmh")
    checks = {
        "not_null_icao24": F.col("icao24").isNull() | (F.col("icao24") == ""),
        "not_null_timestamp": F.col("timestamp").isNull(),
        "accepted_values_status": ~F.coalesce(
            F.col("status").isin("CLIMBING", "CRUISING", "DESCENDING"), F.lit(False)),
        "latitude_range": ~F.coalesce(F.col("latitude").between(-90, 90), F.lit(False)),
        "longitude_range": ~F.coalesce(F.col("longitude").between(-180, 180), F.lit(False)),
        "hex_icao24": ~F.coalesce(F.col("icao24").rlike("^[0-9a-f]{6}$"), F.lit(False)),
        "velocity_bounds": (v < 0) | (v > MAX_KMH),
        "null_callsign": F.col("callsign").isNull(),
        "relationships_origin_country": F.col("origin_country").isNotNull() & F.col("_country").isNull(),
    }
    if as_of is not None:
        checks["no_future_timestamps"] = F.col("timestamp") > F.lit(as_of + 60)
    agg = s.agg(F.count(F.lit(1)).alias("total"),
                F.max("timestamp").alias("newest"),
                *[F.count(F.when(c, 1)).alias(k) for k, c in checks.items()])
    if as_of is None:
        agg = agg.withColumn("no_future_timestamps", F.lit(0).cast("bigint"))
    ref = F.col("newest") if as_of is None else F.lit(as_of)
    # recency is a table-level check: one failure when the newest row is older than 1 h
    agg = agg.withColumn("recency", F.when(F.col("newest") >= ref - F.lit(3600), 0)
                         .otherwise(1).cast("bigint"))
    names = [k for k in checks if k != "no_future_timestamps"] + ["no_future_timestamps", "recency"]
    stack = "stack({n}, {body}) as (expectation, failures)".format(
        n=len(names), body=", ".join(f"'{k}', `{k}`" for k in names))
    rows = agg.selectExpr("total", stack)
    passed = (F.when(F.col("expectation") == "null_callsign",
                     F.col("failures") <= F.col("total") * F.lit(null_rate_max))
              .otherwise(F.col("failures") == 0))
    return rows.select("expectation", F.col("failures").cast("bigint").alias("failures"),
                       "total", passed.alias("passed"))


def merge_corrections(base: DataFrame, corrections: DataFrame,
                      keys=("icao24", "timestamp"), order=("last_contact",)) -> DataFrame:
    """MERGE: a corrected key keeps its newest row by ``last_contact``; other rows stay as they are.

    Rows of keys that no correction has (also several of one key, the evidence of
    duplicated transponders) are not touched. The newest row per corrected key is a
    ``max_by`` aggregate, partial on the map side.
    """
    keys = list(keys)
    hit = corrections.select(*keys).distinct()
    untouched = base.join(hit, keys, "left_anti").select(*base.columns)
    u = base.join(hit, keys, "left_semi").select(*base.columns).unionByName(corrections.select(*base.columns))
    cols = [c for c in u.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]),
                    F.struct(*[F.col(c) for c in order], F.col("time_position")))
    newest = (u.groupBy(*keys).agg(best.alias("r"))
              .select(*keys, *[F.col(f"r.{c}").alias(c) for c in cols]).select(*base.columns))
    return untouched.unionByName(newest)


def partition_freshness(history: DataFrame, as_of: int | None = None) -> DataFrame:
    """Hours from the first state to ``as_of`` (default: the last state) that have no data.

    A trailing outage shows only against an ``as_of``, such as the present time.
    """
    hour = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(3600))
    present = history.select(hour.alias("hour_start")).distinct()
    end = F.max(hour) if as_of is None else F.greatest(F.max(hour), F.lit(as_of - as_of % 3600).cast("bigint"))
    spine = (history.agg(F.min(hour).alias("lo"), end.alias("hi"))
             .select(F.explode(F.sequence("lo", "hi", F.lit(3600).cast("bigint")))
                     .alias("hour_start")))
    return spine.join(present, "hour_start", "left_anti")


def trajectory_window(history: DataFrame, minutes: int = 5) -> DataFrame:
    """Ordered track of each aircraft per tumbling window.

    Fixes are first reduced to one per (aircraft, second) so a window's list
    is bounded by its length in seconds, whatever the input volume.
    """
    one = (history.groupBy("icao24", "timestamp")
           .agg(F.max_by(F.struct("longitude", "latitude"), F.col("time_position")).alias("p"))
           .select("icao24", "timestamp", "p.longitude", "p.latitude"))
    return tracks(one, minutes)


def tracks(one: DataFrame, minutes: int = 5) -> DataFrame:
    """Ordered track per aircraft and window from one fix per aircraft and second."""
    win = F.window(_ts(), f"{minutes} minutes")
    pts = F.sort_array(F.collect_list(F.struct("timestamp", "longitude", "latitude")))
    g = (one.groupBy("icao24", win.alias("w")).agg(pts.alias("pts"))
         .select("icao24", F.unix_seconds(F.col("w.start")).alias("window_start"), "pts"))
    track = F.array_join(F.transform("pts", lambda p: F.format_string(
        "%d:%.2f:%.2f", p["timestamp"], p["longitude"], p["latitude"])), ";")
    return g.select("icao24", "window_start", F.size("pts").cast("bigint").alias("points"),
                    F.col("pts")[0]["timestamp"].alias("first_ts"),
                    F.element_at("pts", -1)["timestamp"].alias("last_ts"),
                    track.alias("track"))


def archive_partitions(history: DataFrame) -> DataFrame:
    """Add year/month/day/hour partition columns."""
    t = _ts()
    return (history.withColumn("year", F.year(t)).withColumn("month", F.month(t))
            .withColumn("day", F.dayofmonth(t)).withColumn("hour", F.hour(t)))


def hourly_aircraft(history: DataFrame) -> DataFrame:
    """Hourly series: distinct aircraft and states per hour."""
    hour = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(3600))
    return (history.groupBy(hour.alias("hour_start"))
            .agg(F.countDistinct("icao24").alias("aircraft"),
                 F.count(F.lit(1)).alias("states")))


def merge_into_partitioned(spark, table_path: str, corrections: DataFrame, staging_path: str,
                           keys=("icao24", "timestamp"), order=("last_contact",)) -> None:
    """MERGE late corrections into the history table.

    Only the days the corrections touch are read (partition pruning), merged
    with ``merge_corrections`` and written to a staging folder in the shared
    checkpoint root (this cuts the lineage: a path cannot be overwritten while it is
    being read). The staged days then replace the table's.
    """
    from flight_engine.operators.sink import replace_days, with_partition_columns
    corr = with_partition_columns(corrections)
    days = [r[0] for r in corr.select("dt").distinct().collect()]  # one value a corrected day
    base = spark.read.parquet(table_path)
    touched = base.where(F.col("dt").cast("string").isin(days))
    cols = [c for c in base.columns if c not in ("dt", "batch")]
    merged = merge_corrections(touched.select(*cols), corr.select(*cols), keys, order)
    (merged.withColumn("dt", F.date_format(F.timestamp_seconds("timestamp"), "yyyy-MM-dd"))
     .write.mode("overwrite").partitionBy("dt").parquet(staging_path))
    replace_days(spark, table_path, spark.read.parquet(staging_path), days, "merge")


def drop_expired_partitions(spark, table: str, as_of: int, days: int) -> list[str]:
    """Retention for a catalog table partitioned by year/month/day/hour; files go too.

    Lists the table's partitions (metadata: one entry per hour of data), drops those
    that end before ``as_of - days`` in one statement, and deletes their folders
    (an external table keeps them otherwise).
    """
    import datetime as _dt
    from flight_engine.files import delete
    cutoff = _dt.datetime.fromtimestamp(as_of - days * 86400, _dt.timezone.utc)
    dropped, specs = [], []
    for row in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator():
        spec = dict(kv.split("=", 1) for kv in row[0].split("/"))
        end = _dt.datetime(int(spec["year"]), int(spec["month"]), int(spec["day"]),
                           int(spec["hour"]), tzinfo=_dt.timezone.utc) + _dt.timedelta(hours=1)
        if end <= cutoff:
            specs.append("PARTITION (" + ", ".join(f"{k}={int(v)}" for k, v in spec.items()) + ")")
            dropped.append(row[0])
    location = next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location")
    for i in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[i:i + 500])}")
    for spec in dropped:
        delete(spark, f"{location}/{spec}")
    return dropped
