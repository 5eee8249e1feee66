"""Canonical flight-state inputs derived from the driver's tables.

The driver tables hold no aircraft states, so states are derived from
``events`` (one row per event) and ``nation`` with plain column
arithmetic.  Every derived input grows linearly with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flight_engine.schema import FLIGHT_COLUMNS

EPOCH_BASE = 1704067200  # 2024-01-01T00:00:00Z
# Three-letter airline prefixes, picked by user_id % 5.
AIRLINE_CODES = "AALBAWDLHUALAFR"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # All times in this library are UTC epoch seconds; day/hour extraction and the
    # TIMESTAMP_NTZ -> epoch conversion below follow the session zone, so pin it.
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts="ts"):
    """TIMESTAMP_NTZ -> epoch seconds (session time zone is UTC)."""
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def flight_states(spark: SparkSession, sf_dir: str, k: int = 1) -> DataFrame:
    """Typed 13-column flight states (FLIGHT_SCHEMA).

    ``k`` compresses time: 1 keeps the 30-day span, 60 squeezes it to 12 h
    so per-minute and TTL logic has dense input.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    eid, uid = F.col("event_id"), F.col("user_id")
    ep = (F.lit(EPOCH_BASE)
          + F.floor((epoch_seconds() - F.lit(EPOCH_BASE)) / F.lit(float(k))).cast("bigint"))
    e = ev.withColumn("ep", ep).withColumn("nk", (uid % 25).cast("int"))
    out = e.join(nation, e.nk == nation.n_nationkey, "inner").select(
        F.lpad(F.lower(F.hex(uid)), 6, "0").alias("icao24"),
        F.when(eid % 29 == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.substring(F.lit(AIRLINE_CODES), (1 + 3 * (uid % 5)).cast("int"), 3),
                     uid.cast("string"), F.lit("  "))).alias("callsign"),
        F.col("n_name").alias("origin_country"),
        (F.col("ep") - eid % 10).alias("time_position"),
        (F.col("ep") - eid % 5).alias("last_contact"),
        F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(
            ((eid * 37) % 36000).cast("double") / 100.0 - 180.0).alias("longitude"),
        F.when(eid % 19 == 0, F.lit(None).cast("double")).otherwise(
            ((eid * 53) % 18000).cast("double") / 100.0 - 90.0).alias("latitude"),
        ((eid * 7) % 12000).cast("double").alias("baro_altitude"),
        F.when(F.col("event_type") == "signup", "true").otherwise("false").alias("on_ground"),
        F.when(eid % 501 == 0, -F.col("value")).otherwise(F.col("value")).alias("velocity"),
        ((eid * 11) % 360).cast("double").alias("true_track"),
        F.when(eid % 23 == 0, F.lit(None).cast("double")).otherwise(
            ((eid % 161) - 80).cast("double") / 4.0).alias("vertical_rate"),
        F.col("ep").alias("timestamp"),
    )
    return out


def dirty_states(states: DataFrame) -> DataFrame:
    """Replays (duplicated rows with a later last_contact) plus null/blank icao24 rows."""
    ts = F.col("timestamp")
    replay = states.where(ts % 10 == 0).withColumn("last_contact", F.col("last_contact") + 1)
    blank = states.where(ts % 10 == 1).withColumn(
        "icao24", F.when(ts % 20 == 1, F.lit("")).otherwise(F.lit(None).cast("string")))
    return states.unionByName(replay).unionByName(blank.select(*FLIGHT_COLUMNS))


def metric_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric observations: (event_id, ts epoch s, label, value)."""
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_seconds().alias("ts"), F.col("event_type").alias("label"), "value")


def request_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP request log of the serving API derived from events.

    path: signups hit /health, everything else /flights; every 50th
    request is a POST (405); error events fail with 500; duration in
    seconds is value / 1000; flights served is the clamped page size. A GET
    asks the database (recent_flights, or a ping for /health) for three quarters
    of its duration; a POST is refused before.
    """
    e = table(spark, sf_dir, "events")
    method = F.when(F.col("event_id") % 50 == 0, "POST").otherwise("GET")
    path = F.when(F.col("event_type") == "signup", "/health").otherwise("/flights")
    status = (F.when(method == "POST", F.lit(405))
              .when(F.col("event_type") == "error", F.lit(500))
              .otherwise(F.lit(200)))
    return e.select(
        F.col("event_id").alias("request_id"),
        epoch_seconds().alias("ts"),
        path.alias("path"),
        method.alias("method"),
        status.cast("int").alias("status"),
        (F.col("value") / 1000.0).alias("duration_s"),
        F.when((path == "/flights") & (status == 200),
               F.least(F.lit(500), F.greatest(F.lit(1), F.ceil(F.col("value")))))
         .cast("bigint").alias("flights_served"),
        F.when(method == "GET", F.when(path == "/health", "ping").otherwise("recent_flights")).alias("query_name"),
        F.when(method == "GET", F.col("value") * 0.75 / 1000.0).alias("query_duration_s"),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pseudo-airport per nation with a +-5 degree bounding box."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    lat = (k * 7 - 84).cast("double")
    lon = (k * 14 - 168).cast("double")
    return n.select(
        k.cast("bigint").alias("airport_id"),
        F.concat(F.lit("AP"), F.lpad(k.cast("string"), 2, "0")).alias("airport_code"),
        F.col("n_name").alias("country"),
        lat.alias("ap_lat"), lon.alias("ap_lon"),
        (lat - 5.0).alias("min_lat"), (lat + 5.0).alias("max_lat"),
        (lon - 5.0).alias("min_lon"), (lon + 5.0).alias("max_lon"),
        F.col("n_regionkey").cast("bigint").alias("region_key"),
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled vs actual times: orders.o_orderdate vs lineitem.l_shipdate."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return o.join(li, o.o_orderkey == li.l_orderkey).select(
        F.col("o_orderkey").alias("flight_key"),
        F.col("l_linenumber").alias("leg"),
        F.col("o_orderpriority").alias("carrier"),
        epoch_seconds("o_orderdate").alias("scheduled"),
        epoch_seconds("l_shipdate").alias("actual"),
    )


def airport_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of the airports' UTC offsets: seq, the airport's attributes and valid_from.

    Every airport starts with round(lon / 15) at the epoch base (seq 0). Each customer is
    one change of its nation's airport: by a step of -1, 0 or 1 hours from that, at a full hour that
    does not follow the order of the feed, so changes come late, repeat and meet at one time.
    """
    ap = airports(spark, sf_dir).select("airport_id", "airport_code", "country", F.round(F.col("ap_lon") / 15.0).cast("int").alias("base"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    key = F.col("c_custkey")
    first = ap.select(F.lit(0).cast("bigint").alias("seq"), "airport_id", "airport_code", "country", F.col("base").alias("utc_offset"),
                      F.lit(EPOCH_BASE).cast("bigint").alias("valid_from"))
    later = c.join(ap, F.col("c_nationkey").cast("bigint") == F.col("airport_id")).select(
        key.alias("seq"), "airport_id", "airport_code", "country",
        (F.col("base") + (F.floor(key / 7) % 3 - 1).cast("int")).alias("utc_offset"),
        (F.lit(EPOCH_BASE) + (key * 7919) % 720 * 3600).cast("bigint").alias("valid_from"))
    return first.union(later)
