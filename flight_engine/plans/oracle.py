"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans (plain window functions, range
joins, ``row_number``) over the driver's views, so a match means the
Spark operator reproduces the specified semantics.  Double literals carry
an ``E0`` suffix so DuckDB never switches to DECIMAL arithmetic.
"""

from __future__ import annotations

from flight_engine.plans.catalog import EUROPE, EXPECT_AS_OF, FRESH_AS_OF, LIMIT_CASES, PACIFIC
from flight_engine.operators.metrics import (
    DB_DURATION_BOUNDS, DEFAULT_DURATION_BOUNDS, PAGE_SIZE_BOUNDS, bound_label,
)
from flight_engine.operators.spatial import AIRLINES

EP = "CAST(floor(epoch(ts)) AS BIGINT)"
# Names of the nation table, columns of the wide OD matrix.
COUNTRIES = [f"NATION_{i}" for i in range(25)]


def _states(k: int) -> str:
    return f"""SELECT lpad(lower(hex(e.user_id)), 6, '0') AS icao24,
  CASE WHEN e.event_id % 29 = 0 THEN NULL ELSE concat(substr('AALBAWDLHUALAFR', CAST(1 + 3 * (e.user_id % 5) AS INT), 3), CAST(e.user_id AS VARCHAR), '  ') END AS callsign,
  n.n_name AS origin_country,
  e.ep - (e.event_id % 10) AS time_position,
  e.ep - (e.event_id % 5) AS last_contact,
  CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE CAST((e.event_id * 37) % 36000 AS DOUBLE) / 100.0E0 - 180.0E0 END AS longitude,
  CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE CAST((e.event_id * 53) % 18000 AS DOUBLE) / 100.0E0 - 90.0E0 END AS latitude,
  CAST((e.event_id * 7) % 12000 AS DOUBLE) AS baro_altitude,
  CASE WHEN e.event_type = 'signup' THEN 'true' ELSE 'false' END AS on_ground,
  CASE WHEN e.event_id % 501 = 0 THEN -e.value ELSE e.value END AS velocity,
  CAST((e.event_id * 11) % 360 AS DOUBLE) AS true_track,
  CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE CAST((e.event_id % 161) - 80 AS DOUBLE) / 4.0E0 END AS vertical_rate,
  e.ep AS timestamp
FROM (SELECT *, 1704067200 + CAST(floor(({EP} - 1704067200) / {k}.0E0) AS BIGINT) AS ep FROM events) e
JOIN nation n ON n.n_nationkey = e.user_id % 25"""


STATUS = ("CASE WHEN vertical_rate > 0.5E0 THEN 'CLIMBING' WHEN vertical_rate < -0.5E0 "
          "THEN 'DESCENDING' ELSE 'CRUISING' END")
HAS_POS = "longitude IS NOT NULL AND latitude IS NOT NULL"
SINKABLE = "icao24 IS NOT NULL AND icao24 <> '' AND timestamp IS NOT NULL"
FCOLS = ("icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, "
         "baro_altitude, on_ground, velocity, true_track, vertical_rate, timestamp")
NEWEST = "timestamp DESC, icao24 ASC, time_position DESC"
API = "icao24, callsign, origin_country, longitude, latitude, velocity_kmh, status, timestamp"
ORDER_ACFT = "PARTITION BY icao24 ORDER BY timestamp, time_position"
D2R = "0.017453292519943295E0"


def hav(lat1, lon1, lat2, lon2) -> str:
    p1, p2 = f"(({lat1}) * {D2R})", f"(({lat2}) * {D2R})"
    dlat = f"({p2} - {p1})"
    dlon = f"((({lon2}) * {D2R}) - (({lon1}) * {D2R}))"
    a = f"(pow(sin({dlat} / 2), 2) + cos({p1}) * cos({p2}) * pow(sin({dlon} / 2), 2))"
    return f"(12742.0E0 * asin(sqrt(least(1.0E0, {a}))))"


def cell(deg: float, lat="latitude", lon="longitude") -> str:
    rows, cols = int(round(180 / deg)), int(round(360 / deg))
    return (f"CAST(least(floor(({lat} + 90.0E0) / {deg}E0), {rows - 1}) * {cols} + "
            f"least(floor(({lon} + 180.0E0) / {deg}E0), {cols - 1}) AS BIGINT)")


def qflag(kmh="velocity * 3.6E0") -> str:
    return (f"CASE WHEN longitude IS NULL OR latitude IS NULL THEN 'MISSING_POSITION' "
            f"WHEN velocity IS NULL OR velocity < 0 OR {kmh} > 1100.0E0 THEN 'BAD_VELOCITY' "
            f"WHEN callsign IS NULL OR trim(callsign) = '' THEN 'NO_CALLSIGN' ELSE 'OK' END")


def _jumps(src: str) -> str:
    return f"""SELECT icao24, timestamp, prev_timestamp, longitude, latitude, round(d, 6) AS distance_km,
  round(d / ((timestamp - prev_timestamp) / 60.0E0), 6) AS km_per_min FROM (
  SELECT *, lag(timestamp) OVER w AS prev_timestamp, {hav('lag(latitude) OVER w', 'lag(longitude) OVER w', 'latitude', 'longitude')} AS d
  FROM {src} WINDOW w AS ({ORDER_ACFT}))
  WHERE timestamp - prev_timestamp > 0 AND d / ((timestamp - prev_timestamp) / 60.0E0) > 500.0E0"""


def ts(col="timestamp") -> str:
    return f"make_timestamp({col} * 1000000)"


BASE = [
    f"fs AS ({_states(1)})",
    f"fs60 AS ({_states(60)})",
    f"hist AS (SELECT *, velocity * 3.6E0 AS velocity_kmh, {STATUS} AS status FROM fs WHERE {HAS_POS} AND {SINKABLE})",
    f"hist60 AS (SELECT *, velocity * 3.6E0 AS velocity_kmh, {STATUS} AS status FROM fs60 WHERE {HAS_POS} AND {SINKABLE})",
    f"""dirty AS (SELECT {FCOLS} FROM fs
  UNION ALL SELECT icao24, callsign, origin_country, time_position, last_contact + 1, longitude, latitude, baro_altitude, on_ground, velocity, true_track, vertical_rate, timestamp FROM fs WHERE timestamp % 10 = 0
  UNION ALL SELECT CASE WHEN timestamp % 20 = 1 THEN '' ELSE NULL END, callsign, origin_country, time_position, last_contact, longitude, latitude, baro_altitude, on_ground, velocity, true_track, vertical_rate, timestamp FROM fs WHERE timestamp % 10 = 1)""",
    f"page AS (SELECT * FROM hist ORDER BY {NEWEST} LIMIT 500)",
    f"me AS (SELECT event_id, {EP} AS ts, event_type AS label, value FROM events)",
    f"""req AS (SELECT event_id AS request_id, {EP} AS ts,
  CASE WHEN event_type = 'signup' THEN '/health' ELSE '/flights' END AS path,
  CASE WHEN event_id % 50 = 0 THEN 'POST' ELSE 'GET' END AS method,
  CAST(CASE WHEN event_id % 50 = 0 THEN 405 WHEN event_type = 'error' THEN 500 ELSE 200 END AS INTEGER) AS status,
  value / 1000.0E0 AS duration_s,
  CASE WHEN event_id % 50 <> 0 AND event_type NOT IN ('signup', 'error') THEN CAST(least(500, greatest(1, ceil(value))) AS BIGINT) END AS flights_served,
  CASE WHEN event_id % 50 <> 0 THEN CASE WHEN event_type = 'signup' THEN 'ping' ELSE 'recent_flights' END END AS query_name,
  CASE WHEN event_id % 50 <> 0 THEN value * 0.75E0 / 1000.0E0 END AS query_duration_s,
  CASE WHEN event_id % 50 = 0 THEN 'POST' ELSE 'GET' END || ' ' || CASE WHEN event_type = 'signup' THEN '/health' ELSE '/flights' END AS series
  FROM events)""",
    """ap AS (SELECT CAST(n_nationkey AS BIGINT) AS airport_id, 'AP' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS airport_code,
  n_name AS country, CAST(n_nationkey * 7 - 84 AS DOUBLE) AS ap_lat, CAST(n_nationkey * 14 - 168 AS DOUBLE) AS ap_lon FROM nation)""",
    # every positioned state with its nearest airport, by brute force over all airports
    f"""withap AS (SELECT * EXCLUDE (rid, km) FROM (
  SELECT h.*, ap.airport_id, ap.airport_code, ap.country AS airport_country, ap.ap_lat, ap.ap_lon,
    round({hav('h.latitude', 'h.longitude', 'ap.ap_lat', 'ap.ap_lon')}, 6) AS km
  FROM (SELECT *, row_number() OVER () AS rid FROM hist) h CROSS JOIN ap)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY km, airport_id) = 1)""",
    f"jumps AS ({_jumps('hist')})",
    f"""descents AS (SELECT icao24, t2 AS start_timestamp, timestamp, longitude, latitude, vertical_rate FROM (
  SELECT *, lag(dsc, 1) OVER w AS d1, lag(dsc, 2) OVER w AS d2, lag(dsc, 3) OVER w AS d3, lag(timestamp, 2) OVER w AS t2
  FROM (SELECT *, coalesce(vertical_rate < -15.0E0, false) AS dsc FROM hist) WINDOW w AS ({ORDER_ACFT}))
  WHERE dsc AND coalesce(d1, false) AND coalesce(d2, false) AND NOT coalesce(d3, false))""",
    f"""lagq AS (SELECT window_start, produced, consumed,
  CAST(sum(produced) OVER w - sum(consumed) OVER w AS BIGINT) AS lag FROM (
  SELECT coalesce(p.window_start, c.window_start) AS window_start, coalesce(produced, 0) AS produced, coalesce(consumed, 0) AS consumed
  FROM (SELECT timestamp - timestamp % 60 AS window_start, count(*) AS produced FROM fs60 GROUP BY 1) p
  FULL JOIN (SELECT (time_position + 10) - (time_position + 10) % 60 AS window_start, count(*) AS consumed FROM hist60 GROUP BY 1) c
  ON p.window_start = c.window_start)
  WINDOW w AS (ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
]


def with_base(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join(BASE + list(extra)) + "\n" + body


def _hist_buckets(finite=None, src: str = "me", value: str = "value", label: str = "label") -> str:
    finite = list(PAGE_SIZE_BOUNDS if finite is None else finite)
    bounds = finite + [float("inf")]
    case = "CASE " + " ".join(f"WHEN {value} <= {float(b)}E0 THEN {i}" for i, b in
                              enumerate(finite)) + f" ELSE {len(finite)} END"
    vals = ", ".join(
        f"({i}, '{bound_label(b)}', {'CAST(' + repr('inf') + ' AS DOUBLE)' if b == float('inf') else str(float(b)) + 'E0'})"
        for i, b in enumerate(bounds))
    return f"""hb AS (SELECT l.label, b.idx, b.le, b.upper,
  CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY l.label ORDER BY b.idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS bucket_count
  FROM (SELECT DISTINCT {label} AS label FROM {src} WHERE {value} IS NOT NULL) l CROSS JOIN (VALUES {vals}) b(idx, le, upper)
  LEFT JOIN (SELECT {label} AS label, {case} AS idx, count(*) AS n FROM {src} WHERE {value} IS NOT NULL GROUP BY ALL) c ON c.label = l.label AND c.idx = b.idx)"""


def _limit_union() -> str:
    parts = [f"(SELECT {API}, '{arg}' AS limit_arg FROM hist ORDER BY {NEWEST} LIMIT {n})"
             for arg, n in LIMIT_CASES]
    return "\nUNION ALL ".join(parts)


def _normalize() -> str:
    cols = []
    for c in ("icao24 callsign origin_country time_position last_contact longitude latitude "
              "baro_altitude on_ground velocity true_track vertical_rate timestamp velocity_kmh "
              "status").split():
        cols.append(c if c in ("icao24", "timestamp") else
                    f"CASE WHEN timestamp % 7 = 0 THEN NULL ELSE {c} END AS {c}")
    return f"SELECT {', '.join(cols)} FROM hist"


def _expectations() -> str:
    checks = {
        "not_null_icao24": "icao24 IS NULL OR icao24 = ''",
        "not_null_timestamp": "timestamp IS NULL",
        "accepted_values_status": "NOT coalesce(status IN ('CLIMBING', 'CRUISING', 'DESCENDING'), false)",
        "latitude_range": "NOT coalesce(latitude BETWEEN -90 AND 90, false)",
        "longitude_range": "NOT coalesce(longitude BETWEEN -180 AND 180, false)",
        "hex_icao24": "NOT coalesce(regexp_matches(icao24, '^[0-9a-f]{6}$'), false)",
        "velocity_bounds": "velocity_kmh < 0 OR velocity_kmh > 1100.0E0",
        "null_callsign": "callsign IS NULL",
        "no_future_timestamps": f"timestamp > {EXPECT_AS_OF} + 60",
    }
    agg = ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}" for k, c in checks.items())
    parts = []
    for k in checks:
        passed = (f"{k} <= total * 0.05E0" if k == "null_callsign" else f"{k} = 0")
        parts.append(f"SELECT '{k}' AS expectation, CAST({k} AS BIGINT) AS failures, total, {passed} AS passed FROM agg")
    parts.append("SELECT 'recency' AS expectation, CAST(CASE WHEN newest >= {r} - 3600 THEN 0 ELSE 1 END AS BIGINT), total, newest >= {r} - 3600 FROM agg".format(r=EXPECT_AS_OF))
    parts.append("SELECT 'relationships_origin_country', CAST((SELECT count(*) FROM dp WHERE origin_country IS NOT NULL AND origin_country NOT IN (SELECT n_name FROM nation)) AS BIGINT), total, (SELECT count(*) FROM dp WHERE origin_country IS NOT NULL AND origin_country NOT IN (SELECT n_name FROM nation)) = 0 FROM agg")
    return with_base("\nUNION ALL ".join(parts),
                     f"dp AS (SELECT *, velocity * 3.6E0 AS velocity_kmh, {STATUS} AS status FROM dirty WHERE {HAS_POS})",
                     f"agg AS (SELECT count(*) AS total, max(timestamp) AS newest, {agg} FROM dp)")


def _airlines_values() -> str:
    return ", ".join(f"('{c}', '{n}')" for c, n in AIRLINES)


def _decode_cols() -> str:
    return (f"{FCOLS.replace(', timestamp', '')}, CAST(NULL AS VARCHAR) AS sensors, baro_altitude AS geo_altitude, "
            "CAST(NULL AS VARCHAR) AS squawk, false AS spi, CAST(0 AS BIGINT) AS position_source, timestamp")


COLOR = "CASE status WHEN 'CLIMBING' THEN '#22c55e' WHEN 'DESCENDING' THEN '#ef4444' ELSE '#f59e0b' END"
GEO = ("SELECT icao24, timestamp, longitude AS lon, latitude AS lat, trim(coalesce(callsign, '')) AS callsign, "
       "coalesce(origin_country, '') AS country, coalesce(status, '') AS status, coalesce(velocity_kmh, 0.0E0) AS velocity "
       f"FROM page WHERE {HAS_POS}")
TRAJ_ONE = ("one AS (SELECT icao24, timestamp, arg_max(longitude, time_position) AS longitude, "
            "arg_max(latitude, time_position) AS latitude FROM hist60 GROUP BY ALL)")


def _interp() -> str:
    ease = "(1.0E0 - pow(1.0E0 - CAST(step AS DOUBLE) / 4.0E0, 3))"
    return f"""SELECT icao24, timestamp, CAST(step AS INTEGER) AS step,
  CASE WHEN plon IS NOT NULL THEN plon + (longitude - plon) * {ease} ELSE longitude END AS lon,
  CASE WHEN plat IS NOT NULL THEN plat + (latitude - plat) * {ease} ELSE latitude END AS lat
  FROM (SELECT *, lag(longitude) OVER w AS plon, lag(latitude) OVER w AS plat FROM hist WINDOW w AS ({ORDER_ACFT}))
  CROSS JOIN range(0, 5) r(step)"""


def _route_eff() -> str:
    leg = (f"CASE WHEN floor(pts / 86400) = floor(timestamp / 86400) THEN "
           f"{hav('plat', 'plon', 'latitude', 'longitude')} ELSE 0.0E0 END")
    return with_base(
        """SELECT airline, count(*) AS flights, round(sum(path_km), 3) AS path_km, round(sum(gc_km), 3) AS gc_km,
  round(avg(ratio), 6) AS avg_ratio, count(*) FILTER (WHERE ratio > 1.15E0) AS inefficient FROM fl2 GROUP BY airline""",
        f"lg AS (SELECT *, lag(timestamp) OVER w AS pts, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon FROM hist WINDOW w AS ({ORDER_ACFT}))",
        f"""fl AS (SELECT icao24, floor(timestamp / 86400) AS day, sum({leg}) AS path_km,
  arg_min(latitude, timestamp) AS alat, arg_min(longitude, timestamp) AS alon,
  arg_max(latitude, timestamp) AS blat, arg_max(longitude, timestamp) AS blon,
  max(substr(trim(callsign), 1, 3)) AS airline FROM lg GROUP BY 1, 2)""",
        f"fl2 AS (SELECT *, {hav('alat', 'alon', 'blat', 'blon')} AS gc_km, path_km / {hav('alat', 'alon', 'blat', 'blon')} AS ratio FROM fl WHERE {hav('alat', 'alon', 'blat', 'blon')} > 0)",
    )


#: Alerts of every rule with the country of the fix that raised them, over a table of states.
def _alerts_of(src: str, name: str) -> list[str]:
    return [f"""{name} AS (SELECT *, lag(timestamp) OVER w AS pt, {hav('lag(latitude) OVER w', 'lag(longitude) OVER w', 'latitude', 'longitude')} AS pd,
  coalesce(vertical_rate < -15.0E0, false) AND coalesce(lag(vertical_rate, 1) OVER w < -15.0E0, false) AND coalesce(lag(vertical_rate, 2) OVER w < -15.0E0, false)
    AND NOT coalesce(lag(vertical_rate, 3) OVER w < -15.0E0, false) AS descent
  FROM {src} WINDOW w AS ({ORDER_ACFT}))""",
            f"""{name}_n AS (SELECT *, CAST(callsign IS NULL AS INTEGER) + CAST(coalesce(velocity_kmh > 1100.0E0 OR velocity_kmh < 0, false) AS INTEGER)
  + CAST(descent AS INTEGER) + CAST(coalesce(timestamp - pt > 0 AND pd / ((timestamp - pt) / 60.0E0) > 500.0E0, false) AS INTEGER) AS alerts FROM {name})"""]


def _hourly_routes(src: str) -> str:
    return f"""SELECT timestamp - timestamp % 3600 AS hour_start, origin_country, count(*) AS states,
  round(avg(velocity_kmh), 6) AS avg_velocity_kmh, round(avg(baro_altitude), 6) AS avg_altitude,
  round(avg(CASE WHEN lower(on_ground) = 'true' THEN 1.0E0 ELSE 0.0E0 END) * 100, 6) AS pct_on_ground,
  CAST(sum(alerts) AS BIGINT) AS alert_count FROM {src} GROUP BY 1, 2"""


def _daily_airport() -> str:
    return with_base(
        f"""SELECT airport_id, day, departures, arrivals, ground_fixes, fixes, aircraft, quality_ok, alert_count, ground_dwell_avg_min FROM (
  SELECT airport_id, strftime({ts()}, '%Y-%m-%d') AS day,
    count(*) FILTER (WHERE pg AND NOT g) AS departures, count(*) FILTER (WHERE NOT pg AND g) AS arrivals,
    count(*) FILTER (WHERE g) AS ground_fixes, count(*) AS fixes, count(DISTINCT icao24) AS aircraft,
    round(avg(CASE WHEN flag = 'OK' THEN 1.0E0 ELSE 0.0E0 END), 6) AS quality_ok, CAST(sum(alerts) AS BIGINT) AS alert_count
  FROM gg GROUP BY 1, 2) LEFT JOIN dwell USING (airport_id, day)""",
        *_alerts_of("withap", "al"),
        f"""gg AS (SELECT *, lower(on_ground) = 'true' AS g,
  lag(lower(on_ground) = 'true') OVER (PARTITION BY icao24 ORDER BY timestamp, time_position) AS pg,
  {qflag()} AS flag FROM al_n)""",
        # whole visits first, then their days
        f"""visits AS (SELECT icao24, airport_id, min(timestamp) AS a, max(timestamp) AS b FROM (
  SELECT *, sum(CAST(NOT goes_on AS INTEGER)) OVER (PARTITION BY icao24 ORDER BY timestamp, time_position ROWS UNBOUNDED PRECEDING) AS visit FROM (
    SELECT *, coalesce(lag(airport_id) OVER w = airport_id AND timestamp - lag(timestamp) OVER w <= 3600, false) AS goes_on
    FROM withap WHERE lower(on_ground) = 'true' WINDOW w AS ({ORDER_ACFT}))) GROUP BY icao24, airport_id, visit)""",
        f"""dwell AS (SELECT airport_id, strftime({ts('d * 86400')}, '%Y-%m-%d') AS day,
  round(sum(least(b, (d + 1) * 86400) - greatest(a, d * 86400)) / 60.0E0 / count(*), 6) AS ground_dwell_avg_min
  FROM (SELECT *, unnest(generate_series(a // 86400, b // 86400)) AS d FROM visits) GROUP BY 1, 2)""")


_FEED = ["""feed AS (SELECT CAST(0 AS BIGINT) AS seq, airport_id, airport_code, country, CAST(round(ap_lon / 15.0E0) AS INTEGER) AS utc_offset, CAST(1704067200 AS BIGINT) AS valid_from FROM ap
  UNION ALL SELECT c_custkey, airport_id, airport_code, country, CAST(round(ap_lon / 15.0E0) AS INTEGER) + CAST((c_custkey // 7) % 3 - 1 AS INTEGER),
    1704067200 + (c_custkey * 7919) % 720 * 3600 FROM customer JOIN ap ON c_nationkey = airport_id)""",
         """said AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY airport_id, valid_from ORDER BY seq DESC) = 1)""",
         """changed AS (SELECT * FROM said WINDOW w AS (PARTITION BY airport_id ORDER BY valid_from)
  QUALIFY lag(utc_offset) OVER w IS NULL OR lag(utc_offset) OVER w <> utc_offset)""",
         """versions AS (SELECT airport_id, airport_code, country, utc_offset, valid_from, lead(valid_from) OVER w AS valid_to,
  CAST(row_number() OVER w AS INTEGER) AS version, lead(valid_from) OVER w IS NULL AS is_current
  FROM changed WINDOW w AS (PARTITION BY airport_id ORDER BY valid_from))"""]


_DAY_PART = ("CASE WHEN hour BETWEEN 0 AND 5 THEN 'night' WHEN hour BETWEEN 6 AND 11 THEN 'morning' "
             "WHEN hour BETWEEN 12 AND 17 THEN 'afternoon' WHEN hour BETWEEN 18 AND 23 THEN 'evening' END")

_MERGED_ROWS = [
    "SELECT * FROM hist WHERE timestamp % 13 <> 0 UNION ALL SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY icao24, timestamp ORDER BY last_contact DESC, time_position DESC) AS rn FROM u) WHERE rn = 1",
    """u AS (SELECT * FROM hist WHERE timestamp % 13 = 0 UNION ALL SELECT icao24, callsign, origin_country, time_position, last_contact + 2, longitude, latitude,
  baro_altitude, on_ground, velocity * 1.1E0, true_track, vertical_rate, timestamp, velocity * 1.1E0 * 3.6E0, status FROM hist WHERE timestamp % 13 = 0)"""]
_MERGE = with_base(*_MERGED_ROWS)

_DEDUP = with_base(
    f"SELECT {FCOLS} FROM (SELECT *, row_number() OVER (PARTITION BY icao24, timestamp ORDER BY last_contact DESC, time_position DESC) AS rn FROM dirty WHERE {SINKABLE}) WHERE rn = 1")

_LATEST = with_base(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY timestamp DESC, time_position DESC) AS rn FROM hist60) "
    "WHERE rn = 1 AND timestamp >= (SELECT max(timestamp) FROM hist60) - 60")

_CONGESTION = with_base(
    f"SELECT timestamp - timestamp % 60 AS window_start, {cell(30.0)} AS cell, count(DISTINCT icao24) AS aircraft FROM hist60 GROUP BY 1, 2 HAVING count(DISTINCT icao24) >= 3")

def _quantile(buckets_cte: str, out_label: str = "label") -> str:
    return with_base(
        f"""SELECT label AS {out_label}, round(CASE WHEN le = '+Inf' THEN max_finite ELSE lower + (upper - lower) *
  CASE WHEN bucket_count = prev_count THEN 0.0E0 ELSE (rnk - prev_count) / (bucket_count - prev_count) END END, 9) AS quantile
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY idx) AS rn FROM x WHERE bucket_count >= rnk AND total > 0) WHERE rn = 1""",
        buckets_cte,
    """x AS (SELECT *, coalesce(lag(bucket_count) OVER w, 0) AS prev_count, coalesce(lag(upper) OVER w, 0.0E0) AS lower,
  max(bucket_count) OVER (PARTITION BY label) AS total,
  max(CASE WHEN le <> '+Inf' THEN upper END) OVER (PARTITION BY label) AS max_finite,
  0.95E0 * max(bucket_count) OVER (PARTITION BY label) AS rnk FROM hb WINDOW w AS (PARTITION BY label ORDER BY idx))""")


_QUANTILE = _quantile(_hist_buckets())

ORACLE: dict[str, str] = {
    # sources
    "scan_snapshot_decode": with_base(f"SELECT {_decode_cols()} FROM fs WHERE last_contact % 41 <> 0"),
    "stream_read_raw": with_base(f"SELECT {FCOLS} FROM fs"),
    "parse_json_typed": with_base(f"SELECT {FCOLS} FROM fs"),
    "consume_processed": with_base("SELECT * FROM hist"),
    "scan_history_table": with_base("SELECT * FROM hist"),
    "read_from_beginning_bounded": with_base(f"SELECT {FCOLS} FROM fs ORDER BY timestamp, icao24, time_position LIMIT 1000"),
    # projections / filters / expressions
    "filter_malformed_state": with_base("SELECT count(*) FILTER (WHERE last_contact % 41 <> 0) AS accepted, count(*) FILTER (WHERE last_contact % 41 = 0) AS rejected FROM fs"),
    "stamp_snapshot_time": with_base("SELECT icao24, last_contact, timestamp FROM fs WHERE last_contact % 41 <> 0"),
    "filter_has_position": with_base(f"SELECT {FCOLS} FROM fs WHERE {HAS_POS}"),
    "enrich_velocity_kmh": with_base(f"SELECT icao24, timestamp, time_position, velocity, velocity * 3.6E0 AS velocity_kmh FROM fs WHERE {HAS_POS}"),
    "enrich_status": with_base(f"SELECT icao24, timestamp, time_position, vertical_rate, {STATUS} AS status FROM fs WHERE {HAS_POS}"),
    "status_counts": with_base("SELECT status, count(*) AS n FROM hist GROUP BY status"),
    "serialize_keyed_json": with_base("SELECT icao24 AS key, * FROM hist"),
    "normalize_record": with_base(_normalize()),
    "filter_sinkable": with_base(f"SELECT {FCOLS} FROM dirty WHERE {SINKABLE}"),
    "api_projection": with_base(f"SELECT {API} FROM hist"),
    "display_table": with_base(f"""SELECT CASE WHEN trim(coalesce(callsign, '')) = '' THEN '—' ELSE trim(coalesce(callsign, '')) END AS callsign_display,
  icao24, coalesce(origin_country, '—') AS country_display,
  CASE WHEN velocity_kmh IS NULL THEN '—' ELSE CAST(CAST(floor(velocity_kmh + 0.5E0) AS BIGINT) AS VARCHAR) END AS speed_display,
  coalesce(status, '—') AS status_display, {COLOR} AS status_color, timestamp
  FROM page ORDER BY {NEWEST} LIMIT 100"""),
    "status_color": with_base(f"SELECT icao24, timestamp, status, {COLOR} AS status_color FROM hist"),
    "geojson_features": with_base(GEO),
    "popup_label": with_base(f"SELECT icao24, timestamp, CASE WHEN callsign = '' THEN icao24 ELSE callsign END AS label, CAST(floor(velocity + 0.5E0) AS BIGINT) AS speed_kmh_rounded FROM ({GEO})"),
    "page_positions": with_base(f"SELECT icao24, lon, lat, timestamp FROM (SELECT icao24, longitude AS lon, latitude AS lat, timestamp, row_number() OVER (PARTITION BY icao24 ORDER BY timestamp DESC, longitude DESC, latitude DESC) AS rn FROM page WHERE {HAS_POS}) WHERE rn = 1"),
    "interpolate_positions": with_base(_interp()),
    # sorts / limits
    "recent_flights": with_base(f"SELECT {API} FROM hist ORDER BY {NEWEST} LIMIT 50"),
    "parse_limit": with_base(_limit_union()),
    "peek_rows": with_base(f"SELECT icao24, callsign, origin_country, status, timestamp FROM hist ORDER BY {NEWEST} LIMIT 5"),
    "slowest_requests": with_base("SELECT request_id, path, method, status, duration_s FROM req ORDER BY duration_s DESC, request_id LIMIT 5"),
    # aggregations
    "count_rows": with_base("SELECT count(*) AS row_count FROM hist"),
    "dashboard_header": with_base("SELECT count(*) AS row_count, count(DISTINCT icao24) AS aircraft_count, max(timestamp) AS latest_timestamp FROM page"),
    "pipeline_counters": with_base(f"""SELECT count(DISTINCT timestamp) AS polls_total, count(*) AS flights_sent_total,
  count(*) FILTER (WHERE {HAS_POS}) AS messages_consumed_total,
  count(*) FILTER (WHERE {HAS_POS} AND {SINKABLE}) AS inserts_success,
  count(*) FILTER (WHERE {HAS_POS} AND NOT coalesce({SINKABLE}, false)) AS inserts_skipped,
  CAST(0 AS BIGINT) AS inserts_error FROM dirty"""),
    "histogram_buckets": with_base("SELECT label, le, bucket_count FROM hb", _hist_buckets()),
    "rate_per_window": with_base("SELECT ts - ts % 60 AS window_start, label, count(*) AS n, round(count(*) / 60.0E0, 9) AS per_second FROM me GROUP BY 1, 2"),
    "histogram_quantile_p95": _QUANTILE,
    "avg_per_window": with_base("SELECT ts - ts % 60 AS window_start, label, count(*) AS n, round(sum(value) / count(*), 6) AS avg_value FROM me GROUP BY 1, 2"),
    "consumer_lag": with_base("SELECT * FROM lagq"),
    "request_metrics": with_base("SELECT path, method, status, count(*) AS requests, round(sum(duration_s), 6) AS duration_sum, round(avg(duration_s), 6) AS duration_avg, count(*) FILTER (WHERE status >= 500) AS errors FROM req GROUP BY 1, 2, 3"),
    # sinks / maintenance
    "publish_raw": with_base(f"SELECT {FCOLS} FROM fs WHERE last_contact % 41 <> 0"),
    "stream_write_processed": with_base("SELECT icao24 AS key, * FROM hist"),
    "sink_append_table": with_base(f"SELECT *, velocity * 3.6E0 AS velocity_kmh, {STATUS} AS status FROM dirty WHERE {HAS_POS} AND {SINKABLE}"),
    "ensure_table": with_base("SELECT CAST(0 AS BIGINT) AS rows_before, count(*) AS row_count, count(*) FILTER (WHERE icao24 IS NULL) AS null_icao24, count(*) FILTER (WHERE timestamp IS NULL) AS null_timestamp FROM hist"),
    "retain_window": with_base("SELECT * FROM hist WHERE timestamp >= (SELECT max(timestamp) FROM hist) - 604800"),
    "reset_table": with_base("SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_reset, count(*) AS rows_appended FROM hist"),
    # specified analytics
    "grid_cell": with_base(f"SELECT icao24, timestamp, time_position, {cell(0.5)} AS cell FROM hist"),
    "quality_flag": with_base(f"SELECT icao24, timestamp, time_position, {qflag()} AS quality_flag FROM fs"),
    "dedup_states": _DEDUP,
    "dedup_stream": _DEDUP,
    "congestion": _CONGESTION,
    "ghost_null_callsign": with_base("SELECT icao24, timestamp, time_position, longitude, latitude FROM hist WHERE callsign IS NULL"),
    "ghost_duplicate": with_base("SELECT icao24, timestamp, count(*) AS reports, count(DISTINCT CAST(longitude AS VARCHAR) || ',' || CAST(latitude AS VARCHAR)) AS positions FROM hist60 GROUP BY 1, 2 HAVING count(DISTINCT CAST(longitude AS VARCHAR) || ',' || CAST(latitude AS VARCHAR)) > 1"),
    "position_jump": with_base("SELECT * FROM jumps"),
    "position_jump_fast": with_base("SELECT * FROM jumps60", f"jumps60 AS ({_jumps('hist60')})"),
    "route_efficiency": _route_eff(),
    "emergency_descent": with_base("SELECT * FROM descents"),
    "emergency_descent_stream": with_base("SELECT * FROM descents"),
    "corridors": with_base("SELECT timestamp - timestamp % 3600 AS hour_start, origin_country, airport_country, count(*) AS states, count(DISTINCT icao24) AS aircraft FROM withap GROUP BY 1, 2, 3"),
    "velocity_outliers": with_base("SELECT icao24, timestamp, time_position, longitude, latitude, velocity_kmh FROM hist WHERE velocity_kmh > 1100.0E0 OR velocity_kmh < 0"),
    "quality_score": with_base(f"SELECT {cell(10.0)} AS cell, count(*) AS n, round(avg(CASE WHEN {qflag('velocity * 3.6E0')} = 'OK' THEN 1.0E0 ELSE 0.0E0 END), 6) AS quality_score FROM hist GROUP BY 1"),
    "airport_ground": with_base(f"""SELECT airport_id, icao24, count(*) FILTER (WHERE NOT goes_on) AS visits, count(*) AS ground_fixes,
  min(timestamp) AS first_seen, max(timestamp) AS last_seen,
  CAST(coalesce(sum(timestamp - pt) FILTER (WHERE goes_on), 0) AS BIGINT) AS dwell_s
  FROM (SELECT *, coalesce(pa = airport_id AND timestamp - pt <= 3600, false) AS goes_on FROM (
    SELECT *, lag(airport_id) OVER w AS pa, lag(timestamp) OVER w AS pt FROM withap WHERE lower(on_ground) = 'true'
    WINDOW w AS ({ORDER_ACFT}))) GROUP BY 1, 2"""),
    "coverage_gaps": with_base(f"SELECT cell, last_seen, silence_s FROM (SELECT cell, last_seen, (SELECT max(last_contact) FROM hist) - last_seen AS silence_s FROM (SELECT {cell(10.0)} AS cell, max(last_contact) AS last_seen FROM hist GROUP BY 1)) WHERE silence_s > 60"),
    "latest_state": _LATEST,
    "latest_state_stream": _LATEST,
    "trajectory_window": with_base("SELECT icao24, timestamp - timestamp % 300 AS window_start, count(*) AS points, min(timestamp) AS first_ts, max(timestamp) AS last_ts, string_agg(printf('%d:%.2f:%.2f', timestamp, longitude, latitude), ';' ORDER BY timestamp) AS track FROM one GROUP BY 1, 2", TRAJ_ONE),
    "trajectory_stream": with_base("SELECT icao24, timestamp - timestamp % 300 AS window_start, count(DISTINCT CAST(timestamp AS VARCHAR) || ':' || CAST(longitude AS VARCHAR) || ':' || CAST(latitude AS VARCHAR)) AS points, min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM hist60 GROUP BY 1, 2"),
    "airport_broadcast_join": with_base(f"SELECT icao24, timestamp, time_position, airport_id, airport_code, round({hav('latitude', 'longitude', 'ap_lat', 'ap_lon')}, 6) AS dist_km FROM withap"),
    "archive_hourly": with_base(f"SELECT CAST(year({ts()}) AS INTEGER) AS year, CAST(month({ts()}) AS INTEGER) AS month, CAST(day({ts()}) AS INTEGER) AS day, CAST(hour({ts()}) AS INTEGER) AS hour, count(*) AS states FROM hist GROUP BY 1, 2, 3, 4"),
    "partition_freshness": with_base(f"""SELECT CAST(h AS BIGINT) AS hour_start FROM (
  SELECT unnest(generate_series((SELECT min(timestamp - timestamp % 3600) FROM thin), CAST({FRESH_AS_OF} AS BIGINT), 3600)) AS h)
  WHERE h NOT IN (SELECT timestamp - timestamp % 3600 FROM thin)""",
        "thin AS (SELECT * FROM hist WHERE CAST(floor(timestamp / 3600) AS BIGINT) % 7 <> 3)"),
    "merge_corrections": _MERGE,
    "dim_date": with_base(f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS iso_dow, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT CAST(min({ts()}) AS DATE) AS lo, CAST(max({ts()}) AS DATE) AS hi FROM hist))"""),
    "dim_time": with_base(f"""SELECT hour, {_DAY_PART} AS day_part, CAST(hour * 3600 AS BIGINT) AS seconds_from_midnight, coalesce(n, 0) AS states
  FROM (SELECT CAST(unnest(generate_series(0, 23)) AS INTEGER) AS hour) LEFT JOIN (SELECT CAST(hour({ts()}) AS INTEGER) AS hour, count(*) AS n FROM hist GROUP BY 1) USING (hour)"""),
    "dim_airports_scd2": with_base("SELECT * FROM versions", *_FEED),
    "dim_airlines": with_base("SELECT substr(trim(callsign), 1, 3) AS airline_code, count(DISTINCT icao24) AS aircraft, min(timestamp) AS first_seen, max(timestamp) AS last_seen FROM hist WHERE callsign IS NOT NULL GROUP BY 1"),
    "fact_flights": with_base(f"""SELECT md5(concat_ws('-', icao24, CAST(timestamp AS VARCHAR))) AS flight_sk,
  CAST(strftime({ts()}, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour({ts()}) AS INTEGER) AS hour,
  icao24, callsign, timestamp, time_position, origin_country, longitude, latitude, {cell(0.5)} AS cell, f.airport_id,
  v.version AS airport_version, v.utc_offset,
  round(velocity_kmh, 6) AS velocity_kmh, baro_altitude, vertical_rate, lower(on_ground) = 'true' AS on_ground, status,
  {qflag()} AS quality_flag FROM withap f LEFT JOIN versions v
  ON f.airport_id = v.airport_id AND timestamp >= valid_from AND (valid_to IS NULL OR timestamp < valid_to)""", *_FEED),
    "agg_hourly_routes": with_base(_hourly_routes("al_n"), *_alerts_of("hist", "al")),
    "agg_daily_airport_stats": _daily_airport(),
    "agg_delay_patterns": """SELECT o_orderpriority AS carrier, CAST(isodow(o_orderdate) AS INTEGER) AS iso_dow, CAST(hour(o_orderdate) AS INTEGER) AS hour, count(*) AS legs,
  round(avg((CAST(floor(epoch(l_shipdate)) AS BIGINT) - CAST(floor(epoch(o_orderdate)) AS BIGINT)) / 86400.0E0), 6) AS avg_delay_days,
  round(avg(CASE WHEN CAST(floor(epoch(l_shipdate)) AS BIGINT) - CAST(floor(epoch(o_orderdate)) AS BIGINT) > 5184000 THEN 1.0E0 ELSE 0.0E0 END), 6) AS delayed_rate
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3""",
    "busiest_routes": with_base("""SELECT window_days, origin_country, airport_country, states, CAST(rnk AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_days ORDER BY states DESC, origin_country, airport_country) AS rnk FROM (
  SELECT w.window_days, origin_country, airport_country, count(*) AS states FROM withap CROSS JOIN (VALUES (30), (90), (365)) w(window_days)
  WHERE ((SELECT max(timestamp) FROM withap) - timestamp) / 86400.0E0 < w.window_days GROUP BY 1, 2, 3)) WHERE rnk <= 20"""),
    "expectations": _expectations(),
    "alerts": with_base("""SELECT 'GHOST_NULL_CALLSIGN' AS alert_type, icao24, timestamp, longitude, latitude, CAST(NULL AS DOUBLE) AS metric FROM hist WHERE callsign IS NULL
  UNION ALL SELECT 'POSITION_JUMP', icao24, timestamp, longitude, latitude, km_per_min FROM jumps
  UNION ALL SELECT 'EMERGENCY_DESCENT', icao24, timestamp, longitude, latitude, vertical_rate FROM descents
  UNION ALL SELECT 'VELOCITY_OUTLIER', icao24, timestamp, longitude, latitude, round(velocity_kmh, 6) FROM hist WHERE velocity_kmh > 1100.0E0 OR velocity_kmh < 0"""),
    "bbox_filter": with_base(f"SELECT icao24, timestamp, time_position, longitude, latitude FROM hist WHERE latitude BETWEEN {EUROPE[0]}E0 AND {EUROPE[1]}E0 AND longitude BETWEEN {EUROPE[2]}E0 AND {EUROPE[3]}E0"),
    "bbox_filter_antimeridian": with_base(f"SELECT icao24, timestamp, time_position, longitude, latitude FROM hist WHERE latitude BETWEEN {PACIFIC[0]}E0 AND {PACIFIC[1]}E0 AND (longitude >= {PACIFIC[2]}E0 OR longitude <= {PACIFIC[3]}E0)"),
    "replay": with_base("SELECT * FROM hist"),
    "continuous_agg": with_base("SELECT timestamp - timestamp % 3600 AS hour_start, origin_country, count(*) AS states, round(sum(velocity_kmh) / count(velocity_kmh), 6) AS avg_velocity_kmh FROM hist GROUP BY 1, 2"),
    "pipeline_health": with_base("""SELECT l.window_start, round(coalesce(r.messages, 0) / 60.0E0, 9) AS messages_per_second, l.lag,
  CAST(coalesce(a.age, 0) AS BIGINT) AS oldest_age_s, coalesce(a.age, 0) > 300 AS lag_alert
  FROM slow l LEFT JOIN (SELECT timestamp - timestamp % 60 AS window_start, count(*) AS messages FROM fs60 GROUP BY 1) r ON l.window_start = r.window_start
  LEFT JOIN (SELECT e - 60 AS window_start, e - min(timestamp) AS age FROM (
    SELECT timestamp, timestamp + timestamp % 601 AS c, unnest(generate_series(timestamp - timestamp % 60 + 60, timestamp + timestamp % 601, 60)) AS e FROM hist60)
    WHERE e < c GROUP BY e) a ON l.window_start = a.window_start""",
        next(x for x in BASE if x.startswith("lagq")).replace("lagq AS", "slow AS").replace("(time_position + 10)", "(timestamp + timestamp % 601)")),
    "validate_schema": with_base("SELECT timestamp % 11 <> 0 AS accepted, count(*) AS messages FROM fs GROUP BY 1"),
    "airline_lookup": with_base(f"SELECT icao24, timestamp, time_position, substr(trim(callsign), 1, 3) AS airline_code, a.airline_name FROM hist LEFT JOIN (VALUES {_airlines_values()}) a(airline_code, airline_name) ON substr(trim(hist.callsign), 1, 3) = a.airline_code"),
    "cell_center": with_base(f"SELECT icao24, timestamp, time_position, cell, round(floor(cell / 720) * 0.5E0 - 90.0E0 + 0.25E0, 6) AS center_lat, round((cell % 720) * 0.5E0 - 180.0E0 + 0.25E0, 6) AS center_lon FROM (SELECT *, {cell(0.5)} AS cell FROM hist)"),
    "congestion_stream": _CONGESTION,
}

ORACLE.update({
    "hourly_aircraft": with_base("SELECT timestamp - timestamp % 3600 AS hour_start, count(DISTINCT icao24) AS aircraft, count(*) AS states FROM hist GROUP BY 1"),
    "corridors_od_matrix": with_base("SELECT origin_country, " + ", ".join(
        f"count(*) FILTER (WHERE airport_country = '{c}') AS \"{c}\"" for c in COUNTRIES) + " FROM withap GROUP BY origin_country"),
    "pipeline_counters_stream": with_base(f"SELECT count(*) AS consumed, count(*) FILTER (WHERE {SINKABLE}) AS success, count(*) FILTER (WHERE NOT coalesce({SINKABLE}, false)) AS skipped FROM dirty WHERE {HAS_POS}"),
    "stream_progress": with_base("SELECT count(*) AS input_rows FROM fs"),
    "merge_corrections_table": _MERGE,
    "trajectory_stream": ORACLE["trajectory_window"],
    "archive_retention": with_base(f"""SELECT CAST(year({ts()}) AS INTEGER) AS year, CAST(month({ts()}) AS INTEGER) AS month,
  CAST(day({ts()}) AS INTEGER) AS day, CAST(hour({ts()}) AS INTEGER) AS hour, count(*) AS states
  FROM hist WHERE timestamp - timestamp % 3600 + 3600 > (SELECT max(timestamp) FROM hist) - 864000 GROUP BY 1, 2, 3, 4"""),
    "recent_flights_table": ORACLE["recent_flights"],
    "alerts_stream": ORACLE["alerts"],
    "agg_hourly_routes_stored": with_base(_hourly_routes("al_n"), _MERGED_ROWS[1], f"merged AS ({_MERGED_ROWS[0]})", *_alerts_of("merged", "al")),
    "message_backlog": with_base("""SELECT CAST(e - 60 AS BIGINT) AS window_start, count(*) AS pending, CAST(e - min(p) AS BIGINT) AS oldest_age_s
  FROM (SELECT unnest(generate_series((SELECT min(p - p % 60 + 60) FROM msg), (SELECT max(greatest(p - p % 60 + 60, coalesce(c + (60 - c % 60) % 60, 0))) FROM msg), 60)) AS e)
  JOIN msg ON p < e AND (c IS NULL OR c > e) GROUP BY e""",
        "msg AS (SELECT timestamp AS p, CASE WHEN right(icao24, 2) <> '0f' THEN timestamp + timestamp % 601 END AS c FROM hist60)"),
    "insert_errors": with_base(f"""SELECT outcome, count(*) AS messages, count(*) AS observed FROM (
  SELECT CASE WHEN timestamp % 17 = 7 THEN 'error_undecodable' WHEN NOT coalesce({SINKABLE}, false) THEN 'skipped'
    WHEN timestamp % 17 = 3 THEN 'error_time_range' WHEN timestamp % 17 = 5 AND callsign IS NOT NULL THEN 'error_text_nul'
    ELSE 'success' END AS outcome FROM dirty WHERE {HAS_POS}) WHERE outcome <> 'skipped' GROUP BY 1"""),
    "latest_state_ttl_stream": _LATEST,
    "ingest_counters": with_base("""SELECT (SELECT count(DISTINCT timestamp) + count(DISTINCT timestamp) FILTER (WHERE timestamp % 10 < 2) FROM fs) AS polls_total,
  count(*) FILTER (WHERE last_contact % 41 <> 0) AS flights_sent_total,
  (SELECT count(DISTINCT timestamp) FILTER (WHERE timestamp % 10 = 1) FROM fs) AS errors_fetch,
  count(*) FILTER (WHERE last_contact % 41 = 0) AS errors_malformed FROM fs"""),
    "histogram_request_duration": with_base("SELECT split_part(label, ' ', 2) AS path, split_part(label, ' ', 1) AS method, le, bucket_count FROM hb",
                                            _hist_buckets(DEFAULT_DURATION_BOUNDS, "req", "duration_s", "series")),
    "request_duration_p95": _quantile(_hist_buckets(DEFAULT_DURATION_BOUNDS, "req", "duration_s", "path"), "path"),
    "histogram_query_duration": with_base("SELECT label AS query_name, le, bucket_count FROM hb",
                                          _hist_buckets(DB_DURATION_BOUNDS, "req", "query_duration_s", "query_name")),
    "query_metrics": with_base("SELECT query_name, count(*) AS queries, round(sum(query_duration_s), 6) AS duration_sum, round(avg(query_duration_s), 6) AS duration_avg, count(*) FILTER (WHERE status >= 500) AS errors FROM req WHERE query_name IS NOT NULL GROUP BY 1"),
    "histogram_page_size": with_base("SELECT label AS path, le, bucket_count FROM hb",
                                     _hist_buckets(PAGE_SIZE_BOUNDS, "req", "flights_served", "path")),
    "avg_flights_per_request": with_base("SELECT ts - ts % 3600 AS window_start, path, count(*) AS n, round(sum(flights_served) / count(*), 6) AS avg_value FROM req WHERE flights_served IS NOT NULL GROUP BY 1, 2"),
})
