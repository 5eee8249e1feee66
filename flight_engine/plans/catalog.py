"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (or data Spark derives from them) in
full.  Queries that exercise sinks or streams write to a fresh folder
under the shared checkpoint root and return a batch read of the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flight_engine.files import delete_at_end
from flight_engine.operators import anomalies as an
from flight_engine.operators import metrics as mt
from flight_engine.operators import serve as sv
from flight_engine.operators import sink as sk
from flight_engine.operators import spatial as sp
from flight_engine.operators import warehouse as wh
from flight_engine.operators.quality import validate_messages
from flight_engine.operators.transform import (
    clean, enrich, parse_raw, process, process_raw, serialize_keyed, serialize_unkeyed,
)
from flight_engine.schema import (
    API_COLUMNS, ENVELOPE_SCHEMA, FLIGHT_COLUMNS, PROCESSED_COLUMNS, PROCESSED_SCHEMA,
)
from flight_engine.session import scratch_path
from flight_engine.sources import snapshot as snap
from flight_engine.sources import testdata as td
from flight_engine.streaming import alerts as al
from flight_engine.streaming import pipeline as pl
from flight_engine.streaming import stateful as st

Query = Callable[[SparkSession, str], DataFrame]
FAST = 60  # time compression of the dense (12 h) variant

# Page-size arguments exercised by the parse_limit query and their results.
LIMIT_CASES = [("", 50), ("25", 25), ("abc", 50), ("999", 500), ("0", 50), ("-1", 50),
               ("+5", 5), ("5.0", 50), ("99999999999999999999", 50)]
EUROPE = (35.0, 72.0, -25.0, 45.0)
PACIFIC = (-50.0, -10.0, 170.0, -170.0)  # crosses the antimeridian


def states(spark, sf, k=1) -> DataFrame:
    return td.flight_states(spark, sf, k)


def history(spark, sf, k=1) -> DataFrame:
    """The stored table: transformed, guarded states (PROCESSED columns)."""
    return sk.filter_sinkable(process(states(spark, sf, k))).select(*PROCESSED_COLUMNS)


def dirty(spark, sf, k=1) -> DataFrame:
    return td.dirty_states(states(spark, sf, k))


def page(spark, sf, n=500) -> DataFrame:
    return sv.recent_flights(history(spark, sf), n)


def _docs(spark, sf):
    return snap.snapshot_documents(states(spark, sf))


# ---- sources -------------------------------------------------------------

def q_scan_snapshot_decode(spark, sf):
    return snap.decode_snapshot(_docs(spark, sf))


def q_stream_read_raw(spark, sf):
    raw = scratch_path(spark, "raw")
    pl.write_messages(states(spark, sf), raw, fmt="json")
    out, ck = scratch_path(spark, "raw-out"), scratch_path(spark, "raw-ck")
    src = pl.file_source(spark, raw, fmt="json")
    pl.run_until_caught_up(pl.stream_to_parquet(parse_raw(src), out, ck))
    return spark.read.parquet(out).select(*FLIGHT_COLUMNS)


def q_parse_json_typed(spark, sf):
    return parse_raw(serialize_unkeyed(states(spark, sf)))


def q_consume_processed(spark, sf):
    proc = scratch_path(spark, "processed")
    pl.write_messages(history(spark, sf), proc, keyed=True)
    out, ck = scratch_path(spark, "consumed"), scratch_path(spark, "consumed-ck")
    src = pl.file_source(spark, proc, fmt="json")
    pl.run_until_caught_up(pl.stream_to_parquet(sk.normalize_record(src), out, ck))
    return spark.read.parquet(out).select(*PROCESSED_COLUMNS)


def q_scan_history_table(spark, sf):
    path = scratch_path(spark, "history")
    sk.append_batch(history(spark, sf), path)
    return spark.read.parquet(path).select(*PROCESSED_COLUMNS)


def q_read_from_beginning_bounded(spark, sf, n=1000):
    raw = scratch_path(spark, "raw-topic")
    pl.write_messages(states(spark, sf), raw, fmt="parquet")
    msgs = parse_raw(spark.read.parquet(raw))
    return msgs.orderBy("timestamp", "icao24", "time_position").limit(n)


# ---- projections / filters / expressions ----------------------------------

def q_filter_malformed_state(spark, sf):
    return snap.malformed_counts(_docs(spark, sf))


def q_stamp_snapshot_time(spark, sf):
    return snap.decode_snapshot(_docs(spark, sf)).select("icao24", "last_contact", "timestamp")


def q_filter_has_position(spark, sf):
    return clean(states(spark, sf))


def q_enrich_velocity_kmh(spark, sf):
    return enrich(clean(states(spark, sf))).select("icao24", "timestamp", "time_position",
                                                   "velocity", "velocity_kmh")


def q_enrich_status(spark, sf):
    return enrich(clean(states(spark, sf))).select("icao24", "timestamp", "time_position",
                                                   "vertical_rate", "status")


def q_status_counts(spark, sf):
    return history(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def q_serialize_keyed_json(spark, sf):
    env = serialize_keyed(history(spark, sf))
    return env.select("key", F.from_json("value", PROCESSED_SCHEMA).alias("r")).select("key", "r.*")


def q_normalize_record(spark, sf):
    h = history(spark, sf)
    partial = F.to_json(F.struct("icao24", "timestamp"))
    msgs = h.select(F.when(F.col("timestamp") % 7 == 0, partial)
                    .otherwise(F.to_json(F.struct(*[F.col(c) for c in h.columns]))).alias("value"))
    return sk.normalize_record(msgs)


def q_filter_sinkable(spark, sf):
    return sk.filter_sinkable(dirty(spark, sf))


def q_api_projection(spark, sf):
    return history(spark, sf).select(*API_COLUMNS)


def q_display_table(spark, sf):
    return sv.display_table(page(spark, sf))


def q_status_color(spark, sf):
    return sv.status_colors(history(spark, sf))


def q_geojson_features(spark, sf):
    return sv.geojson_features(page(spark, sf))


def q_popup_label(spark, sf):
    return sv.popup_label(sv.geojson_features(page(spark, sf)))


def q_page_positions(spark, sf):
    return sv.page_positions(page(spark, sf))


def q_interpolate_positions(spark, sf):
    return sv.interpolate_positions(history(spark, sf))


# ---- sorts / limits ------------------------------------------------------

def q_recent_flights(spark, sf):
    return sv.recent_flights(history(spark, sf), "")


def q_parse_limit(spark, sf):
    # the largest page once; every other page is a beginning of it
    page_ = sv.recent_flights(history(spark, sf), str(sv.MAX_LIMIT))
    ranked = (page_.select(F.monotonically_increasing_id().alias("i"), F.struct("*").alias("r"))
              .agg(F.sort_array(F.collect_list(F.struct("i", "r"))).alias("rows")))
    cases = F.array(*[F.struct(F.lit(arg).alias("limit_arg"), F.lit(sv.parse_limit(arg)).alias("n")) for arg, _ in LIMIT_CASES])
    each = ranked.select("rows", F.explode(cases).alias("c"))
    return (each.select("c.limit_arg", F.explode(F.slice("rows", F.lit(1), F.col("c.n"))).alias("e"))
            .select("e.r.*", "limit_arg"))


def q_peek_rows(spark, sf):
    return sv.peek_rows(history(spark, sf))


def q_slowest_requests(spark, sf):
    return mt.slowest_requests(td.request_events(spark, sf))


# ---- aggregations --------------------------------------------------------

def q_count_rows(spark, sf):
    return history(spark, sf).agg(F.count(F.lit(1)).alias("row_count"))


def q_dashboard_header(spark, sf):
    return sv.dashboard_header(page(spark, sf))


def q_pipeline_counters(spark, sf):
    return mt.pipeline_counters(dirty(spark, sf))


def q_histogram_buckets(spark, sf):
    return mt.histogram_buckets(td.metric_events(spark, sf), mt.PAGE_SIZE_BOUNDS).drop("idx", "upper")


def q_rate_per_window(spark, sf):
    return mt.rate_per_window(td.metric_events(spark, sf))


def q_histogram_quantile_p95(spark, sf):
    b = mt.histogram_buckets(td.metric_events(spark, sf), mt.PAGE_SIZE_BOUNDS)
    return mt.histogram_quantile(b, 0.95)


def q_avg_per_window(spark, sf):
    return mt.avg_per_window(td.metric_events(spark, sf))


def _lag(spark, sf):
    s = states(spark, sf, FAST)
    consumed = history(spark, sf, FAST).withColumn("consumed_at", F.col("time_position") + 10)
    return mt.consumer_lag(s, consumed, "timestamp", "consumed_at")


def q_consumer_lag(spark, sf):
    return _lag(spark, sf)


def q_request_metrics(spark, sf):
    return mt.request_metrics(td.request_events(spark, sf))


# ---- sinks / maintenance -------------------------------------------------

def q_publish_raw(spark, sf):
    raw = scratch_path(spark, "published")
    decoded = snap.decode_snapshot(_docs(spark, sf))
    pl.write_messages(decoded, raw, fmt="json")
    return parse_raw(spark.read.schema(ENVELOPE_SCHEMA).json(raw))


def q_stream_write_processed(spark, sf):
    raw = scratch_path(spark, "raw")
    pl.write_messages(states(spark, sf), raw, fmt="json")
    out, ck = scratch_path(spark, "processed"), scratch_path(spark, "processed-ck")
    pl.run_until_caught_up(pl.stream_transform(pl.file_source(spark, raw, "json"), out, ck))
    env = spark.read.schema(ENVELOPE_SCHEMA).json(out)
    return env.select("key", F.from_json("value", PROCESSED_SCHEMA).alias("r")).select("key", "r.*")


def q_sink_append_table(spark, sf):
    proc = scratch_path(spark, "processed")
    pl.write_messages(process(dirty(spark, sf)), proc, keyed=True)
    table, ck = scratch_path(spark, "table"), scratch_path(spark, "table-ck")
    pl.run_until_caught_up(pl.stream_sink_table(pl.file_source(spark, proc, "json"), table, ck))
    return spark.read.parquet(table).select(*PROCESSED_COLUMNS)


def q_ensure_table(spark, sf):
    path = scratch_path(spark, "ensured")
    sk.ensure_table(spark, path)
    sk.ensure_table(spark, path)  # idempotent
    empty = spark.read.parquet(path).count()
    sk.append_batch(history(spark, sf), path)
    t = spark.read.parquet(path)
    return t.agg(F.lit(empty).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("row_count"),
                 F.count(F.when(F.col("icao24").isNull(), 1)).alias("null_icao24"),
                 F.count(F.when(F.col("timestamp").isNull(), 1)).alias("null_timestamp"))


def q_retain_window(spark, sf):
    path = scratch_path(spark, "retained")
    sk.append_batch(history(spark, sf), path)
    sk.retain_table(spark, path, days=7)
    return spark.read.parquet(path).select(*PROCESSED_COLUMNS)


def q_reset_table(spark, sf):
    """Rows of the same table before, after the reset, and after the next append."""
    path = scratch_path(spark, "reset")
    h = history(spark, sf)
    sk.append_batch(h, path)
    before = spark.read.parquet(path).count()
    sk.reset_table(spark, path)
    after = spark.read.parquet(path).count()
    sk.append_batch(h, path)
    return spark.read.parquet(path).agg(
        F.lit(before).cast("bigint").alias("rows_before"), F.lit(after).cast("bigint").alias("rows_reset"),
        F.count(F.lit(1)).alias("rows_appended"))


# ---- specified analytics -------------------------------------------------

def q_grid_cell(spark, sf):
    from flight_engine.functions.geo import grid_cell
    return history(spark, sf).select("icao24", "timestamp", "time_position",
                                     grid_cell().alias("cell"))


def q_quality_flag(spark, sf):
    return an.quality_flag(states(spark, sf))


def q_dedup_states(spark, sf):
    return an.dedup_states(sk.filter_sinkable(dirty(spark, sf)))


def q_congestion(spark, sf):
    return an.congestion(history(spark, sf, FAST), deg=30.0)


def q_ghost_null_callsign(spark, sf):
    return an.ghost_null_callsign(history(spark, sf))


def q_ghost_duplicate(spark, sf):
    return an.ghost_duplicate(history(spark, sf, FAST))


def q_position_jump(spark, sf):
    return an.position_jump(history(spark, sf))


def q_position_jump_fast(spark, sf):
    return an.position_jump(history(spark, sf, FAST))


def q_route_efficiency(spark, sf):
    return sp.route_efficiency(history(spark, sf))


def q_emergency_descent(spark, sf):
    return an.emergency_descent(history(spark, sf))


def q_corridors(spark, sf):
    return sp.corridors(history(spark, sf), td.airports(spark, sf))


def q_velocity_outliers(spark, sf):
    return an.velocity_outliers(history(spark, sf))


def q_quality_score(spark, sf):
    return an.quality_score(history(spark, sf), deg=10.0)


def q_airport_ground(spark, sf):
    return sp.airport_ground(history(spark, sf), td.airports(spark, sf))


def q_coverage_gaps(spark, sf):
    return an.coverage_gaps(history(spark, sf), deg=10.0)


def q_latest_state(spark, sf):
    return an.latest_state(history(spark, sf, FAST))


def q_trajectory_window(spark, sf):
    return wh.trajectory_window(history(spark, sf, FAST))


def q_airport_broadcast_join(spark, sf):
    return sp.airport_broadcast_join(history(spark, sf), td.airports(spark, sf))


def q_archive_hourly(spark, sf, retention_days=90):
    path = scratch_path(spark, "archive")
    (wh.archive_partitions(history(spark, sf)).write.mode("overwrite")
     .partitionBy("year", "month", "day", "hour").parquet(path))
    a = spark.read.parquet(path)
    return a.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("states"))


EXPECT_AS_OF = 1706140800  # 2024-01-25T00:00:00Z: states of the last days lie in its future
FRESH_AS_OF = 1706745600  # 2024-02-01T00:00:00Z, after the last state


def q_partition_freshness(spark, sf):
    """Missing hours of a history that lost every seventh hour, up to a fixed present."""
    h = history(spark, sf)
    return wh.partition_freshness(h.where(F.floor(F.col("timestamp") / 3600) % 7 != 3), FRESH_AS_OF)


def _corrections(h):
    return (h.where(F.col("timestamp") % 13 == 0)
            .withColumn("velocity", F.col("velocity") * 1.1)
            .withColumn("velocity_kmh", F.col("velocity") * 3.6)
            .withColumn("last_contact", F.col("last_contact") + 2))


def q_merge_corrections(spark, sf):
    h = history(spark, sf)
    return wh.merge_corrections(h, _corrections(h))


def q_dim_date(spark, sf):
    return wh.dim_date(history(spark, sf))


def q_dim_time(spark, sf):
    return wh.dim_time(history(spark, sf))


def _airport_versions(spark, sf):
    """The dimension after three batches of the feed, whose changes are mixed in time."""
    feed = td.airport_changes(spark, sf)
    return wh.dim_airports_scd2(spark, scratch_path(spark, "dim-airports"), [feed.where(F.col("seq") % 3 == k) for k in range(3)])


def q_dim_airports_scd2(spark, sf):
    return _airport_versions(spark, sf)


def q_dim_airlines(spark, sf):
    return wh.dim_airlines(history(spark, sf))


def q_fact_flights(spark, sf):
    return wh.fact_flights(history(spark, sf), td.airports(spark, sf), _airport_versions(spark, sf))


def q_agg_hourly_routes(spark, sf):
    return wh.agg_hourly_routes(history(spark, sf))


def _kept(df: DataFrame) -> DataFrame:
    """``df`` worked out once, in the shared scratch folder."""
    spark = df.sparkSession
    path = scratch_path(spark, "kept")
    df.write.parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def q_agg_hourly_routes_stored(spark, sf):
    """Hourly routes kept from three appended batches and a batch of corrections."""
    path = scratch_path(spark, "hourly-routes")
    h = history(spark, sf)
    part = F.floor((F.col("timestamp") - td.EPOCH_BASE) / (10 * 86400))
    merged = _kept(wh.merge_corrections(h, _corrections(h)))
    tables = [*[h.where(part <= k) for k in range(2)], h, merged]
    fixes = [_kept(wh.route_fixes(t)) for t in tables]  # of two steps each
    for k, (old, new) in enumerate(zip([fixes[0].limit(0), *fixes], fixes)):
        wh.maintain_hourly_routes(path, f"b{k}", old, new)
    return wh.read_hourly_routes(spark, path)


def q_agg_daily_airport_stats(spark, sf):
    return wh.agg_daily_airport_stats(history(spark, sf), td.airports(spark, sf))


def q_agg_delay_patterns(spark, sf):
    return wh.agg_delay_patterns(td.schedule(spark, sf))


def _corridor_rows(spark, sf):
    return sp.with_airport(history(spark, sf), td.airports(spark, sf))


def q_busiest_routes(spark, sf):
    return wh.busiest_routes(_corridor_rows(spark, sf))


def q_expectations(spark, sf):
    nation = td.table(spark, sf, "nation").select("n_name")
    return wh.expectations(process(dirty(spark, sf)), nation, as_of=EXPECT_AS_OF)


def q_alerts(spark, sf):
    return an.alerts(history(spark, sf))


def q_alerts_stream(spark, sf):
    """The alerts topic, published by one stateful stream over the history."""
    return al.alerts_stream(spark, history(spark, sf))


def q_bbox_filter(spark, sf):
    return sp.bbox_filter(history(spark, sf), *EUROPE).select(
        "icao24", "timestamp", "time_position", "longitude", "latitude")


def q_bbox_filter_antimeridian(spark, sf):
    return sp.bbox_filter(history(spark, sf), *PACIFIC).select(
        "icao24", "timestamp", "time_position", "longitude", "latitude")


def q_replay(spark, sf):
    raw = scratch_path(spark, "replay-src")
    pl.write_messages(states(spark, sf), raw, fmt="parquet")
    out, ck = scratch_path(spark, "replay-out"), scratch_path(spark, "replay-ck")
    src = pl.file_source(spark, raw, "parquet")
    pl.run_until_caught_up(pl.stream_to_parquet(process_raw(src), out, ck))
    return spark.read.parquet(out).select(*PROCESSED_COLUMNS)


def q_continuous_agg(spark, sf):
    return st.continuous_hourly(spark, states(spark, sf))


def q_pipeline_health(spark, sf):
    """Health against a consumer that takes up to ten minutes; over five is an alert."""
    s = states(spark, sf, FAST)
    rates = mt.rate_per_window(s.select(F.col("timestamp").alias("ts"), F.lit("raw").alias("label")))
    consumed = history(spark, sf, FAST).withColumn("consumed_at", F.col("timestamp") + F.col("timestamp") % 601)
    return mt.pipeline_health(rates, mt.consumer_lag(s, consumed, "timestamp", "consumed_at"),
                              mt.backlog_age(consumed, "timestamp", "consumed_at"))


def q_message_backlog(spark, sf):
    """Waiting messages per minute against a consumer that never takes some aircraft's messages."""
    t = F.col("timestamp")
    consumed = F.when(F.substring("icao24", -2, 2) != "0f", t + t % 601)
    return mt.backlog_age(history(spark, sf, FAST).withColumn("consumed_at", consumed), "timestamp", "consumed_at")


def _flawed_messages(spark, sf):
    """Processed messages of which some are cut off, some in milliseconds and some hold a NUL character."""
    rows = process(dirty(spark, sf))
    t = F.col("timestamp")
    late = rows.withColumn("timestamp", F.when(t % 17 == 3, t * 1000).otherwise(t)).withColumn(
        "callsign", F.when(t % 17 == 5, F.concat("callsign", F.lit("\x00"))).otherwise(F.col("callsign")))
    value = F.to_json(F.struct(*[F.col(c) for c in PROCESSED_COLUMNS]))
    cut = F.when(t % 17 == 7, F.expr("substring(value, 1, 20)")).otherwise(F.col("value"))
    return late.select("timestamp", F.col("icao24").alias("key"), value.alias("value")).select("key", cut.alias("value"))


def q_insert_errors(spark, sf):
    """Sink outcomes by reason, from the stored table and the dead letters, after a replay of the batch."""
    proc = scratch_path(spark, "flawed")
    _flawed_messages(spark, sf).write.parquet(proc)
    table, dead, ck = (scratch_path(spark, f"checked-{n}") for n in ("table", "dead", "ck"))
    events = pl.run_logged(spark, lambda: pl.stream_sink_checked(pl.file_source(spark, proc, "parquet"), table, dead, ck))
    judged = sk.judged_records(spark.read.parquet(proc))
    batches = sk.dead_letters(spark, dead).select("batch").distinct().collect()  # one a micro-batch
    for b in batches if len(batches) == 1 else []:  # the batch again, as after a lost driver
        sk.write_dead_letters(judged, dead, b[0])
    counted = {}
    for e in events:
        for k, v in (e.get("observedMetrics", {}).get(pl.SINK_METRICS) or {}).items():
            counted[k] = counted.get(k, 0) + int(v)
    errors = sk.dead_letters(spark, dead).groupBy(F.concat(F.lit("error_"), "reason").alias("outcome")).agg(F.count(F.lit(1)).alias("messages"))
    stored = spark.read.parquet(table).agg(F.lit("success").alias("outcome"), F.count(F.lit(1)).alias("messages"))
    observed = F.create_map(*[F.lit(x) for kv in counted.items() for x in kv])
    return errors.union(stored).select("outcome", "messages", F.try_element_at(observed, F.col("outcome")).cast("bigint").alias("observed"))


def q_validate_schema(spark, sf):
    s = states(spark, sf)
    body = F.to_json(F.struct(*[F.col(c) for c in s.columns]))
    # every 11th snapshot's messages arrive truncated (not valid JSON)
    raw = s.select(F.when(F.col("timestamp") % 11 == 0, F.substring(body, 1, 40))
                   .otherwise(body).alias("value"))
    v = validate_messages(raw)
    return v.groupBy("accepted").agg(F.count(F.lit(1)).alias("messages"))


def q_airline_lookup(spark, sf):
    return sp.airline_lookup(history(spark, sf), sp.airlines_table(spark))


def q_cell_center(spark, sf):
    c = sp.cell_center(history(spark, sf))
    return c.select("icao24", "timestamp", "time_position", "cell",
                    F.round("center_lat", 6).alias("center_lat"),
                    F.round("center_lon", 6).alias("center_lon"))


def q_emergency_descent_stream(spark, sf):
    return st.descent_stream(spark, history(spark, sf))


def q_latest_state_stream(spark, sf):
    return st.latest_state_stream(spark, history(spark, sf, FAST))


def q_dedup_stream(spark, sf):
    return st.dedup_stream(spark, sk.filter_sinkable(dirty(spark, sf)))


def q_congestion_stream(spark, sf):
    return st.congestion_stream(spark, history(spark, sf, FAST), deg=30.0)


def q_trajectory_stream(spark, sf):
    return st.trajectory_stream(spark, history(spark, sf, FAST))


# ---- added: series, pivots, stream metrics, table maintenance ------------------

def q_hourly_aircraft(spark, sf):
    return wh.hourly_aircraft(history(spark, sf))


def q_corridors_od_matrix(spark, sf):
    """Wide OD matrix over the countries of the nation table."""
    countries = [r[0] for r in td.table(spark, sf, "nation").select("n_name").distinct().orderBy("n_name").collect()]
    return sp.od_matrix(_corridor_rows(spark, sf), countries)


def q_pipeline_counters_stream(spark, sf):
    """Sink counters observed inside the streaming sink, summed over its micro-batches."""
    proc = scratch_path(spark, "processed")
    pl.write_messages(process(dirty(spark, sf)), proc, keyed=True)
    table, ck = scratch_path(spark, "table"), scratch_path(spark, "table-ck")
    src = pl.file_source(spark, proc, "json")
    events = pl.run_logged(spark, lambda: pl.stream_sink_table(src, table, ck))
    tot = {"consumed": 0, "success": 0, "skipped": 0}
    for e in events:
        m = e.get("observedMetrics", {}).get(pl.SINK_METRICS)
        for k in tot:
            tot[k] += int(m[k]) if m else 0
    return spark.createDataFrame([(tot["consumed"], tot["success"], tot["skipped"])],
                                 "consumed bigint, success bigint, skipped bigint")


def q_stream_progress(spark, sf):
    """Rows consumed by the stream transform, from its per-batch progress events."""
    raw = scratch_path(spark, "raw")
    pl.write_messages(states(spark, sf), raw, fmt="json")
    out, ck = scratch_path(spark, "processed"), scratch_path(spark, "processed-ck")
    src = pl.file_source(spark, raw, "json")
    events = pl.run_logged(spark, lambda: pl.stream_transform(src, out, ck))
    return pl.progress_table(spark, events).agg(F.sum("input_rows").cast("bigint").alias("input_rows"))


def q_merge_corrections_table(spark, sf):
    h = history(spark, sf)
    path = scratch_path(spark, "merge-table")
    sk.append_batch(h, path)
    corr = _corrections(h).withColumn("created_at", F.current_timestamp())
    wh.merge_into_partitioned(spark, path, corr, scratch_path(spark, "merge-staging"))
    return spark.read.parquet(path).select(*PROCESSED_COLUMNS)


def q_archive_retention(spark, sf, retention_days=10):
    """Hourly archive as a catalog table; partitions older than the retention go, files too."""
    import uuid
    name = f"archive_{uuid.uuid4().hex[:8]}"
    h = history(spark, sf)
    (wh.archive_partitions(h).write.partitionBy("year", "month", "day", "hour")
     .option("path", scratch_path(spark, name)).saveAsTable(name))
    as_of = h.select(F.max("timestamp")).first()[0]
    wh.drop_expired_partitions(spark, name, as_of, retention_days)
    return (spark.table(name).groupBy("year", "month", "day", "hour")
            .agg(F.count(F.lit(1)).alias("states")))


def q_recent_flights_table(spark, sf):
    """Newest-first page served from the stored, day-partitioned history table."""
    path = scratch_path(spark, "served")
    sk.append_batch(history(spark, sf), path)
    return sv.recent_flights_from_table(spark, path, "")


def q_latest_state_ttl_stream(spark, sf):
    """Latest state kept by a TTL-evicting state processor (bounded by active aircraft)."""
    return st.latest_state_ttl_stream(spark, history(spark, sf, FAST))


def _series(spark, sf):
    return td.request_events(spark, sf).withColumn("series", F.concat_ws(" ", "method", "path"))


def q_histogram_request_duration(spark, sf):
    """Request-duration histogram by path and method."""
    b = mt.histogram_buckets(_series(spark, sf), mt.DEFAULT_DURATION_BOUNDS, value="duration_s", label="series")
    part = F.split("series", " ")
    return b.select(part[1].alias("path"), part[0].alias("method"), "le", "bucket_count")


def q_request_duration_p95(spark, sf):
    b = mt.histogram_buckets(td.request_events(spark, sf), mt.DEFAULT_DURATION_BOUNDS,
                             value="duration_s", label="path")
    return mt.histogram_quantile(b, 0.95, label="path")


def q_histogram_query_duration(spark, sf):
    """Database-query duration histogram by query name."""
    named = td.request_events(spark, sf).where("query_name is not null")
    return mt.histogram_buckets(named, mt.DB_DURATION_BOUNDS, value="query_duration_s", label="query_name").drop("idx", "upper")


def q_query_metrics(spark, sf):
    return mt.query_metrics(td.request_events(spark, sf))


def q_histogram_page_size(spark, sf):
    """Flights served per request, by path."""
    return mt.histogram_buckets(td.request_events(spark, sf), mt.PAGE_SIZE_BOUNDS, value="flights_served", label="path").drop("idx", "upper")


def q_avg_flights_per_request(spark, sf):
    return mt.avg_per_window(td.request_events(spark, sf), value="flights_served", label="path", seconds=3600)


def q_ingest_counters(spark, sf):
    """Counters over the snapshots, polls without states, and polls that failed."""
    times = states(spark, sf).select("timestamp").distinct()
    idle = times.where("timestamp % 10 = 0").select(F.format_string('{"time":%d,"states":null}', -F.col("timestamp")).alias("value"))
    failed = times.where("timestamp % 10 = 1").select(F.lit("").alias("value"))
    return snap.ingest_counters(_docs(spark, sf).union(idle).union(failed))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
