"""Dwell by day with visits cut at midnight, and hourly routes kept from differences."""

from pyspark.sql import functions as F

from flight_engine.operators import spatial as sp
from flight_engine.operators import warehouse as wh
from flight_engine.session import scratch_path

DAY = 86400
SCHEMA = ("icao24 string, callsign string, origin_country string, timestamp long, time_position long, longitude double, latitude double, "
          "on_ground string, velocity double, velocity_kmh double, vertical_rate double, baro_altitude double")


def airports(spark):
    return spark.createDataFrame([(1, "AP1", "A", 0.0, 0.0), (2, "AP2", "B", 0.0, 50.0)],
                                 "airport_id long, airport_code string, country string, ap_lat double, ap_lon double")


def fixes(spark, rows):
    """(aircraft, timestamp, longitude, on ground)"""
    return spark.createDataFrame([(a, "AAL1", "A", t, t, lon, 0.0, str(g).lower(), 100.0, 360.0, 0.0, 1000.0) for a, t, lon, g in rows], SCHEMA)


def test_a_visit_over_two_midnights(spark):
    # from 23:00 of day 0 to 02:00 of day 2 with a fix every half hour: 1 h, 24 h and 2 h
    stay = [("a", 23 * 3600 + 1800 * i, 0.0, True) for i in range(2 * 27 + 1)]
    # a second aircraft is there on day 1 for ten minutes, and elsewhere later
    other = [("b", DAY + 3600, 0.1, True), ("b", DAY + 4200, 0.1, True), ("b", DAY + 4800, 50.0, True), ("b", DAY + 4900, 50.0, False)]
    h = fixes(spark, stay + other)
    got = {(r.airport_id, r.day): (r.visits, r.dwell_s, r.ground_dwell_avg_min) for r in sp.ground_dwell_by_day(h, airports(spark)).collect()}
    assert got == {(1, "1970-01-01"): (1, 3600, 60.0), (1, "1970-01-02"): (2, 24 * 3600 + 600, round((24 * 60 + 10) / 2, 6)),
                   (1, "1970-01-03"): (1, 7200, 120.0), (2, "1970-01-02"): (1, 0, 0.0)}
    daily = {(r.airport_id, r.day): r for r in wh.agg_daily_airport_stats(h, airports(spark)).collect()}
    assert daily[1, "1970-01-02"].ground_dwell_avg_min == round((24 * 60 + 10) / 2, 6)
    assert daily[2, "1970-01-02"].departures == 1
    # b moves 50 degrees in ten minutes, a jump: its alert counts where and when the jump was seen
    assert {k: r.alert_count for k, r in daily.items() if r.alert_count} == {(2, "1970-01-02"): 1}


def test_a_gap_of_days_within_one_visit(spark):
    h = fixes(spark, [("a", 3600, 0.0, True), ("a", 3 * DAY + 7200, 0.0, True)])
    got = sorted((r.day, r.visits, r.dwell_s) for r in sp.ground_dwell_by_day(h, airports(spark), gap_s=10 * DAY).collect())
    assert got == [("1970-01-01", 1, DAY - 3600), ("1970-01-02", 1, DAY), ("1970-01-03", 1, DAY), ("1970-01-04", 1, 7200)]


def test_dwell_of_days_equals_dwell_of_visits(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    from flight_engine.sources.testdata import airports as pseudo
    h, ap = history(spark, SF_SMALL, 60), pseudo(spark, SF_SMALL)
    days, visits = sp.ground_dwell_by_day(h, ap, 7200), sp.airport_ground(h, ap, 7200)
    assert days.agg(F.sum("dwell_s")).first()[0] == visits.agg(F.sum("dwell_s")).first()[0] > 0


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hourly_routes_after_batches_and_a_correction(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    h = history(spark, SF_SMALL)
    path = scratch_path(spark, "t-routes")
    cut = [h.agg(F.percentile_approx("timestamp", [0.3, 0.6])).first()[0]][0]
    tables = [h.limit(0), h.where(F.col("timestamp") < cut[0]), h.where(F.col("timestamp") < cut[1]), h]
    states = [wh.route_fixes(t) for t in tables]

    def files():
        return {r[0]: r[1] for r in spark.read.parquet(path).select("hour_start", F.input_file_name().alias("f")).groupBy("hour_start").agg(F.sort_array(F.collect_set("f"))).collect()}

    for k in range(3):
        wh.maintain_hourly_routes(path, f"b{k}", states[k], states[k + 1])
        wh.maintain_hourly_routes(path, f"b{k}", states[k], states[k + 1])  # a batch that runs again replaces itself
        assert same(wh.read_hourly_routes(spark, path), wh.agg_hourly_routes(tables[k + 1]))
    before = files()
    # one aircraft's state is corrected: another place, so that the next fix's jump may go or come
    one = h.orderBy("timestamp", "icao24").limit(1).withColumn("longitude", -F.col("longitude")).withColumn(
        "last_contact", F.col("last_contact") + 9).withColumn("velocity_kmh", F.lit(5000.0))
    touched = [r[0] for r in one.select("icao24").collect()]
    old = h.where(F.col("icao24").isin(touched))
    new = wh.merge_corrections(old, one)
    wh.maintain_hourly_routes(path, "correction", wh.route_fixes(old), wh.route_fixes(new))
    assert same(wh.read_hourly_routes(spark, path), wh.agg_hourly_routes(wh.merge_corrections(h, one)))
    after = files()
    changed = {hour for hour in after if after[hour] != before.get(hour)}
    assert 1 <= len(changed) <= 3 and len(after) > 50


def test_an_hour_that_loses_all_its_rows_goes(spark):
    h = fixes(spark, [("a", 10, 0.0, False), ("a", 5000, 0.0, False), ("b", 20, 0.0, False)])
    path = scratch_path(spark, "t-routes")
    wh.maintain_hourly_routes(path, "0", wh.route_fixes(h.limit(0)), wh.route_fixes(h))
    gone = h.where("timestamp <> 5000")
    wh.maintain_hourly_routes(path, "1", wh.route_fixes(h), wh.route_fixes(gone))
    assert [r.hour_start for r in wh.read_hourly_routes(spark, path).collect()] == [0]


def test_a_batch_reads_its_fixes_once(spark):
    """Equal fixes of before and after cancel, also of several, in one pass over both."""
    read = spark.sparkContext.accumulator(0)

    def counted(pdfs):
        for pdf in pdfs:
            read.add(len(pdf))
            yield pdf

    h = fixes(spark, [("a", 10, 0.0, False), ("a", 10, 0.0, False), ("b", 20, 0.0, False), ("b", 4000, 0.0, False)])
    old, new = wh.route_fixes(h), wh.route_fixes(h.where("icao24 = 'b'").unionByName(h.where("icao24 = 'a'").limit(1)))
    path = scratch_path(spark, "t-routes")
    wh.maintain_hourly_routes(path, "0", old.limit(0), old)
    wh.maintain_hourly_routes(path, "1", old.mapInPandas(counted, old.schema), new.mapInPandas(counted, new.schema))
    assert read.value == 7
    assert sorted((r.hour_start, r.states) for r in wh.read_hourly_routes(spark, path).collect()) == [(0, 2), (3600, 1)]
    assert spark.read.parquet(path).where("batch = '1'").select("hour_start", "states").collect() == [(0, -1)]
