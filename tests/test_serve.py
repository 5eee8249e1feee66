"""Serving: limit parsing, newest-first page, table and map shapes."""

import pytest

from flight_engine.operators import serve as sv


@pytest.mark.parametrize("arg,n", [
    ("", 50), (None, 50), ("25", 25), ("abc", 50), ("999", 500), ("0", 50), ("-1", 50),
    ("+5", 5), ("5.0", 50), (" 5", 50), ("500", 500), ("501", 500),
    ("9223372036854775807", 500), ("9223372036854775808", 50), ("99999999999999999999", 50)])
def test_parse_limit(arg, n):
    assert sv.parse_limit(arg) == n


def test_js_round_matches_math_round(spark):
    d = spark.createDataFrame([(2.5,), (-2.5,), (-2.6,), (0.49,), (359.5,)], "x double")
    got = [r[0] for r in d.select(sv.js_round("x")).collect()]
    assert got == [3, -2, -3, 0, 360]


def hist(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    return history(spark, SF_SMALL)


def test_recent_flights_order_and_bound(spark):
    h = hist(spark)
    page = sv.recent_flights(h, "999").collect()
    assert len(page) == min(500, h.count())
    keys = [(-r.timestamp, r.icao24) for r in page]
    assert keys == sorted(keys)
    assert sv.recent_flights(h, "abc").count() == 50


def test_recent_flights_plan_is_top_k(spark):
    plan = sv.recent_flights(hist(spark), 50)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_display_table_placeholders(spark):
    from pyspark.sql import Row
    d = spark.createDataFrame([Row(icao24="a", callsign="  ", origin_country=None, longitude=1.0,
                                   latitude=1.0, velocity_kmh=None, status=None, timestamp=5, time_position=1)],
                              "icao24 string, callsign string, origin_country string, longitude double, "
                              "latitude double, velocity_kmh double, status string, timestamp bigint, time_position bigint")
    r = sv.display_table(d).first()
    assert (r.callsign_display, r.country_display, r.speed_display, r.status_display, r.status_color) == \
        ("—", "—", "—", "—", "#f59e0b")
    f = sv.geojson_features(d).first()
    assert (f.callsign, f.country, f.status, f.velocity) == ("", "", "", 0.0)
    assert sv.popup_label(sv.geojson_features(d)).first().label == "a"


def test_geojson_collection_is_valid_json(spark):
    import json
    doc = json.loads(sv.geojson_collection(sv.recent_flights(hist(spark), 20)).first().geojson)
    assert doc["type"] == "FeatureCollection" and len(doc["features"]) == 20
    assert doc["features"][0]["geometry"]["type"] == "Point"


def test_dashboard_header_counts(spark):
    page = sv.recent_flights(hist(spark), 500)
    r = sv.dashboard_header(page).first()
    assert r.row_count == page.count() and r.aircraft_count <= r.row_count
