"""Property tests: column expressions agree with plain-Python models on random inputs."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flight_engine.functions.columns import js_round, status_col
from flight_engine.functions.geo import cell_center_lat, cell_center_lon, grid_cell, haversine_km

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


def py_status(v):
    if v is None:
        return "CRUISING"
    if v > 0.5:
        return "CLIMBING"
    if v < -0.5:
        return "DESCENDING"
    return "CRUISING"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), finite, st.sampled_from([0.5, -0.5, 0.0])), min_size=1, max_size=60))
def test_status_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(status_col("v")).collect()]
    assert got == [py_status(v) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x * 2) / 4),
                min_size=1, max_size=60))
def test_js_round_matches_floor_half(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(js_round("v")).collect()]
    assert got == [math.floor(v + 0.5) for v in values]


lat = st.floats(min_value=-90, max_value=90, allow_nan=False)
lon = st.floats(min_value=-180, max_value=180, allow_nan=False)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(lat, lon), min_size=1, max_size=60), st.sampled_from([0.5, 1.0, 10.0, 30.0]))
def test_cell_center_is_inside_its_cell(spark, points, deg):
    df = spark.createDataFrame(points, "latitude double, longitude double")
    rows = df.select("latitude", "longitude", grid_cell(deg=deg).alias("cell")) \
        .select("*", cell_center_lat("cell", deg).alias("clat"), cell_center_lon("cell", deg).alias("clon")) \
        .select("*", grid_cell("clat", "clon", deg).alias("cell2"),
                haversine_km("latitude", "longitude", "clat", "clon").alias("km")).collect()
    for r in rows:
        assert r.cell == r.cell2
        assert abs(r.latitude - r.clat) <= deg / 2 + 1e-9
        assert r.km <= math.pi * 6371.0 + 1e-6
