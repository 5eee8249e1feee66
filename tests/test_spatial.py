"""Nearest airport, ground visits, OD matrix."""

import math
import random

from pyspark.sql import functions as F

from flight_engine.operators import spatial as sp


def km(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1, h)))


def airports(spark, spots):
    return spark.createDataFrame([(i, f"AP{i}", f"C{i % 3}", float(a), float(b)) for i, (a, b) in enumerate(spots)],
                                 "airport_id long, airport_code string, country string, ap_lat double, ap_lon double")


def test_every_position_has_its_nearest_airport_once(spark):
    rnd = random.Random(8)
    spots = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(60)]
    spots += [(10.0, 10.0), (10.1, 10.1), (10.0, 10.0), (89.9, 0.0), (-89.9, 170.0), (0.0, 179.9), (0.0, -179.9)]
    points = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(400)]
    points += [(900, 10.0, 10.0), (901, 90.0, 180.0), (902, -90.0, -180.0), (903, 0.0, 180.0)]
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    got = {r.id: r for r in sp.with_airport(df, airports(spark, spots)).collect()}
    assert len(got) == len(points) == sp.with_airport(df, airports(spark, spots)).count()
    for i, a, b in points:
        best = min(range(len(spots)), key=lambda j: (round(km(a, b, *spots[j]), 6), j))
        assert abs(km(a, b, *spots[got[i].airport_id]) - km(a, b, *spots[best])) < 1e-5, i
    assert got[900].airport_id == 60  # ties go to the smaller id


def test_candidates_are_bounded_at_any_density(spark):
    """100,000 airports, most of them in a few towns: no leaf holds more than the bound, and none loses the nearest."""
    import numpy as np
    rnd = np.random.default_rng(4)
    towns = rnd.uniform([-60, -170], [60, 170], (12, 2))
    spots = np.concatenate([t + rnd.normal(0, s, (7500, 2)) for t, s in zip(towns, [0.2, 0.5, 2.0] * 4)] + [rnd.uniform([-90, -180], [90, 180], (10_000, 2))])
    spots[:, 0] = spots[:, 0].clip(-90, 90)
    ap = spark.createDataFrame([(i, f"A{i}", "C", float(a), float(b)) for i, (a, b) in enumerate(spots)],
                               "airport_id long, airport_code string, country string, ap_lat double, ap_lon double")
    tree = sp.nearest_candidates(ap)
    most, total = tree.agg(F.max("size"), F.sum("size")).first()
    assert most <= sp.MAX_CANDIDATES and total < 60 * len(spots)
    points = np.concatenate([rnd.uniform([-90, -180], [90, 180], (150, 2)), spots[rnd.integers(0, len(spots), 150)] + rnd.normal(0, 0.02, (150, 2))])
    points[:, 0] = points[:, 0].clip(-90, 90)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id int, latitude double, longitude double")
    got = {r.id: r for r in sp.with_airport(df, ap).collect()}
    assert len(got) == len(points)
    for i, (a, b) in enumerate(points):
        assert abs(got[i].dist_km - sp._distances(a, b, spots[:, 0], spots[:, 1]).min()) < 1e-6


def test_many_candidates_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(sp, "MAX_SENT_CANDIDATES", 3)
    rnd = random.Random(3)
    spots = [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(40)]
    df = spark.createDataFrame([(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(50)], "id int, latitude double, longitude double")
    got = {r.id: r for r in sp.with_airport(df, airports(spark, spots)).collect()}
    assert all(abs(r.dist_km - min(km(r.latitude, r.longitude, *s) for s in spots)) < 1e-6 for r in got.values()) and len(got) == 50


def test_positions_missing_and_no_airports(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, 5.0, 5.0)], "id int, latitude double, longitude double")
    ap = airports(spark, [(0, 0)])
    assert [r.id for r in sp.with_airport(df, ap).collect()] == [2]
    left = {r.id: r.airport_id for r in sp.with_airport(df, ap, how="left").collect()}
    assert left == {1: None, 2: 0}
    assert sp.with_airport(df, ap.limit(0)).count() == 0
    assert sorted((r.id, r.airport_id) for r in sp.with_airport(df, ap.limit(0), how="left").collect()) == [(1, None), (2, None)]


def test_corridors_cover_the_whole_history(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history
    from flight_engine.sources.testdata import airports as nations
    h, ap = history(spark, SF_SMALL), nations(spark, SF_SMALL)
    assert sp.corridors(h, ap).agg(F.sum("states")).first()[0] == h.count()
    countries = [r[0] for r in ap.select("country").collect()]
    wide = sp.od_matrix(sp.with_airport(h, ap), countries)
    assert wide.select(F.sum(sum((F.col(c) for c in countries), F.lit(0)))).first()[0] == h.count()


def test_absence_is_no_dwell(spark):
    rows = [("a", t, t, 0.1, 0.1, "true") for t in (0, 600, 1200, 90_000, 90_600)]
    rows += [("a", 50_000, 50_000, 40.0, 40.0, "true"), ("a", 700, 700, 0.1, 0.1, "false")]
    df = spark.createDataFrame(rows, "icao24 string, timestamp long, time_position long, latitude double, longitude double, on_ground string")
    got = {r.airport_id: r for r in sp.airport_ground(df, airports(spark, [(0, 0), (40, 40)])).collect()}
    assert (got[0].visits, got[0].ground_fixes, got[0].dwell_s) == (2, 5, 1800)
    assert (got[1].visits, got[1].dwell_s) == (1, 0)
