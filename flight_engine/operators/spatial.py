"""Spatial analytics: boxes, airports, corridors, route efficiency, cells."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flight_engine.files import delete_at_end
from flight_engine.functions.geo import (
    EARTH_RADIUS_KM, cell_center_lat, cell_center_lon, grid_cell, haversine_km, in_bbox,
)
from flight_engine.operators.sequence import with_previous
from flight_engine.session import scratch_path

INEFFICIENT_RATIO = 1.15

# Airline prefixes of the callsigns and their names.
AIRLINES = [("AAL", "American Airlines"), ("BAW", "British Airways"), ("DLH", "Lufthansa"),
            ("UAL", "United Airlines"), ("AFR", "Air France")]


def bbox_filter(history: DataFrame, min_lat: float, max_lat: float, min_lon: float,
                max_lon: float) -> DataFrame:
    """States inside a rectangle; min_lon > max_lon crosses the antimeridian.

    A plain conjunctive range predicate: it reaches the Parquet scan as
    PushedFilters (row-group skipping) for the non-crossing case.
    """
    return history.where(in_bbox(min_lat, max_lat, min_lon, max_lon))


#: Cells that the airport tree starts from (8 x 16 of 22.5 degrees), its finest cells (1 m) and
#: the airports a leaf may hold before it is split.
BASE_LEVEL, MAX_LEVEL, MAX_CANDIDATES = 3, 24, 16
#: Candidates (leaf, airport) that are sent to every task at most (about 100 MB); more are joined by a shuffle.
MAX_SENT_CANDIDATES = 1_000_000
_KM_PER_DEG = 111.2
_AIRPORT = ["airport_id", "airport_code", "airport_country", "ap_lat", "ap_lon"]


def _cell_key(level: int, lat: Column, lon: Column) -> Column:
    """The cell of a position at a level: squares of 180 / 2^level degrees."""
    side = 180.0 / 2 ** level
    row = F.least(F.floor((lat + 90.0) / side), F.lit(2 ** level - 1))
    col = F.least(F.floor((lon + 180.0) / side), F.lit(2 ** (level + 1) - 1))
    return (F.lit(level << 52) + row * F.lit(1 << 26) + col).cast("bigint")


def _distances(lat: float, lon: float, lats: np.ndarray, lons: np.ndarray) -> np.ndarray:
    p, q = np.radians(lat), np.radians(lats)
    a = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(lons - lon) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def _leaves(most: int, max_level: int):
    """Split a base cell until each part has at most ``most`` airports that can be nearest in it."""

    def split(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lats, lons = table.column("ap_lat").to_numpy(), table.column("ap_lon").to_numpy()
        keys, levels, near = [], [], []
        todo = [(BASE_LEVEL, table.column("row")[0].as_py(), table.column("col")[0].as_py(), np.arange(len(lats)))]
        while todo:
            level, row, col, at = todo.pop()
            side = 180.0 / 2 ** level
            d = _distances(-90 + (row + 0.5) * side, -180 + (col + 0.5) * side, lats[at], lons[at])
            at = at[d <= d.min() + 2 * _KM_PER_DEG * side * 0.7072 + 1e-5]
            if len(at) <= most or level >= max_level:
                keys.append((level << 52) + (row << 26) + col)
                levels.append(level)
                near.append(at)
            else:
                todo += [(level + 1, 2 * row + i, 2 * col + j, at) for i in (0, 1) for j in (0, 1)]
        rows = table.select(_AIRPORT).take(pa.array(np.concatenate(near)))
        ends = np.concatenate(([0], np.cumsum([len(x) for x in near]))).astype(np.int32)
        struct = pa.StructArray.from_arrays([rows.column(c).combine_chunks() for c in _AIRPORT], _AIRPORT)
        return pa.Table.from_arrays([pa.array(keys, pa.int64()), pa.array(levels, pa.int32()), pa.array([len(x) for x in near], pa.int32()),
                                     pa.ListArray.from_arrays(pa.array(ends), struct)], ["key", "level", "size", "near"])

    return split


def nearest_candidates(airports: DataFrame, most: int = MAX_CANDIDATES, max_level: int = MAX_LEVEL) -> DataFrame:
    """key, level, size, near: a tree of cells, each leaf with every airport that is nearest to some point of it.

    With c a cell's centre and r a bound of its radius, an airport further from c
    than the nearest one plus 2 r cannot win anywhere in the cell. A cell with more than ``most``
    such airports is split in four, so the leaves are small where airports are dense, and a position
    is compared with ``most`` airports at any density (of airports at one place only
    the smallest id can win). Base cells are split independently of each other, by tasks.
    """
    place = airports.select("airport_id", "airport_code", F.col("country").alias("airport_country"),
                            F.col("ap_lat").cast("double").alias("ap_lat"), F.col("ap_lon").cast("double").alias("ap_lon"))
    first = F.min(F.struct("airport_id", "airport_code", "airport_country"))
    place = (place.where("ap_lat is not null and ap_lon is not null").groupBy("ap_lat", "ap_lon").agg(first.alias("a"))
             .select("a.*", "ap_lat", "ap_lon"))
    n, side = 2 ** BASE_LEVEL, 180.0 / 2 ** BASE_LEVEL
    cells = place.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(2 * n * n - 1))))
    cells = cells.withColumn("row", F.floor(F.col("cell") / (2 * n)).cast("int")).withColumn("col", F.col("cell") % (2 * n))
    far = cells.withColumn("d", haversine_km(F.lit(-90.0) + (F.col("row") + 0.5) * side, F.lit(-180.0) + (F.col("col") + 0.5) * side,
                                             "ap_lat", "ap_lon"))
    least = far.groupBy("cell").agg(F.min("d").alias("least"))  # a row a base cell
    kept = far.join(F.broadcast(least), "cell").where(F.col("d") <= F.col("least") + 2 * _KM_PER_DEG * side * 0.7072 + 1e-5)
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in place.select(*_AIRPORT).schema.fields)
    return kept.select("row", "col", *_AIRPORT).groupBy("row", "col").applyInArrow(
        _leaves(most, max_level), f"key long, level int, size int, near array<struct<{fields}>>")


class AirportTree(NamedTuple):
    """A written tree of candidates: (_cell, near), broadcast if it is small, and the levels that have leaves."""

    near: DataFrame
    levels: list[int]


def airport_tree(airports: DataFrame) -> AirportTree:
    """Write the tree of candidates, so that its size is known: up to MAX_SENT_CANDIDATES it is broadcast."""
    spark, path = airports.sparkSession, scratch_path(airports.sparkSession, "airport-tree")
    tree = nearest_candidates(airports)
    tree.coalesce(8).write.parquet(path)
    delete_at_end(spark, path)
    tree = spark.read.schema(tree.schema).parquet(path)
    sizes = tree.groupBy("level").agg(F.sum("size").alias("n")).collect()  # a row a level
    near = tree.select(F.col("key").alias("_cell"), "near")
    return AirportTree(F.broadcast(near) if sum(r["n"] for r in sizes) <= MAX_SENT_CANDIDATES else near, [r["level"] for r in sizes])


def with_airport(history: DataFrame, airports: DataFrame | AirportTree, how: str = "inner") -> DataFrame:
    """Attach the nearest airport to each position: exactly one row per positioned state.

    A position looks up its cell of each level that the tree has leaves of, and is in exactly one
    leaf; within the leaf the least distance wins and ties go to the smaller
    airport id. Rows without a position have no airport: dropped by ``inner``. Where several
    inputs meet the same airports, an ``airport_tree`` made once serves them all.
    """
    near, levels = airports if isinstance(airports, AirportTree) else airport_tree(airports)
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    nowhere = F.array(F.lit(None).cast("bigint"))
    cells = [_cell_key(level, F.col("latitude"), F.col("longitude")) for level in levels]
    p = history.withColumn("_cell", F.explode(F.when(placed, F.array(*cells)).otherwise(nowhere) if cells else nowhere))
    p = p.join(near, "_cell", "left").where(F.col("near").isNotNull() | (F.col("_cell").isNull() & F.lit(how == "left")))
    best = F.array_min(F.transform("near", lambda a: F.struct(
        F.round(haversine_km("latitude", "longitude", a["ap_lat"], a["ap_lon"]), 6).alias("km"), a["airport_id"].alias("id"), a.alias("a"))))
    return (p.withColumn("_best", best)
            .select(*history.columns, *[F.col(f"_best.a.{c}").alias(c) for c in _AIRPORT])
            .withColumn("dist_km", haversine_km("latitude", "longitude", "ap_lat", "ap_lon")))


def airport_broadcast_join(history: DataFrame, airports: DataFrame) -> DataFrame:
    return with_airport(history, airports).select(
        "icao24", "timestamp", "time_position", "airport_id", "airport_code",
        F.round("dist_km", 6).alias("dist_km"))


VISIT_GAP_S = 3600


def ground_steps(history: DataFrame, airports: DataFrame | AirportTree, gap_s: int = VISIT_GAP_S) -> DataFrame:
    """Ground fixes with the ground fix before and whether the same visit goes on.

    A visit is a run of ground fixes of one aircraft at one airport without a gap
    over ``gap_s`` and without another airport between.
    """
    ground = history.where(F.lower(F.col("on_ground")) == "true")
    at = with_airport(ground, airports).select("airport_id", "icao24", "timestamp", "time_position")
    d = with_previous(at, "icao24", "timestamp", ["timestamp", "airport_id"], n=1, tiebreak=("time_position",))
    step = F.col("timestamp") - F.col("prev1_timestamp")
    return d.withColumn("step", step).withColumn(
        "goes_on", F.coalesce((F.col("prev1_airport_id") == F.col("airport_id")) & (step <= gap_s), F.lit(False)))


def airport_ground(history: DataFrame, airports: DataFrame | AirportTree, gap_s: int = VISIT_GAP_S) -> DataFrame:
    """Ground visits per airport and aircraft: visits, fixes, first/last seen and time on ground.

    Dwell is the sum of the visits' lengths, so absences do not count.
    """
    d, goes_on = ground_steps(history, airports, gap_s), F.col("goes_on")
    return (d.groupBy("airport_id", "icao24")
            .agg(F.count(F.when(~goes_on, 1)).alias("visits"), F.count(F.lit(1)).alias("ground_fixes"),
                 F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"),
                 F.coalesce(F.sum(F.when(goes_on, F.col("step"))), F.lit(0)).cast("bigint").alias("dwell_s")))


def ground_dwell_by_day(history: DataFrame, airports: DataFrame | AirportTree, gap_s: int = VISIT_GAP_S) -> DataFrame:
    """Per airport and UTC day: visits that touch it, their time on it, and the mean in minutes.

    A visit is the chain of its steps from fix to fix, so it needs no numbering: each step is
    cut at the midnights it crosses, and a visit is counted on the day it starts and on every day that one of
    its steps crosses into. The rows stay linear in fixes and days.
    """
    d = ground_steps(history, airports, gap_s)
    first, last = F.floor(F.col("prev1_timestamp") / 86400), F.floor(F.col("timestamp") / 86400)
    begins = F.array(F.struct(last.alias("d"), F.lit(0).cast("bigint").alias("s"), F.lit(1).alias("visits")))
    pieces = F.transform(F.sequence(first, last), lambda x: F.struct(
        x.alias("d"), (F.least(F.col("timestamp"), (x + 1) * 86400) - F.greatest(F.col("prev1_timestamp"), x * 86400)).alias("s"),
        F.when(x > first, 1).otherwise(0).alias("visits")))
    parts = d.select("airport_id", F.explode(F.when(F.col("goes_on"), pieces).otherwise(begins)).alias("p"))
    day = F.date_format(F.timestamp_seconds(F.col("p.d") * 86400), "yyyy-MM-dd")
    return (parts.groupBy("airport_id", day.alias("day")).agg(F.sum("p.visits").alias("visits"), F.sum("p.s").alias("dwell_s"))
            .withColumn("ground_dwell_avg_min", F.round(F.col("dwell_s") / 60.0 / F.col("visits"), 6)))


def corridors(history: DataFrame, airports: DataFrame) -> DataFrame:
    """Hourly origin-country -> airport-area-country counts (long OD matrix)."""
    hour = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(3600))
    return (with_airport(history, airports)
            .groupBy(hour.alias("hour_start"), "origin_country", "airport_country")
            .agg(F.count(F.lit(1)).alias("states"),
                 F.countDistinct("icao24").alias("aircraft")))


def od_matrix(rows_with_airport: DataFrame, countries: list[str]) -> DataFrame:
    """Wide OD matrix: one column per listed airport country, states per origin.

    The list fixes the schema. An absent origin/destination pair has zero states.
    """
    return (rows_with_airport.groupBy("origin_country").pivot("airport_country", countries)
            .agg(F.count(F.lit(1))).na.fill(0))


def route_efficiency(history: DataFrame, ratio: float = INEFFICIENT_RATIO) -> DataFrame:
    """Flown path vs great circle per aircraft-day, summarised per airline.

    A flight is an aircraft's fixes within one UTC day; airline is the first
    three characters of its callsign.
    """
    pos = history.select("icao24", "timestamp", "time_position", "longitude", "latitude",
                         "callsign")
    d = with_previous(pos, "icao24", "timestamp", ["timestamp", "longitude", "latitude"], n=1,
                      tiebreak=("time_position",))
    day = F.floor(F.col("timestamp") / 86400)
    same_day = F.floor(F.col("prev1_timestamp") / 86400) == day
    leg = F.when(same_day, haversine_km("prev1_latitude", "prev1_longitude",
                                        "latitude", "longitude")).otherwise(F.lit(0.0))
    order = F.struct(F.col("timestamp"), F.col("time_position"))
    fl = (d.groupBy("icao24", day.alias("day"))
          .agg(F.sum(leg).alias("path_km"),
               F.min_by(F.struct("latitude", "longitude"), order).alias("a"),
               F.max_by(F.struct("latitude", "longitude"), order).alias("b"),
               F.max(F.substring(F.trim(F.col("callsign")), 1, 3)).alias("airline"),
               F.count(F.lit(1)).alias("fixes"))
          .withColumn("gc_km", haversine_km("a.latitude", "a.longitude", "b.latitude", "b.longitude"))
          .where(F.col("gc_km") > 0)
          .withColumn("ratio", F.col("path_km") / F.col("gc_km")))
    return (fl.groupBy("airline")
            .agg(F.count(F.lit(1)).alias("flights"),
                 F.round(F.sum("path_km"), 3).alias("path_km"),
                 F.round(F.sum("gc_km"), 3).alias("gc_km"),
                 F.round(F.avg("ratio"), 6).alias("avg_ratio"),
                 F.count(F.when(F.col("ratio") > ratio, 1)).alias("inefficient")))


def airlines_table(spark: SparkSession) -> DataFrame:
    """The airline dimension (a literal list, so its size is fixed)."""
    return spark.createDataFrame(AIRLINES, "airline_code string, airline_name string")


def airline_lookup(history: DataFrame, airlines: DataFrame) -> DataFrame:
    """``icao_to_airline``: callsign prefix -> airline (left join, literal-sized side)."""
    h = history.select("icao24", "timestamp", "time_position",
                       F.substring(F.trim(F.col("callsign")), 1, 3).alias("airline_code"))
    return h.join(F.broadcast(airlines), "airline_code", "left").select(
        "icao24", "timestamp", "time_position", "airline_code", "airline_name")


def cell_center(history: DataFrame, deg: float = 0.5) -> DataFrame:
    """``cell -> (lat, lon)`` of the cell centre (inverse of grid_cell)."""
    c = history.select("icao24", "timestamp", "time_position",
                       grid_cell(deg=deg).alias("cell"))
    return c.select("icao24", "timestamp", "time_position", "cell",
                    cell_center_lat("cell", deg).alias("center_lat"),
                    cell_center_lon("cell", deg).alias("center_lon"))
