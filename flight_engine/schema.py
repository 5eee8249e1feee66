"""Schemas of the flight-state data model."""

from pyspark.sql import types as T

# Positional order of the 17 cells of one state vector.
RAW_COLUMNS = [
    "icao24", "callsign", "origin_country", "time_position", "last_contact",
    "longitude", "latitude", "baro_altitude", "on_ground", "velocity",
    "true_track", "vertical_rate", "sensors", "geo_altitude", "squawk",
    "spi", "position_source",
]

# Spark type each raw cell is decoded to (cells arrive as JSON tokens).
RAW_CELL_TYPES = {
    "icao24": "string", "callsign": "string", "origin_country": "string",
    "time_position": "bigint", "last_contact": "bigint",
    "longitude": "double", "latitude": "double", "baro_altitude": "double",
    "on_ground": "boolean", "velocity": "double", "true_track": "double",
    "vertical_rate": "double", "sensors": "string", "geo_altitude": "double",
    "squawk": "string", "spi": "boolean", "position_source": "bigint",
}

FLIGHT_SCHEMA = T.StructType([
    T.StructField("icao24", T.StringType(), True),
    T.StructField("callsign", T.StringType(), True),
    T.StructField("origin_country", T.StringType(), True),
    T.StructField("time_position", T.LongType(), True),
    T.StructField("last_contact", T.LongType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("baro_altitude", T.DoubleType(), True),
    T.StructField("on_ground", T.StringType(), True),
    T.StructField("velocity", T.DoubleType(), True),
    T.StructField("true_track", T.DoubleType(), True),
    T.StructField("vertical_rate", T.DoubleType(), True),
    T.StructField("timestamp", T.LongType(), True),
])
FLIGHT_COLUMNS = [f.name for f in FLIGHT_SCHEMA.fields]

PROCESSED_SCHEMA = T.StructType(FLIGHT_SCHEMA.fields + [
    T.StructField("velocity_kmh", T.DoubleType(), True),
    T.StructField("status", T.StringType(), True),
])
PROCESSED_COLUMNS = [f.name for f in PROCESSED_SCHEMA.fields]

# Columns of the API record, in output order.
API_COLUMNS = ["icao24", "callsign", "origin_country", "longitude", "latitude",
               "velocity_kmh", "status", "timestamp"]

ALERT_SCHEMA = T.StructType([
    T.StructField("alert_type", T.StringType(), False),
    T.StructField("icao24", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("metric", T.DoubleType(), True),
])
ALERT_COLUMNS = [f.name for f in ALERT_SCHEMA.fields]

# Message envelope on the processed topic.
ENVELOPE_SCHEMA = "key STRING, value STRING"
