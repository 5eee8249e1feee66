"""The stream transform: parse raw messages, clean, enrich, serialize.

Shared verbatim by batch jobs, Structured Streaming and tests.  All of it
is narrow (no shuffle): one task per input partition / Kafka partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flight_engine.functions.columns import status_col, velocity_kmh_col
from flight_engine.schema import FLIGHT_SCHEMA


def parse_raw(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text (or bytes) -> 13 typed, nullable columns.

    Malformed JSON yields an all-null row (PERMISSIVE), a wrong-typed field
    nulls that field only; unknown fields are dropped.
    """
    return (df.select(F.from_json(F.col(value_col).cast("string"), FLIGHT_SCHEMA).alias("data"))
            .select("data.*"))


def clean(df: DataFrame) -> DataFrame:
    """Keep rows that can be placed on a map."""
    return df.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def enrich(df: DataFrame) -> DataFrame:
    return (df.withColumn("velocity_kmh", velocity_kmh_col())
            .withColumn("status", status_col()))


def process(df: DataFrame) -> DataFrame:
    """Typed states -> processed states (15 columns)."""
    return enrich(clean(df))


def process_raw(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw message envelope -> processed states: the whole streaming transform."""
    return process(parse_raw(df, value_col))


def serialize_keyed(df: DataFrame) -> DataFrame:
    """(key = icao24, value = JSON of every column; null fields omitted)."""
    return df.select(F.col("icao24").cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def serialize_unkeyed(df: DataFrame) -> DataFrame:
    """Raw-topic message: JSON value only, no key."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
