"""Schema validation before publish: split accepted / quarantined messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flight_engine.schema import FLIGHT_SCHEMA

CORRUPT_COL = "_corrupt_record"


def validate_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse with the flight schema; flag rows that are not valid records.

    A message is accepted when it parses as a JSON object and carries
    icao24 and timestamp.  Unparseable text lands in ``_corrupt_record``
    (PERMISSIVE mode) and the row is quarantined.
    """
    schema = T.StructType(FLIGHT_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    parsed = raw.select(F.col(value_col).cast("string").alias("raw_value"),
                        F.from_json(F.col(value_col).cast("string"), schema,
                                    {"mode": "PERMISSIVE",
                                     "columnNameOfCorruptRecord": CORRUPT_COL}).alias("r"))
    ok = (F.col("r").isNotNull() & F.col(f"r.{CORRUPT_COL}").isNull()
          & F.col("r.icao24").isNotNull() & F.col("r.timestamp").isNotNull())
    return parsed.select("raw_value", "r.*", F.coalesce(ok, F.lit(False)).alias("accepted")) \
        .drop(CORRUPT_COL)


def split_valid(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    v = validate_messages(raw, value_col)
    return v.where("accepted").drop("accepted"), v.where(~F.col("accepted")).select("raw_value")
