"""A third of all rows on one aircraft: skew-safe operators still equal plain windows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from flight_engine.operators import anomalies as an
from flight_engine.plans import oracle
from flight_engine.session import scratch_path


@pytest.fixture(scope="module")
def skewed(spark):
    from conftest import SF_MID
    from flight_engine.plans.catalog import history
    h = history(spark, SF_MID)
    hot = F.pmod(F.xxhash64("time_position", "last_contact", "longitude"), F.lit(3)) == 0
    s = h.withColumn("icao24", F.when(hot, F.lit("hotkey")).otherwise(F.col("icao24")))
    path = scratch_path(spark, "t-skew")
    s.write.parquet(path)
    df = spark.read.parquet(path)
    share = df.where("icao24 = 'hotkey'").count() / df.count()
    assert 0.25 < share < 0.4
    con = duckdb.connect()
    con.execute(f"CREATE VIEW hist AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return df, con


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def duck(con, sql, cols):
    return sorted(tuple(r) for r in con.execute(f"SELECT {cols} FROM ({sql})").fetchall())


def test_jumps_on_hot_key(skewed):
    df, con = skewed
    got = an.position_jump(df)
    cols = ", ".join(got.columns)
    assert rows(got) == duck(con, oracle._jumps("hist"), cols)


def test_descents_on_hot_key(skewed):
    df, con = skewed
    got = an.emergency_descent(df)
    sql = oracle.BASE[[b.startswith("descents AS") for b in oracle.BASE].index(True)]
    body = sql[len("descents AS ("):-1]
    assert rows(got) == duck(con, body, ", ".join(got.columns))


def test_latest_and_dedup_on_hot_key(skewed):
    df, con = skewed
    latest = an.latest_state(df, ttl_s=10 ** 9)
    exp = con.execute("SELECT icao24, max(timestamp) FROM hist GROUP BY 1").fetchall()
    assert sorted((r.icao24, r.timestamp) for r in latest.collect()) == sorted(exp)
    d = an.dedup_states(df.drop("velocity_kmh", "status"))
    n = con.execute("SELECT count(*) FROM (SELECT DISTINCT icao24, timestamp FROM hist)").fetchone()[0]
    assert d.count() == n
