"""Driver contract and a sample of queries against the DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry

SAMPLE = ["recent_flights", "agg_hourly_routes", "position_jump_fast", "histogram_quantile_p95",
          "congestion", "dedup_states", "expectations", "busiest_routes", "route_efficiency",
          "scan_snapshot_decode", "latest_state", "agg_daily_airport_stats"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "icao24" in df.columns and "status" in df.columns


def test_every_query_has_an_oracle():
    from flight_engine.plans.catalog import QUERIES
    from flight_engine.plans.oracle import ORACLE
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_matches_oracle(spark, name):
    from conftest import SF_SMALL
    con = duckdb.connect()
    for t in ("events", "nation", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    s = entry.queries()[name](spark, SF_SMALL).toPandas()
    o = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(s.columns) == sorted(o.columns)
    cols = sorted(s.columns)

    def norm(df):
        return sorted((tuple(None if (isinstance(v, float) and v != v) else
                             (round(v, 6) if isinstance(v, float) else v) for v in r)
                       for r in df[cols].astype(object).itertuples(index=False)), key=repr)
    assert norm(s) == norm(o)
