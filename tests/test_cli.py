"""The CLI runs the reference's pipeline: raw topic -> transform -> sink -> serve."""

import json

from flight_engine import cli
from flight_engine.session import scratch_path
from flight_engine.streaming import pipeline as pl


def test_pipeline_through_cli(spark, capsys):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import history, states
    raw, out, table = (scratch_path(spark, n) for n in ("c-raw", "c-out", "c-table"))
    pl.write_messages(states(spark, SF_SMALL), raw)
    cli.main(["transform", "--source", "json", "--input", raw, "--sink", "json", "--output", out,
              "--checkpoint", scratch_path(spark, "c-ck1"), "--available-now"])
    cli.main(["sink", "--source", "json", "--input", out, "--table", table,
              "--checkpoint", scratch_path(spark, "c-ck2"), "--available-now"])
    assert spark.read.parquet(table).count() == history(spark, SF_SMALL).count()
    capsys.readouterr()
    cli.main(["serve", "--table", table, "--limit", "5"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert len(lines) == 5 and all("icao24" in x and "timestamp" in x for x in lines)
    assert [x["timestamp"] for x in lines] == sorted((x["timestamp"] for x in lines), reverse=True)


def test_ingest_then_transform(spark, tmp_path):
    from flight_engine.operators.transform import process
    from flight_engine.sources.testdata import flight_states
    from conftest import SF_SMALL
    s = flight_states(spark, SF_SMALL)
    docs = tmp_path / "snapshots"
    docs.mkdir()
    # one document per snapshot time, as a poller would land them
    from flight_engine.sources.snapshot import snapshot_documents
    for i, row in enumerate(snapshot_documents(s.where("timestamp % 7 = 0"), short_every=10 ** 12)
                            .toLocalIterator()):
        (docs / f"snap-{i:05d}.json").write_text(row.value)
    raw, out = scratch_path(spark, "c-raw2"), scratch_path(spark, "c-out2")
    cli.main(["ingest", "--input", str(docs), "--sink", "json", "--output", raw,
              "--checkpoint", scratch_path(spark, "c-ck3"), "--available-now"])
    cli.main(["transform", "--source", "json", "--input", raw, "--sink", "json", "--output", out,
              "--checkpoint", scratch_path(spark, "c-ck4"), "--available-now"])
    from flight_engine.schema import PROCESSED_SCHEMA
    from pyspark.sql import functions as F
    got = (spark.read.schema("key string, value string").json(out)
           .select(F.from_json("value", PROCESSED_SCHEMA).alias("r")).select("r.*"))
    exp = process(s.where("timestamp % 7 = 0"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_query_command_writes_output(spark):
    from conftest import SF_SMALL
    from flight_engine.plans.catalog import QUERIES
    out = scratch_path(spark, "c-query")
    cli.main(["query", "agg_hourly_routes", "--sf-dir", SF_SMALL, "--output", out])
    got = spark.read.parquet(out)
    exp = QUERIES["agg_hourly_routes"](spark, SF_SMALL)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
