"""Snapshot decode: example cases of the ingest suite plus edge cases."""

import json

from flight_engine.schema import RAW_COLUMNS
from flight_engine.sources.snapshot import decode_snapshot, malformed_counts, snapshot_documents


def full_state(icao="abc123", sensors=None):
    return [icao, "DLH1  ", "Germany", 1704067190, 1704067199, 12.5, 48.1, 1000.0, False,
            200.5, 90.0, -3.2, sensors, 1100.0, "1234", False, 0]


def docs(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_empty_payloads_give_no_rows(spark):
    d = docs(spark, None, "{}", json.dumps({"time": 5}), json.dumps({"time": 5, "states": None}),
             json.dumps({"time": 5, "states": []}), "not json", "[]")
    assert decode_snapshot(d).count() == 0


def test_two_full_rows_get_snapshot_time(spark):
    d = docs(spark, json.dumps({"time": 1704067200, "states": [full_state("a1"), full_state("b2")]}))
    rows = decode_snapshot(d).collect()
    assert len(rows) == 2
    assert {r.icao24 for r in rows} == {"a1", "b2"}
    assert all(r.timestamp == 1704067200 for r in rows)


def test_short_row_skipped_long_row_truncated(spark):
    d = docs(spark, json.dumps({"time": 1, "states": [["x", 1], full_state(), full_state() + ["extra"]]}))
    assert decode_snapshot(d).count() == 2
    c = malformed_counts(d).first()
    assert (c.accepted, c.rejected) == (2, 1)


def test_full_row_columns_mapped(spark):
    d = docs(spark, json.dumps({"time": 7, "states": [full_state(sensors=["sensor1"])]}))
    r = decode_snapshot(d).first()
    assert r.icao24 == "abc123" and r.callsign == "DLH1  " and r.origin_country == "Germany"
    assert r.time_position == 1704067190 and r.last_contact == 1704067199
    assert r.longitude == 12.5 and r.latitude == 48.1 and r.on_ground == "false"
    assert r.velocity == 200.5 and r.vertical_rate == -3.2
    assert json.loads(r.sensors) == ["sensor1"] and r.squawk == "1234" and r.position_source == 0
    assert list(decode_snapshot(d).columns) == RAW_COLUMNS + ["timestamp"]


def test_null_state_and_missing_time(spark):
    d = docs(spark, json.dumps({"time": 3, "states": [None, full_state()]}),
             json.dumps({"states": [full_state()]}),
             json.dumps({"time": None, "states": [full_state()]}))
    rows = decode_snapshot(d).collect()
    # null state skipped; missing "time" drops the document; "time": null publishes null timestamp
    assert sorted((r.timestamp is None) for r in rows) == [False, True]


def test_wrong_typed_cell_is_null(spark):
    st = full_state()
    st[9] = "fast"
    d = docs(spark, json.dumps({"time": 3, "states": [st]}))
    assert decode_snapshot(d).first().velocity is None


def test_documents_round_trip(spark):
    from conftest import SF_SMALL
    from flight_engine.sources.testdata import flight_states
    s = flight_states(spark, SF_SMALL)
    docs_df = snapshot_documents(s, max_states=50)
    dec = decode_snapshot(docs_df).select(*s.columns)
    kept = s.where("last_contact % 41 <> 0")
    assert dec.exceptAll(kept).count() == 0 and kept.exceptAll(dec).count() == 0
    # no document exceeds the bound
    sizes = docs_df.selectExpr("size(from_json(value, 'time BIGINT, states ARRAY<STRING>').states) n")
    assert sizes.agg({"n": "max"}).first()[0] <= 50


def test_whole_file_documents_batch_and_stream(spark, tmp_path):
    from flight_engine.session import scratch_path
    from flight_engine.sources.snapshot import read_snapshot_files, stream_snapshot_files
    from flight_engine.streaming.pipeline import run_until_caught_up, stream_to_parquet
    d = tmp_path / "landed"
    d.mkdir()
    # pretty-printed documents span many lines: each file must stay one document
    (d / "a.json").write_text(json.dumps({"time": 10, "states": [full_state("a1"), full_state("a2")]}, indent=2))
    (d / "b.json").write_text(json.dumps({"time": 20, "states": [full_state("b1"), ["short"]]}, indent=2))
    batch = decode_snapshot(read_snapshot_files(spark, str(d)))
    assert sorted((r.icao24, r.timestamp) for r in batch.collect()) == [("a1", 10), ("a2", 10), ("b1", 20)]
    out, ck = scratch_path(spark, "t-snap-out"), scratch_path(spark, "t-snap-ck")
    q = stream_to_parquet(decode_snapshot(stream_snapshot_files(spark, str(d), 1)), out, ck)
    run_until_caught_up(q)
    assert spark.read.parquet(out).select("icao24", "timestamp").exceptAll(
        batch.select("icao24", "timestamp")).count() == 0


def test_odd_elements_leave_their_neighbours_alone(spark):
    odd = [5, "x", {}, {"a": [1]}, None, True, [], ["short"]]
    d = docs(spark, json.dumps({"time": 9, "states": [full_state("a1"), *odd, full_state("b2")]}),
             json.dumps({"time": 10, "states": odd}))
    assert sorted(r.icao24 for r in decode_snapshot(d).collect()) == ["a1", "b2"]
    c = malformed_counts(d).first()
    assert (c.accepted, c.rejected) == (2, 2 * len(odd))


def test_ingest_counters_count_empty_and_failed_polls(spark):
    from flight_engine.sources.snapshot import ingest_counters
    d = docs(spark, json.dumps({"time": 1, "states": [full_state(), [1]]}), json.dumps({"time": 2, "states": None}),
             json.dumps({"time": 3, "states": []}), "", None)
    c = ingest_counters(d).first()
    assert (c.polls_total, c.flights_sent_total, c.errors_fetch, c.errors_malformed) == (5, 1, 2, 1)
