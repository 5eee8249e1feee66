"""The sink's refused rows: told apart, stored with their reason, counted once."""

import json

from pyspark.sql import functions as F

from flight_engine.operators import sink as sk
from flight_engine.operators.metrics import pipeline_counters
from flight_engine.schema import PROCESSED_COLUMNS
from flight_engine.session import scratch_path
from flight_engine.streaming import pipeline as pl


def message(**values):
    row = dict.fromkeys(PROCESSED_COLUMNS) | {"icao24": "abc123", "timestamp": 1_706_000_000, "callsign": "AAL1"} | values
    return json.dumps({k: v for k, v in row.items() if v is not None})


MESSAGES = [
    (message(), "success", None), (message(timestamp=0), "success", None), (message(timestamp=-1), "success", None),
    (message(timestamp=253402300799), "success", None), (message(velocity="fast"), "success", None), (message(extra=1), "success", None),
    (message(icao24=""), "skipped", None), (message(icao24=None), "skipped", None), (message(timestamp=None), "skipped", None), ("{}", "skipped", None),
    (message(icao24="", callsign="a\x00"), "skipped", None), (message(icao24=None, timestamp=10 ** 16), "skipped", None),
    (message(timestamp=253402300800), "error", "time_range"), (message(timestamp=1_706_000_000_000), "error", "time_range"),
    (message(timestamp=-10 ** 14, callsign="a\x00"), "error", "time_range"),
    (message(callsign="a\x00b"), "error", "text_nul"), (message(icao24="\x00"), "error", "text_nul"),
    (message()[:-1], "error", "undecodable"), ("", "error", "undecodable"), ("[1]", "error", "undecodable"), ("7", "error", "undecodable"),
    (None, "error", "undecodable"), (message() + " and more", "error", "undecodable"),
]


def test_outcomes(spark):
    df = spark.createDataFrame([(m,) for m, _, _ in MESSAGES], "value string")
    got = sorted(((r.message or "", r.outcome, r.reason or "") for r in sk.judged_records(df).collect()))
    assert got == sorted((m or "", o, r or "") for m, o, r in MESSAGES)


def test_stream_stores_refused_messages_once(spark):
    src, table, dead, ck = (scratch_path(spark, f"t-dead-{n}") for n in ("src", "table", "dead", "ck"))
    assert sk.dead_letters(spark, dead).count() == 0

    def run():
        return pl.run_logged(spark, lambda: pl.stream_sink_checked(pl.file_source(spark, src, "parquet"), table, dead, ck))

    totals = {}
    for half in (MESSAGES[::2], MESSAGES[1::2]):
        df = spark.createDataFrame([(None, m) for m, _, _ in half], "key string, value string")
        df.coalesce(1).write.mode("append").parquet(src)
        for e in run():
            for k, v in (e["observedMetrics"].get(pl.SINK_METRICS) or {}).items():
                totals[k] = totals.get(k, 0) + v
    run()  # nothing new

    def count(outcome, reason=None):
        return sum(o == outcome and reason in (None, r) for _, o, r in MESSAGES)

    assert totals == {"consumed": len(MESSAGES), **{o: count(o) for o in ("success", "skipped", "error")},
                      **{f"error_{r}": count("error", r) for r in sk.REFUSALS}}
    letters = sk.dead_letters(spark, dead)
    want = sorted((r, m or "") for m, o, r in MESSAGES if o == "error")
    assert sorted((x.reason, x.message or "") for x in letters.collect()) == want
    assert spark.read.parquet(table).count() == count("success")
    # a batch that runs again after a lost driver replaces its own letters and rows
    batch = letters.select("batch").distinct().collect()[0][0]
    own = spark.createDataFrame([(x.message,) for x in letters.where(F.col("batch") == batch).collect()], "value string")
    sk.write_dead_letters(sk.judged_records(own), dead, batch)
    assert sorted((x.reason, x.message or "") for x in sk.dead_letters(spark, dead).collect()) == want


def test_batch_counters_count_errors_from_rows(spark):
    rows = [("a1", 1_706_000_000, "AAL", 1.0, 2.0), ("a1", 1_706_000_000_000, "AAL", 1.0, 2.0), ("a1", 5, "A\x00", 1.0, 2.0),
            ("", 5, "AAL", 1.0, 2.0), ("a1", 10 ** 15, "AAL", None, 2.0)]
    df = spark.createDataFrame(rows, "icao24 string, timestamp long, callsign string, longitude double, latitude double")
    r = pipeline_counters(df).first()
    assert (r.messages_consumed_total, r.inserts_success, r.inserts_skipped, r.inserts_error) == (4, 1, 1, 2)
