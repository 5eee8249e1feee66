"""Waiting messages: the sweep against a plain count of every message at every minute."""

import random

from pyspark.sql import functions as F

from flight_engine.operators import metrics as mt


def plain(rows):
    """{window_start: (pending, oldest age)}."""
    ceil = lambda x: -(-x // 60) * 60
    rows = [(p, c) for p, c in rows if p is not None]
    first = [p - p % 60 + 60 for p, _ in rows]
    last = max([*first, *[ceil(c) for _, c in rows if c is not None]])
    out = {}
    for end in range(min(first), last + 1, 60):
        waiting = [p for p, c in rows if p < end and (c is None or c > end)]
        if waiting:
            out[end - 60] = (len(waiting), end - min(waiting))
    return out


def ages(spark, rows):
    df = spark.createDataFrame(rows, "p long, c long")
    return {r.window_start: (r.pending, r.oldest_age_s) for r in mt.backlog_age(df, "p", "c").collect()}


def test_sweep_equals_plain_count(spark):
    rnd = random.Random(4)
    for share_lost in (0.0, 0.05):
        rows = []
        for _ in range(400):
            p = 1_706_000_000 + rnd.randrange(3 * 86400)
            wait = rnd.choice([0, 1, 30, 59, 60, 61, 600, rnd.randrange(200_000), -50])
            rows.append((p, None if rnd.random() < share_lost else p + wait))
        rows += [(1_706_000_040, 1_706_000_040), (None, 5), (1_706_000_000, 1_706_000_060)]
        assert ages(spark, rows) == plain(rows)


def test_a_message_that_is_never_consumed_waits_to_the_end(spark):
    got = ages(spark, [(30, None), (40, 130), (300, 301)])
    assert got == plain([(30, None), (40, 130), (300, 301)])
    assert got[0] == (2, 30) and got[240] == (1, 270) and got[300 - 60][0] == 1


def test_no_messages(spark):
    assert ages(spark, []) == {} and ages(spark, [(None, 5)]) == {}
    assert ages(spark, [(60, 61)]) == {}


def test_alert_when_the_consumer_stops(spark):
    """Messages every ten seconds; the consumer takes them until it stops after ten minutes."""
    rows = [(t, t + 5 if t < 600 else None) for t in range(0, 1800, 10)]
    df = spark.createDataFrame(rows, "ts long, consumed_at long").withColumn("label", F.lit("raw"))
    lag = mt.consumer_lag(df, df.where("consumed_at is not null"), "ts", "consumed_at")
    health = {r.window_start: r for r in mt.pipeline_health(mt.rate_per_window(df), lag, mt.backlog_age(df, "ts", "consumed_at")).collect()}
    assert not any(health[w].lag_alert for w in range(0, 840, 60))
    assert all(health[w].lag_alert for w in range(900, 1800, 60)) and health[1740].oldest_age_s == 1200


def test_rows_do_not_grow_with_the_wait(spark):
    """A message that waits for a year is two events."""
    df = spark.createDataFrame([(0, 365 * 86400)] * 50, "p long, c long")
    plan = mt.backlog_age(df, "p", "c")._jdf.queryExecution().optimizedPlan().toString()
    # only the minutes between the first and the last event are made, never those of a message
    assert plan.count("Generate") == plan.count("Generate explode(sequence(lo#")
