"""Pipeline metrics computed from event tables: counters, histograms,
quantiles, per-window rates and averages, consumer lag, request stats.

Everything aggregates first (partial aggregation on the map side) and
only then runs windows, over at most one row per (label, bucket) or per
minute -- never over raw events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flight_engine.operators.sink import refusal_reason, sinkable_condition

# Histogram upper bounds of the pipeline's metrics.
POLL_DURATION_BOUNDS = [0.5, 1, 2, 5, 10, 30]
DB_DURATION_BOUNDS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1]
PAGE_SIZE_BOUNDS = [1, 5, 10, 25, 50, 100, 200, 500]
DEFAULT_DURATION_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]


def bound_label(b: float) -> str:
    return "+Inf" if b == float("inf") else f"{b:g}"


def _bucket_index(value, bounds: list[float]):
    """0-based index of the first bound >= value; len(bounds) for +Inf."""
    expr = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        expr = F.when(value <= F.lit(float(bounds[i])), F.lit(i)).otherwise(expr)
    return expr


def histogram_buckets(events: DataFrame, bounds: list[float], value: str = "value",
                      label: str = "label") -> DataFrame:
    """Cumulative bucket counts per label: (label, le, bucket_count).

    Every bound (and +Inf) is listed for every label, empty ones included. A null
    value is no observation.
    """
    events = events.where(F.col(value).isNotNull())
    all_bounds = list(bounds) + [float("inf")]
    counts = (events.groupBy(label, _bucket_index(F.col(value), bounds).alias("idx"))
              .agg(F.count(F.lit(1)).alias("n")))
    spine = (events.select(label).distinct()
             .select(label, F.explode(F.sequence(F.lit(0), F.lit(len(bounds)))).alias("idx")))
    w = Window.partitionBy(label).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    le = F.element_at(F.array(*[F.lit(bound_label(b)) for b in all_bounds]), F.col("idx") + 1)
    upper = F.element_at(F.array(*[F.lit(float(b)) for b in all_bounds]), F.col("idx") + 1)
    return (spine.join(counts, [label, "idx"], "left")
            .select(label, "idx", le.alias("le"), upper.alias("upper"),
                    F.sum(F.coalesce(F.col("n"), F.lit(0))).over(w).cast("bigint")
                    .alias("bucket_count")))


def histogram_quantile(buckets: DataFrame, q: float = 0.95, label: str = "label") -> DataFrame:
    """Quantile from cumulative buckets with linear interpolation inside a bucket.

    rank = q * total; the first bucket whose cumulative count reaches rank
    is interpolated between its lower bound (0 for the first bucket) and its
    upper bound; if that bucket is +Inf the highest finite bound is returned.
    """
    w = Window.partitionBy(label).orderBy("idx")
    wall = Window.partitionBy(label)
    b = (buckets.withColumn("prev_count", F.coalesce(F.lag("bucket_count").over(w), F.lit(0)))
         .withColumn("lower", F.coalesce(F.lag("upper").over(w), F.lit(0.0)))
         .withColumn("total", F.max("bucket_count").over(wall))
         .withColumn("max_finite", F.max(F.when(F.col("le") != "+Inf", F.col("upper"))).over(wall))
         .withColumn("rank", F.lit(q) * F.col("total")))
    hit = b.where((F.col("bucket_count") >= F.col("rank")) & (F.col("total") > 0))
    first = hit.groupBy(label).agg(F.min_by(F.struct(*[F.col(c) for c in (
        "le", "upper", "lower", "bucket_count", "prev_count", "rank", "max_finite")]),
        F.col("idx")).alias("h"))
    h = lambda c: F.col(f"h.{c}")
    frac = F.when(h("bucket_count") == h("prev_count"), F.lit(0.0)).otherwise(
        (h("rank") - h("prev_count")) / (h("bucket_count") - h("prev_count")))
    val = F.when(h("le") == "+Inf", h("max_finite")).otherwise(
        h("lower") + (h("upper") - h("lower")) * frac)
    return first.select(label, F.round(val, 9).alias("quantile"))


def rate_per_window(events: DataFrame, label: str = "label", ts: str = "ts",
                    seconds: int = 60) -> DataFrame:
    """Events per second per label in tumbling windows."""
    win = F.window(F.timestamp_seconds(F.col(ts)), f"{seconds} seconds")
    return (events.groupBy(win.alias("w"), label)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), label,
                    "n", F.round(F.col("n") / F.lit(float(seconds)), 9).alias("per_second")))


def avg_per_window(events: DataFrame, value: str = "value", label: str = "label",
                   ts: str = "ts", seconds: int = 60) -> DataFrame:
    """rate(sum) / rate(count) = mean value per window and label, over what has a value."""
    events = events.where(F.col(value).isNotNull())
    win = F.window(F.timestamp_seconds(F.col(ts)), f"{seconds} seconds")
    return (events.groupBy(win.alias("w"), label)
            .agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"), label, "n",
                    F.round(F.col("s") / F.col("n"), 6).alias("avg_value")))


def consumer_lag(produced: DataFrame, consumed: DataFrame, produced_ts: str,
                 consumed_ts: str, seconds: int = 60) -> DataFrame:
    """Backlog per window: cumulative produced minus cumulative consumed.

    Both sides are first reduced to one row per window.  The running sum is
    two-level: within each day (windows partitioned by day, in parallel),
    plus the total of all earlier days (a running sum over one row per day,
    joined back).  No step orders more than one day of windows or more than
    one row per day in a single task.
    """
    def per_window(df, ts, name):
        return (df.select((F.col(ts) - F.pmod(F.col(ts), F.lit(seconds))).alias("window_start"))
                .groupBy("window_start").agg(F.count(F.lit(1)).alias(name)))
    p = per_window(produced, produced_ts, "produced")
    c = per_window(consumed, consumed_ts, "consumed")
    j = (p.join(c, "window_start", "full").na.fill(0, ["produced", "consumed"])
         .withColumn("day", F.floor(F.col("window_start") / 86400))
         .withColumn("net", F.col("produced") - F.col("consumed")))
    in_day = Window.partitionBy("day").orderBy("window_start").rowsBetween(
        Window.unboundedPreceding, 0)
    j = j.withColumn("in_day", F.sum("net").over(in_day))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = (j.groupBy("day").agg(F.sum("net").alias("day_net"))
            .select("day", F.coalesce(F.sum("day_net").over(before), F.lit(0)).alias("before")))
    return (j.join(days, "day")
            .select("window_start", "produced", "consumed",
                    (F.col("before") + F.col("in_day")).cast("bigint").alias("lag")))


def request_metrics(requests: DataFrame) -> DataFrame:
    """Request count and duration by path/method/status."""
    return (requests.groupBy("path", "method", "status")
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.round(F.sum("duration_s"), 6).alias("duration_sum"),
                 F.round(F.avg("duration_s"), 6).alias("duration_avg"),
                 F.count(F.when(F.col("status") >= 500, 1)).alias("errors")))


def query_metrics(requests: DataFrame) -> DataFrame:
    """Database queries by name: number, durations and errors."""
    return (requests.where(F.col("query_name").isNotNull()).groupBy("query_name")
            .agg(F.count(F.lit(1)).alias("queries"),
                 F.round(F.sum("query_duration_s"), 6).alias("duration_sum"),
                 F.round(F.avg("query_duration_s"), 6).alias("duration_avg"),
                 F.count(F.when(F.col("status") >= 500, 1)).alias("errors")))


def slowest_requests(requests: DataFrame, n: int = 5) -> DataFrame:
    return (requests.orderBy(F.col("duration_s").desc(), F.col("request_id").asc()).limit(n)
            .select("request_id", "path", "method", "status", "duration_s"))


def pipeline_counters(states: DataFrame) -> DataFrame:
    """One conditional aggregate over the states that entered the pipeline.

    polls = distinct snapshot times; sent = states published; consumed =
    states that passed the position filter; success / skipped = sink guard; error = rows that the table refuses.
    """
    has_pos = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    ok = sinkable_condition()
    storable = refusal_reason(states.columns).isNull()
    return states.agg(
        F.countDistinct("timestamp").alias("polls_total"),
        F.count(F.lit(1)).alias("flights_sent_total"),
        F.count(F.when(has_pos, 1)).alias("messages_consumed_total"),
        F.count(F.when(has_pos & ok & storable, 1)).alias("inserts_success"),
        F.count(F.when(has_pos & ~F.coalesce(ok, F.lit(False)), 1)).alias("inserts_skipped"),
        F.count(F.when(has_pos & ok & ~storable, 1)).alias("inserts_error"),
    )


def backlog_age(messages: DataFrame, produced: str, consumed: str, seconds: int = 60) -> DataFrame:
    """Per window: messages not consumed at its end and the age of the oldest, in seconds.

    A sweep: a message is +1 at the first window end after it was produced and -1 at the first
    one at which it is consumed; a message without ``consumed`` waits until the last window of the
    data. The oldest waiting message of an end is the earliest among those consumed after it
    (one produced after it shows that nothing waits). Rows are reduced to one a window
    before any ordering; running values are per day, then over days.
    """
    p, c, w = F.col(produced), F.col(consumed), F.lit(seconds).cast("bigint")
    up = p - F.pmod(p, w) + w
    down = F.when(c.isNotNull(), F.greatest(c + F.pmod(-c, w), up))
    m = messages.where(p.isNotNull()).select(p.alias("p"), up.alias("up"), down.alias("down"))
    starts = m.groupBy(F.col("up").alias("end")).agg(F.count(F.lit(1)).alias("net"), F.lit(None).cast("bigint").alias("oldest"))
    # what is never consumed ends after the last window, so it is among those consumed later at every end
    ends = m.groupBy(F.col("down").alias("end")).agg((-F.count(F.lit(1))).alias("net"), F.min("p").alias("oldest"))
    span = m.agg(F.min("up").alias("lo"), F.max(F.greatest("up", F.coalesce("down", "up"))).alias("hi"),
                 F.min(F.when(F.col("down").isNull(), F.col("p"))).alias("never"))
    spine = span.select(F.explode(F.sequence("lo", "hi", w)).alias("end"), "never")
    events = starts.unionByName(ends.where("end is not null")).groupBy("end").agg(F.sum("net").alias("net"), F.min("oldest").alias("oldest"))
    each = (spine.join(events, "end", "left").na.fill(0, ["net"])
            .withColumn("day", F.floor(F.col("end") / 86400)))
    up_to, after = Window.unboundedPreceding, Window.unboundedFollowing
    day = Window.partitionBy("day").orderBy("end")
    each = (each.withColumn("in_day", F.sum("net").over(day.rowsBetween(up_to, 0)))
            .withColumn("later_in_day", F.min("oldest").over(day.rowsBetween(1, after))))
    days = each.groupBy("day").agg(F.sum("net").alias("net"), F.min("oldest").alias("oldest"))
    by_day = Window.orderBy("day")  # one row a day
    days = days.select("day", F.coalesce(F.sum("net").over(by_day.rowsBetween(up_to, -1)), F.lit(0)).alias("before"),
                       F.min("oldest").over(by_day.rowsBetween(1, after)).alias("later_days"))
    swept = each.join(days, "day").select("end", (F.col("before") + F.col("in_day")).alias("pending"),
                                          F.least("later_in_day", "later_days", "never").alias("oldest"))
    return swept.where("pending > 0").select((F.col("end") - w).alias("window_start"), F.col("pending").cast("bigint").alias("pending"),
                                             (F.col("end") - F.col("oldest")).alias("oldest_age_s"))


def pipeline_health(rates: DataFrame, lag: DataFrame, ages: DataFrame, max_age_s: int = 300) -> DataFrame:
    """Per window: messages/s, backlog, age of the oldest waiting message, alert when over ``max_age_s``."""
    r = rates.groupBy("window_start").agg(F.sum("n").alias("messages"))
    age = F.coalesce(F.col("oldest_age_s"), F.lit(0))
    return (lag.join(r, "window_start", "left").join(ages.select("window_start", "oldest_age_s"), "window_start", "left").select(
        "window_start",
        F.round(F.coalesce(F.col("messages"), F.lit(0)) / 60.0, 9).alias("messages_per_second"),
        "lag", age.alias("oldest_age_s"), (age > F.lit(max_age_s)).alias("lag_alert")))
