"""Histogram buckets and quantile interpolation."""

from flight_engine.operators.metrics import histogram_buckets, histogram_quantile


def test_buckets_cumulative_with_empty_buckets(spark):
    vals = [("a", 0.5), ("a", 3.0), ("a", 3.0), ("a", 50.0), ("b", 1000.0)]
    d = spark.createDataFrame(vals, "label string, value double")
    b = {(r.label, r.le): r.bucket_count for r in histogram_buckets(d, [1, 5, 10]).collect()}
    assert b == {("a", "1"): 1, ("a", "5"): 3, ("a", "10"): 3, ("a", "+Inf"): 4,
                 ("b", "1"): 0, ("b", "5"): 0, ("b", "10"): 0, ("b", "+Inf"): 1}


def test_quantile_interpolates(spark):
    # 100 observations: 50 in (0,1], 50 in (1,2]; p95 = 1 + (95-50)/50 = 1.9
    vals = [("a", 0.5)] * 50 + [("a", 1.5)] * 50 + [("b", 99.0)] * 3
    d = spark.createDataFrame(vals, "label string, value double")
    q = {r.label: r.quantile for r in histogram_quantile(histogram_buckets(d, [1, 2, 5]), 0.95).collect()}
    assert abs(q["a"] - 1.9) < 1e-9
    assert q["b"] == 5.0  # +Inf bucket -> highest finite bound
