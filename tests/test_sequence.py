"""with_previous == plain lag, with hot keys, over any number of partitions, in one exchange of rows."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flight_engine.operators.sequence import _ranged, with_previous


def same(got, want):
    cols = sorted(want.columns)
    got, want = got.select(*cols), want.select(*cols)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def lagged(d, n, cols):
    w = Window.partitionBy("k").orderBy("ts", "tb")
    for i in range(1, n + 1):
        for c in cols:
            d = d.withColumn(f"prev{i}_{c}", F.lag(c, i).over(w))
    return d


@pytest.mark.parametrize("parts", [1, 2, 7, 60])
def test_with_previous_equals_lag(spark, parts):
    rnd = random.Random(parts)
    rows = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.4 else None if rnd.random() < 0.05 else f"k{rnd.randrange(20)}"
        rows.append((key, rnd.randrange(0, 500), i, rnd.random() if i % 7 else None, i % 3 == 0))
    d = spark.createDataFrame(rows, "k string, ts long, tb long, v double, flag boolean")
    got = with_previous(d, "k", "ts", ["v", "ts", "flag"], n=3, tiebreak=("tb",), partitions=parts)
    assert same(got, lagged(d, 3, ["v", "ts", "flag"]))


@pytest.mark.parametrize("arrow_rows", [1, 2, 5])
def test_borders_of_arrow_batches(spark, arrow_rows):
    d = spark.createDataFrame([(f"k{i % 4}" if i < 60 else "long", i, i, float(i)) for i in range(200)], "k string, ts long, tb long, v double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow_rows)
    try:
        for parts in (1, 3, 150):
            assert same(with_previous(d, "k", "ts", ["v"], n=4, tiebreak=("tb",), partitions=parts), lagged(d, 4, ["v"]))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_empty_and_single_rows(spark):
    d = spark.createDataFrame([("a", 1, 1, 1.0)], "k string, ts long, tb long, v double")
    assert same(with_previous(d, "k", "ts", ["v"], n=2, tiebreak=("tb",)), lagged(d, 2, ["v"]))
    assert with_previous(d.limit(0), "k", "ts", ["v"], n=2).count() == 0


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_and_one_exchange_of_rows(spark, tmp_path):
    """Source rows are scanned and exchanged once; what follows moves a row or two a partition."""
    path = str(tmp_path / "rows")
    spark.range(5000).selectExpr("concat('k', id % 7) as k", "id as ts", "rand(1) as v").repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    p = final_plan(_ranged(df, "k", "ts", ["v"], 2, (), 6)).split("== Initial Plan ==")[0]
    assert len(re.findall("Exchange", p)) == 1 and "Exchange rangepartitioning(k" in p
    assert len(re.findall(r"(?:FileScan|Scan) parquet", p)) == 1
    p = final_plan(with_previous(df, "k", "ts", ["v"], n=2, partitions=6)).split("== Initial Plan ==")[0]
    assert path not in p and "rangepartitioning" not in p and "SortMergeJoin" not in p and "BroadcastHashJoin" in p


@pytest.mark.parametrize("equal", [False, True])
def test_a_hot_second_of_one_key_is_spread(spark, equal):
    """A third of all rows in one second of one aircraft, also as replays of one row, over several tasks."""
    rows = [(f"k{i % 50}", i, i, float(i)) for i in range(4000)] + [("hot", 10, 0 if equal else i, 0.5) for i in range(2000)]
    d = spark.createDataFrame(rows, "k string, ts long, tb long, v double").repartition(8)
    hot = [r[1] for r in _ranged(d, "k", "ts", ["ts"], 2, ("tb",), 24).where("k = 'hot'").groupBy("_pid").count().collect()]
    assert len(hot) >= 5 and max(hot) < 800
    out = with_previous(d, "k", "ts", ["ts"], n=2, tiebreak=("tb",), partitions=24)
    assert out.where("k = 'hot' and prev2_ts = 10").count() == 1998
    if not equal:
        assert same(out, lagged(d, 2, ["ts"]))
