"""Type-2 versions from a change feed, and the as-of join, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from flight_engine.operators import scd2
from flight_engine.session import scratch_path

SCHEMA = "seq long, k string, a int, b string, valid_from long"


def plain(feed):
    """{key: [(a, b, valid_from, valid_to, version, is_current)]}."""
    said = {}
    for seq, k, a, b, t in sorted(feed, key=lambda r: r[0]):
        if k is not None and t is not None:
            said[k, t] = (a, b)
    out = {}
    for (k, t), v in sorted(said.items()):
        own = out.setdefault(k, [])
        if not own or own[-1][:2] != v:
            own.append((*v, t))
    return {k: [(*v, own[i + 1][2] if i + 1 < len(own) else None, i + 1, i + 1 == len(own)) for i, v in enumerate(own)] for k, own in out.items()}


def stored(spark, path):
    out = {}
    for r in scd2.read_versions(spark, path).orderBy("k", "version").collect():
        out.setdefault(r.k, []).append((r.a, r.b, r.valid_from, r.valid_to, r.version, r.is_current))
    return out


def random_feed(n, seed):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(6)}"
    return [(i, key(), rnd.choice([1, 1, 2, None]), rnd.choice("xy"), rnd.randrange(0, 40) * 10) for i in range(n)]


@pytest.mark.parametrize("batches", [1, 4])
def test_any_split_of_the_feed_gives_the_same_versions(spark, batches):
    feed = random_feed(150, batches) + [(900, None, 1, "x", 5), (901, "k1", 1, "x", None)]
    random.Random(9).shuffle(feed)
    path = scratch_path(spark, "t-scd2")
    for i in range(batches):
        scd2.apply_changes(spark, path, spark.createDataFrame(feed[i::batches], SCHEMA), "k", ["a", "b"], buckets=4)
    assert stored(spark, path) == plain(feed)


def test_versions_open_close_split_and_merge(spark):
    path = scratch_path(spark, "t-scd2")

    def apply(*rows):
        scd2.apply_changes(spark, path, spark.createDataFrame(list(rows), SCHEMA), "k", ["a", "b"])
        return stored(spark, path)["k"]

    assert apply((1, "k", 1, "x", 100)) == [(1, "x", 100, None, 1, True)]
    assert apply((2, "k", 2, "x", 200)) == [(1, "x", 100, 200, 1, False), (2, "x", 200, None, 2, True)]
    # a repeat opens nothing, also when it comes again
    once = apply((3, "k", 2, "x", 300))
    assert once == apply((3, "k", 2, "x", 300)) == [(1, "x", 100, 200, 1, False), (2, "x", 200, None, 2, True)]
    # a late change splits the open version; the repeat at 300 now says that it ended there
    split = apply((4, "k", 3, "x", 250))
    assert [v[:4] for v in split] == [(1, "x", 100, 200), (2, "x", 200, 250), (3, "x", 250, 300), (2, "x", 300, None)]
    # a correction of one time by a later word; an older word does not come back
    assert [v[:4] for v in apply((6, "k", 1, "x", 200), (5, "k", 9, "x", 200))] == [(1, "x", 100, 250), (3, "x", 250, 300), (2, "x", 300, None)]


def test_a_batch_touches_its_buckets_only(spark):
    from flight_engine.files import folders
    path = scratch_path(spark, "t-scd2")
    feed = [(i, f"k{i}", 1, "x", 10) for i in range(60)]
    scd2.apply_changes(spark, path, spark.createDataFrame(feed, SCHEMA), "k", ["a", "b"], buckets=8)

    def files():
        df = spark.read.parquet(f"{path}/versions")
        return {r[0]: r[1] for r in df.select("bucket", F.input_file_name().alias("f")).groupBy("bucket").agg(F.sort_array(F.collect_set("f"))).collect()}

    before = files()
    touched = scd2.apply_changes(spark, path, spark.createDataFrame([(99, "k7", 2, "x", 20)], SCHEMA), "k", ["a", "b"], buckets=8)
    after = files()
    assert len(touched) == 1 and len(folders(spark, f"{path}/log")) == 8
    assert {b for b in before if before[b] != after[b]} == set(touched)
    assert stored(spark, path) == plain([*feed, (99, "k7", 2, "x", 20)])


@pytest.mark.parametrize("max_rows", [10 ** 6, 0])
def test_asof_join_equals_plain_lookup(spark, max_rows):
    feed = random_feed(120, 3)
    versions = plain(feed)
    path = scratch_path(spark, "t-scd2")
    scd2.apply_changes(spark, path, spark.createDataFrame(feed, SCHEMA), "k", ["a", "b"])
    rnd = random.Random(8)
    facts = [(i, rnd.choice(["hot", "k1", "k2", "none", None]), rnd.choice([0, 10, 399, 400, None, rnd.randrange(-50, 500)])) for i in range(400)]
    df = spark.createDataFrame(facts, "id int, k string, t long")
    out = scd2.asof_join(df, scd2.read_versions(spark, path), "k", "t", {"version": "version", "a": "value"}, period=37, max_rows=max_rows)
    assert out.columns == ["id", "k", "t", "version", "value"]

    def at(k, t):
        found = [(v[4], v[0]) for v in versions.get(k, []) if t is not None and v[2] <= t and (v[3] is None or t < v[3])]
        return found[0] if found else (None, None)

    assert sorted((r.id, r.version, r.value) for r in out.collect()) == [(i, *at(k, t)) for i, k, t in facts]
    assert scd2.asof_join(df.limit(0), scd2.read_versions(spark, path), "k", "t", {"version": "version"}).count() == 0
