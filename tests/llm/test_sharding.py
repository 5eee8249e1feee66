"""Jump consistent hashing and gapless slots."""

import hashlib
import zlib

import numpy as np
import pytest
from brute import SF_SMALL
from pyspark.sql import functions as F

from flight_engine.llm import sharding
from flight_engine.llm.queries import QUERIES


def jump(key, shards):
    """Plain version on Python integers."""
    shard, ahead = -1, 0
    while ahead < shards:
        shard = ahead
        key = (key * 2862933555777941757 + 1) % 2**64
        ahead = int((shard + 1) * (2**31 / ((key >> 33) + 1)))
    return shard


def key_of(doc_id):
    return int(hashlib.sha256(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:16], 16)


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000])
def test_jump_equals_plain_version(shards):
    keys = np.random.default_rng(1).integers(0, 2**64, 2000, dtype=np.uint64)
    assert sharding.jump(keys, shards).tolist() == [jump(int(k), shards) for k in keys]


def test_appended_shards_take_rows_only_into_themselves():
    keys = np.random.default_rng(2).integers(0, 2**64, 100_000, dtype=np.uint64)
    for n in (1, 7, 8, 40):
        a, b = sharding.jump(keys, n), sharding.jump(keys, n + 1)
        assert set(b[a != b].tolist()) == {n}
        assert abs((a != b).mean() - 1 / (n + 1)) < 0.01
        assert np.bincount(b, minlength=n + 1).min() > 0.8 * len(keys) / (n + 1)


def test_no_shards_is_refused():
    with pytest.raises(ValueError):
        sharding.jump(np.zeros(1, np.uint64), 0)


def check_slots(rows, texts, shards):
    slots = {}
    for r in rows:
        assert (r.shard, r.grown_shard) == (jump(key_of(r.doc_id), shards), jump(key_of(r.doc_id), shards + 1))
        slots.setdefault(r.shard, []).append((r.slot, -1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32))
    for found in slots.values():
        found.sort()
        assert [s[0] for s in found] == list(range(len(found)))
        assert [s[1:] for s in found] == sorted(s[1:] for s in found)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in rows)
    assert got == sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)


def test_query_equals_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = QUERIES["op11_sharding"](spark, SF_SMALL).collect()
    assert {r.law for r in rows} == {"key"}
    check_slots(rows, texts, 8)


def test_odd_rows_and_a_hot_key(spark):
    texts = [(1, None), (2, ""), (None, "no id"), (None, None), (3, "é" * 5000), (4, "tie"), (4, "tie"), (4, "other")]
    texts += [(7, "the same row")] * 400
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, shard string, slot int").repartition(3)
    for shards in (1, 8):
        check_slots(sharding.shard_slots(df, shards).collect(), texts, shards)
    assert sharding.shard_slots(df.limit(0), 8).count() == 0


def test_written_shards_hold_every_row_once(spark, tmp_path):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("shard", F.lit("own"))
    sharding.write_shards(df, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == [*df.columns, "shard_"]  # the table has a shard of its own
    assert sorted(tuple(r) for r in back.select(df.columns).collect()) == sorted(tuple(r) for r in df.collect())
    assert all(r.shard_ == jump(key_of(r.doc_id), 5) for r in back.select("doc_id", "shard_").collect())


def test_moved_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(1).alias("from_shard"))
    rows = sharding.moved(df, 8, 10).collect()
    want = {i for i in range(3000) if jump(key_of(i), 8) != jump(key_of(i), 10)}
    assert {r.row.doc_id for r in rows} == want and {r.to_shard for r in rows} == {8, 9}


def test_numbers_do_not_depend_on_partitions(spark):
    from flight_engine.llm.numbering import numbered
    rows = [(i % 3, i * 7 % 50) for i in range(500)] + [(1, 5)] * 300
    want = {g: sorted(v for h, v in rows if h == g) for g in range(3)}
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "g int, v int").repartition(parts)
        out = numbered(df, [F.col("v").asc()], ["g"], "at").collect()
        for g in range(3):
            assert [v for _, v in sorted((r["at"], r["v"]) for r in out if r["g"] == g)] == want[g]
            assert sorted(r["at"] for r in out if r["g"] == g) == list(range(len(want[g])))
        every = numbered(df, [F.col("v").desc()], [], "at").collect()
        assert [v for _, v in sorted((r["at"], r["v"]) for r in every)] == sorted((v for _, v in rows), reverse=True)
