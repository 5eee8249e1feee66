"""Importance resampling against a plain version."""

import collections
import hashlib
import math
import re
import zlib

from brute import SF_SMALL, lower
from pyspark.sql import functions as F

from flight_engine.llm import importance
from flight_engine.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def features(text, low=1, high=1):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def resample(docs, target, low=1, high=1):
    """[(doc_id, n_features, weight, score, rank)] in the documents' order."""
    own = [features(t, low, high) for _, t in docs]
    s = collections.Counter(b for f in own for b in f)
    t = collections.Counter(b for x in target for b in features(x, low, high))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for (doc_id, text), f in zip(docs, own):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in f)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None, len(words(text))])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(able[:len(able) * 10 // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=key)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = rows_of(QUERIES["op13_importance_resampling"](spark, SF_SMALL))
    assert got == sorted(resample(docs, target), key=key) and max(r[4] or 0 for r in got) > 5


def test_longer_grams(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    target = spark.createDataFrame([(docs[0][1],)], "text string")
    assert rows_of(importance.resample(df, target, 1, 3)) == sorted(resample(docs, [docs[0][1]], 1, 3), key=key)


def test_overlapped_spans_are_the_runs_of_words():
    text = "  A--b 'c'\tÉa9\n\x00\x7f d A b".encode()
    flat = importance.collapse(text)
    assert flat == "a b c Éa9 d a b".encode()
    for n in range(1, 9):
        w = flat.decode().split(" ")
        assert [flat[a:b].decode() for a, b in importance.spans(flat, n)] == [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
    assert importance.collapse(b" -- ") == b"" and list(importance.spans(b"", 1)) == []


def test_odd_rows(spark):
    long = " ".join(f"w{i % 700}" for i in range(40_000))
    docs = [(1, None), (2, ""), (3, "\x00 -- \t"), (None, long), (4, long), (4, long), (5, "few words"), (6, "é" * 9000)]
    docs += [(i, " ".join(f"w{(i * j) % 90}" for j in range(25))) for i in range(10, 60)] + [(70, "tie " * 30)] * 8
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, weight int, buckets string").repartition(4)
    target = spark.createDataFrame([("w1 w2 w3", 1), (None, 2)], "text string, n int")
    assert rows_of(importance.resample(df, target)) == sorted(resample(docs, ["w1 w2 w3", None]), key=key)
    none = target.limit(0)
    assert rows_of(importance.resample(df, none)) == sorted(resample(docs, []), key=key)
    assert importance.resample(df.limit(0), target).count() == 0


def test_drawn_documents_are_nearer_to_the_target(spark):
    rows = [(i, ("goal " if i % 10 == 0 else "other ") * 20 + f"w{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = importance.resample(df, spark.createDataFrame([("goal " * 500,)], "text string"))
    drawn = [r.doc_id for r in out.where(F.col("rank").isNotNull()).collect()]
    assert len(drawn) == 100 and sum(i % 10 == 0 for i in drawn) == 100
