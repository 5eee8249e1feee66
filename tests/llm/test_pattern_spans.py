"""Span helpers against plain versions, and texts with very many matches."""

import random
import time

import brute
import pytest
from pyspark.sql import functions as F

from flight_engine.llm import pattern_spans as ps


@pytest.fixture(scope="module")
def spans(spark):
    rnd = random.Random(1)

    def some(n):
        out = []
        for _ in range(n):
            a = rnd.randrange(2000)
            out.append((a, a + rnd.randrange(1, 30), f"k{rnd.randrange(3)}"))
        return sorted(out)

    sizes = [(0, 3), (5, 0), (3, 4), (60, 50), (300, 200), (1, 2000)]
    rows = [(k, some(sizes[k % 6][0]), some(sizes[k % 6][1]), "".join(rnd.choice("abé\n𝄞x") for _ in range(2100))) for k in range(48)]
    kind = "array<struct<start: int, end: int, kind: string>>"
    return rows, spark.createDataFrame(rows, f"id int, a {kind}, b {kind}, t string").repartition(2)


def joined(spans):
    out = []
    for s, e, kind in spans:
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e, kind])
    return out


def test_helpers_equal_plain_versions(spans):
    rows, df = spans
    a, b = F.col("a"), F.col("b")
    out = {r.id: r for r in df.select(
        "id", ps.overlapping(a, b).alias("hit"), ps.overlapping(a, b, 40).alias("near"), ps.outside(a, b).alias("out"), ps.merged(a).alias("m"),
        ps.running(F.transform(a, lambda x: x["end"]), ps._add).alias("sums"), ps.replaced(F.col("t"), ps.merged(a)).alias("t")).collect()}
    for k, a, b, t in rows:
        r = out[k]
        for got, margin in ((r.hit, 0), (r.near, 40)):
            assert got == [any(s - margin < f and c < e + margin for c, f, _ in b) for s, e, _ in a]
        assert [tuple(x) for x in r.out] == [x for x, hit in zip(a, r.hit) if not hit]
        assert [list(x) for x in r.m] == joined(a)
        assert r.sums == [sum(e for _, e, _ in a[:i]) for i in range(len(a))]
        want, at = "", 0
        for s, e, kind in joined(a):
            want, at = want + t[at:s] + f"<{kind.upper()}>", e
        assert r.t == want + t[at:]


def test_a_text_with_200_000_matches(spark):
    """Costs follow the matches: a hundred times as many take well under a hundred times as long."""
    from flight_engine.llm import pii, secret_scan
    took = []
    for n in (2000, 200_000):
        text = "; ".join(f"u{i}@ex{i % 7}.org" if i % 3 else f"10.0.{i % 250}.{i % 200} password: abcdefgh{i}" for i in range(n))
        df = spark.createDataFrame([(1, text), (2, "plain words")], "doc_id long, text string")
        began = time.monotonic()
        found = {r.doc_id: r for r in pii.pii_digests(df).collect()}
        assert found[1].base_sha256 == brute.sha(brute.pii(text)) and found[2].spans == ""
        secret = {r.doc_id: r for r in secret_scan.secret_digests(df).collect()}
        assert secret[1].base_sha256 == brute.sha(brute.secrets(text))
        clean = {r.doc_id: r.text for r in pii.redact(df).collect()}
        assert not brute.pii(clean[1]) and clean[1].count("<EMAIL>") + clean[1].count("<IP>") == n and clean[2] == "plain words"
        took.append(time.monotonic() - began)
    assert took[1] < 30 * took[0]


def test_secret_scan_of_many_and_of_long_tokens(spark):
    """A text of 240 keys costs no multiple of as many texts of one key, has the same spans, and long keys are no dearer than many."""
    import string
    from flight_engine.llm.secret_scan import secret_digests
    rnd = random.Random(11)
    keys = ["".join(rnd.choices(string.ascii_letters + string.digits, k=20 + i % 30)) for i in range(240)]
    starts = [sum(len(k) + 1 for k in keys[:i]) for i in range(len(keys))]

    def scanned(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        began = time.monotonic()
        return {r.doc_id: r.spans for r in secret_digests(df).collect()}, time.monotonic() - began

    apart, took_apart = scanned(keys)
    together, took_together = scanned([" ".join(keys)])
    want = [f"random:{starts[i] + int(a)}:{starts[i] + int(b)}" for i in range(len(keys)) if apart[i] for _, a, b in [apart[i].split(":")]]
    assert len(want) > 150 and together[0].split(",") == want
    assert took_together < 3 * took_apart + 5
    _, took_long = scanned(["".join(rnd.choices(string.ascii_letters + string.digits, k=20_000)) for _ in range(4)])
    assert took_long < 3 * took_apart + 5


def test_secret_scan_reads_its_texts_once_and_words_of_any_length(spark, tmp_path, monkeypatch):
    from flight_engine.llm import secret_scan
    texts = ["", None, "a1" * 10, "a1" * 9 + "b", "x\n" + "b2" * 12 + "\ty", "é" + "c3" * 11 + "東 " + "d" * 40, "0" * 32, "AKIA" + "A" * 12,
             "PASSWORD \t: " + "e" * 9, "aPi_KeY'  =  \"" + "f" * 9, "secret  " * 3, "Passwd=" + "g" * 8, "h" * 19 + " " + "h" * 20]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    found = secret_scan.secret_digests(spark.read.parquet(path))
    assert not any("documents.parquet" in f for f in found.inputFiles())
    rows = {r.doc_id: r for r in found.collect()}
    assert all(rows[i].base_sha256 == brute.sha(brute.secrets(t or "")) for i, t in enumerate(texts))
    monkeypatch.setattr(secret_scan, "WORDS_BYTES", 0)
    assert {r.doc_id: r for r in secret_scan.secret_digests(spark.read.parquet(path)).collect()} == rows
