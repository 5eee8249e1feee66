"""Spelling variants against all pairs."""

import collections
import random
import re
import zlib

import pytest
from brute import SF_SMALL, lower
from pyspark.sql import functions as F

from flight_engine.llm import spelling
from flight_engine.llm.queries import QUERIES


def corpus_words(docs):
    count = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def groups(words, ratio=5):
    """{word: (form, root, n, n_near, form_n)}, each pair compared."""
    links = collections.defaultdict(list)
    names = sorted(words)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if abs(len(a) - len(b)) <= 1 and near(a, b):
                links[a].append(b)
                links[b].append(a)
    form = {}
    for w in names:
        best = min(links[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), words[w], len(links[w]), words[form[w]] if form[w] else None) for w in names}


def rows_of(df):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    words = corpus_words(docs)
    got = rows_of(QUERIES["op12_spelling_variants"](spark, SF_SMALL))
    assert len(words) > 300 and {w: r[2] for w, r in got.items()} == words
    assert got == groups(words)


@pytest.mark.parametrize("pairs_a_row", [16, 0.1])
def test_words_that_share_long_parts(spark, monkeypatch, pairs_a_row):
    """A third of the words share a half; cutting them again loses no pair and finds none twice."""
    monkeypatch.setattr(spelling, "PAIRS_A_ROW", pairs_a_row)
    rnd = random.Random(5)
    words = {}
    for _ in range(250):
        words["common" + "".join(rnd.choice("ab") for _ in range(rnd.randrange(4, 8)))] = rnd.randrange(5, 4000)
        words["".join(rnd.choice("abcé") for _ in range(rnd.randrange(6, 9)))] = rnd.randrange(5, 4000)
        words["".join(rnd.choice("ab") for _ in range(6)) + "ending"] = rnd.randrange(5, 4000)
    words |= {"a" * n: 5 ** (n - 5) for n in range(6, 13)}  # a chain of forms
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = rows_of(spelling.variants(df))
    assert got == groups(words)
    assert got["aaaaaa"][1] == "a" * 12


def test_a_hot_key_is_not_paired(spark):
    """4,000 words with one half in common: candidates stay near the words, far from all pairs."""
    rnd = random.Random(6)
    words = sorted({"shared" + "".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(6)) for _ in range(4000)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    seen = []
    real = spelling.stage

    def spy(d, name):
        out = real(d, name)
        if name == "near-few":
            counts = out.groupBy("key").agg(F.count_if("shorter").alias("s"), F.count_if(~F.col("shorter")).alias("l"))
            seen.append(counts.agg(F.sum(F.expr("s * (s - 1) / 2 + s * l"))).first()[0] or 0)
        return out

    try:
        spelling.stage = spy
        found = spelling.near_pairs(df).count()
    finally:
        spelling.stage = real
    assert sum(seen) < 40 * len(words) < len(words) ** 2 / 90
    assert found == sum(near(a, b) for i, a in enumerate(words) for b in words[i + 1:] if a[6:8] == b[6:8] or a[9:] == b[9:])


def test_odd_texts(spark):
    long = "é" * 30_000
    docs = [(1, None), (2, ""), (3, "12 ++ 34"), (None, "letter letter"), (4, long), (4, long), (5, " ".join(["letter"] * 9 + ["lettre"] * 6)),
            (6, " ".join(["Àbcdef×÷x"] * 5 + ["ÀBCDEF×÷"] * 30)), (7, long + " " + long[1:] * 1), (8, (long + " ") * 4), (9, (long[1:] + " ") * 5)]
    df = spark.createDataFrame([(i, t, "w", 3) for i, t in docs], "doc_id long, text string, word string, n int")
    run = spelling.planted_deletions(spelling.letter_runs(df).where(F.char_length("run") >= 6))
    got = rows_of(spelling.variants(spelling.word_counts(run)))
    want = corpus_words(docs)
    assert got == groups(want) and long in got and got["Àbcdef×÷"][2] >= 28
    assert spelling.variants(spelling.word_counts(spelling.letter_runs(df.limit(0)))).count() == 0
