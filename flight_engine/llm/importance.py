"""Importance resampling towards a target text by hashed n-gram features.

Separators (and upper case A-Z) are mapped and collapsed to single spaces once per text. Then
one expression per n-gram length scans the bytes with ``finditer(overlapped=True)``: lookarounds
hold each match to word borders, so a match is an n-gram's span as it stands, and its CRC-32
is taken from the span without joining words anew.

Bucket counts of a document are written once (bucket, count), so the corpus totals and the
documents' weights come from them and the texts are read one time. A partition adds
its counts to one fixed vector before the shuffle; the gains are a table of BUCKETS numbers.
Drawing without replacement is Gumbel top-k: each document's weight plus a noise that its
id decides, of which the highest are drawn by a distributed ranking.

Defined results: null, empty and wordless texts have no features and weight 0; a document with
fewer than ``min_words`` words is scored and never drawn; repeated rows are documents of their
own with equal scores; a null doc_id counts as an empty one and comes last among ties; extra
columns are ignored; with an empty target every gain follows from the corpus alone; an empty
table gives an empty result. Texts are scanned whole, and an iterator holds one span at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flight_engine.llm import text as tx
from flight_engine.llm.numbering import numbered
from flight_engine.llm.store import stage

BUCKETS = 10_000
MIN_WORDS, PERCENT, SEED = 20, 10, 2024

#: Every byte to itself, A-Z to a-z, and bytes outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` to a space.
_SPACED = bytes(c if tx.ALNUM_WORD[c] else 0x20 for c in tx.LOWER.tolist())
_SPACES = regex.compile(rb" +")


def collapse(raw: bytes) -> bytes:
    """Lower-cased words of UTF-8 text, one space between them."""
    return _SPACES.sub(b" ", raw.translate(_SPACED)).strip(b" ")


def gram_pattern(n: int) -> regex.Pattern:
    """Spans of n words in collapsed text."""
    more = rb"(?: [^ ]++){%d}" % (n - 1) if n > 1 else b""
    return regex.compile(rb"(?<![^ ])[^ ]++" + more + rb"(?![^ ])")


def spans(words: bytes, n: int) -> Iterator[tuple[int, int]]:
    """Start and end of every run of n consecutive words of collapsed text."""
    return (m.span() for m in gram_pattern(n).finditer(words, overlapped=True))


def _feature_rows(lengths: range):
    patterns = [gram_pattern(n) for n in lengths]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = zlib.crc32
        for batch, data, offsets in tx.text_blocks(batches):
            raw, words, features, buckets, counts = data.tobytes(), [], [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                flat = collapse(raw[a:b])
                hashes = np.fromiter((crc(m[0]) for p in patterns for m in p.finditer(flat, overlapped=True)), np.uint32)
                words.append(flat.count(b" ") + 1 if flat else 0)
                features.append(len(hashes))
                found, times = np.unique(hashes % np.uint32(BUCKETS), return_counts=True)
                buckets.append(found.astype(np.int32))
                counts.append(times)
            ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in buckets]))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(buckets))),
                 pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts).astype(np.int64)))],
                ["doc_id", "n_words", "n_features", "buckets", "counts"])

    return rows


def bucket_counts(texts: DataFrame, low: int = 1, high: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, buckets and counts of each text's runs of ``low`` to ``high`` words."""
    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_feature_rows(range(low, high + 1)),
                           "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        at, n = batch.column("buckets").flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
        np.add.at(total, at, n)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["bucket", "n"])


def totals(counted: DataFrame) -> DataFrame:
    """bucket and n over all rows; a partition sends at most BUCKETS sums."""
    return (counted.select("buckets", "counts").mapInArrow(_sums, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame) -> DataFrame:
    """bucket and gain, in thousandths of a natural logarithm, for each of the BUCKETS buckets."""
    spark = corpus.sparkSession
    whole = lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    both = (every.join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
            .join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"]))
    up = (F.col("t") + 1).cast("double") * F.lit(float(whole(corpus) + BUCKETS))
    down = (F.col("s") + 1).cast("double") * F.lit(float(whole(target) + BUCKETS))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).cast("long").alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, decided by the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weighted(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight: the gains of a document's features."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("buckets")
            worth = gain[column.flatten().to_numpy()] * batch.column("counts").flatten().to_numpy()
            sums = np.concatenate(([0], np.cumsum(worth)))
            ends = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "n_words", "n_features")], pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"])

    return counted.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """Every document's n_words, n_features, weight, score and rank (null: not drawn).

    ``docs`` has doc_id and text, ``target`` text. Drawn: ``percent`` of the documents of at least
    ``min_words`` words, by score, ties to the smaller doc_id.
    """
    counted = stage(bucket_counts(docs, low, high), "importance-counts")
    aim = bucket_counts(target.select(F.lit(None).alias("doc_id"), "text"), low, high)
    table = gains(stage(totals(counted), "importance-corpus"), stage(totals(aim), "importance-target"))
    gain = np.zeros(BUCKETS, dtype=np.int64)
    for r in table.collect():  # BUCKETS rows whatever the corpus
        gain[r["bucket"]] = r["gain"]
    scored = stage(weighted(counted, gain).select("*", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")),
                   "importance-scores")
    able = scored.where(F.col("n_words") >= min_words)
    ranked = numbered(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], [], "place")
    drawn = able.count() * percent // 100
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).drop("place").union(rest)
