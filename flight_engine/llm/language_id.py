"""Language identification on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of the lower-cased text in which every
non-letter is a blank, weighted by relative frequency in the text times inverse
document frequency over all learning documents. A sparse multinomial logistic
regression is learnt by FTRL with elastic-net penalties on a bounded sample of
labelled rows, and its scores are calibrated by a temperature fitted on rows
that training did not see.

Learning uses only text and non-null lang of documents whose
crc32(doc_id as text) mod 4 is not 2. Prediction reads the text alone, whole.

Defined results: null text or text without letters gives ``und`` with score 0,
as does a table without any labelled learning row; a null doc_id is not held out
and not learnt from; repeated rows get equal predictions; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flight_engine.llm import ftrl
from flight_engine.llm import text as tx

DIM_BITS, MAX_N = 16, 3
DIMS = 1 << DIM_BITS
#: Labelled rows a language gives to the sample: about three quarters train, a quarter calibrates.
SAMPLE_PER_LANG = 800
TF_SCALE = 50.0
_BLOCK = 1 << 18


@functools.lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Code point -> lower-cased code point (0 if no letter), in full range."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table, table != 0


def ngram_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(MAX_N x chars) hashed n-gram ids, DIMS where there is none; char borders; letters by row."""
    table, _ = _letters()
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    cut = tx.chars_before(data)[offsets]
    code = table[points]
    m = len(code)
    ids = np.full((MAX_N, m), DIMS, dtype=np.int64)
    h = np.zeros(m, dtype=np.uint32)
    any_letter = np.zeros(m, dtype=bool)
    left = np.repeat(cut[1:], np.diff(cut)) - np.arange(m)
    for n in range(1, MAX_N + 1):
        if m < n:
            break
        k = m - n + 1
        h = (h[:k] * np.uint32(0x01000193)) ^ (code[n - 1:] + np.uint32(0x9E37 * n))
        any_letter = any_letter[:k] | (code[n - 1:] != 0)
        good = any_letter & (left[:k] >= n)
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        ids[n - 1, :k] = np.where(good, (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - DIM_BITS), DIMS)
    letters = np.concatenate(([0], np.cumsum(code != 0)))
    return ids, cut, letters[cut[1:]] - letters[cut[:-1]]


def _counts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram ids of one text and how often each occurs."""
    flat = ids.ravel()
    return np.unique(flat[flat < DIMS], return_counts=True)


def learning_rows(docs: DataFrame) -> DataFrame:
    """text, lang and the calibration flag of the documents that may be learnt from."""
    split = F.expr("crc32(cast(doc_id as string)) % 4")
    return (docs.select(F.col("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
            .where((split != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select("text", "lang", F.expr("pmod(xxhash64(doc_id, 'calibrate'), 4) = 0").alias("calibrate"),
                    F.expr("pmod(xxhash64(doc_id, 'sample'), 1000000)").alias("draw")))


def document_frequency(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Learning documents and, per hashed n-gram, those that hold it; sums of per-task counters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen, n = np.zeros(DIMS + 1, dtype=np.int64), np.zeros(DIMS + 1, dtype=bool), 0
        for _, data, offsets in tx.text_blocks(batches, block=_BLOCK):
            ids, cut, _ = ngram_ids(data, offsets)
            n += len(offsets) - 1
            for a, b in zip(cut[:-1], cut[1:]):
                seen[:] = False
                seen[ids[:, a:b].ravel()] = True
                df += seen
        df[DIMS] = n
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(df[used])], ["dim", "df"])

    table = (rows.select("text").mapInArrow(count, "dim int, df long")
             .groupBy("dim").agg(F.sum("df").alias("df")).toArrow())
    out = np.zeros(DIMS + 1, dtype=np.int64)
    out[table.column("dim").to_numpy()] = table.column("df").to_numpy()
    return int(out[DIMS]), out[:DIMS]


def _sample(rows: DataFrame, counts: dict[str, int], per_lang: int) -> list[tuple[str, bool, np.ndarray, np.ndarray]]:
    """A bounded sample of labelled rows as n-gram counts, drawn by a hash of doc_id."""
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1000000, per_lang * 1000000 // max(n, 1)))])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in tx.text_blocks(batches, block=_BLOCK):
            ids, cut, _ = ngram_ids(data, offsets)
            pairs = [_counts(ids[:, a:b]) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("calibrate"),
                 pa.array([p[0].astype(np.int32) for p in pairs], pa.list_(pa.int32())),
                 pa.array([p[1].astype(np.int32) for p in pairs], pa.list_(pa.int32()))],
                ["lang", "calibrate", "ids", "counts"])

    drawn = rows.where(F.col("draw") < F.element_at(share, F.col("lang"))).select("lang", "calibrate", "text")
    table = drawn.mapInArrow(features, "lang string, calibrate boolean, ids array<int>, counts array<int>").toArrow()
    out = [(r["lang"], r["calibrate"], np.array(r["ids"], dtype=np.int64), np.array(r["counts"], dtype=float))
           for r in table.to_pylist() if r["ids"]]
    return sorted(out, key=lambda r: (r[0], len(r[2]), r[2].sum(), r[3].sum()))


class Model:
    """Languages and, per hashed n-gram, the weights times IDF; bias and temperature applied."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray):
        self.langs, self.table, self.bias = langs, table, bias

    def logits(self, ids: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Per row the sum over its n-grams, divided by their number."""
        sums = np.zeros((len(cut) - 1, len(self.langs) + 1))
        for line in ids:
            for k in range(len(self.langs) + 1):
                total = np.concatenate(([0.0], np.cumsum(self.table[k][line])))
                sums[:, k] += total[cut[1:]] - total[cut[:-1]]
        return sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.bias


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """The calibrated model, or None where nothing is labelled."""
    rows = learning_rows(docs)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()}
    sample = _sample(rows, counts, per_lang) if counts else []
    langs = sorted({r[0] for r in sample})
    if not langs:
        return None
    n, df = document_frequency(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    code = {lang: i for i, lang in enumerate(langs)}
    made = []
    for lang, calibrate, ids, c in sample:
        x = c / c.sum() * idf[ids] * TF_SCALE
        made.append((calibrate, np.concatenate(([DIMS], ids)), np.concatenate(([1.0], x)), code[lang]))
    learn = [m[1:] for m in made if not m[0]] or [m[1:] for m in made]
    w = ftrl.train(learn, DIMS + 1, len(langs))
    held = [m[1:] for m in made if m[0]]
    t = ftrl.temperature(np.array([x @ w[ids] for ids, x, _ in held]), np.array([y for _, _, y in held], dtype=int)) if held else 1.0
    table = np.zeros((len(langs) + 1, DIMS + 1))
    table[:-1, :DIMS] = (w[:DIMS] * idf[:, None] * TF_SCALE / t).T
    table[-1, :DIMS] = 1
    return Model(langs, table, w[DIMS] / t)


def predict_block(model: Model | None, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], list[float]]:
    ids, cut, letters = ngram_ids(data, offsets)
    if model is None:
        return ["und"] * (len(offsets) - 1), [0.0] * (len(offsets) - 1)
    p = ftrl.softmax(model.logits(ids, cut))
    best = p.argmax(axis=1)
    return ([model.langs[b] if n else "und" for b, n in zip(best, letters)],
            [float(p[i, b]) if n else 0.0 for i, (b, n) in enumerate(zip(best, letters))])


def identify(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, per_lang))

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for _, data, offsets in tx.text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), block=_BLOCK):
            a, b = predict_block(sent.value, data, offsets)
            langs += a
            scores += b
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    held = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False))
    return (docs.select("doc_id", held.alias("held_out"), predict(F.col("text")).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
