"""Quality rules whose thresholds follow each language and source.

Every document gets integer metrics. Per (lang, source) a mergeable quantile
sketch of each metric (log-linear integer bins, exact counts, so sketches of
parts add up to the sketch of the whole) gives the quartiles; the upper fence
``q75 + spread * max(q75 - q25, floor)`` replaces a fixed cutoff. Small groups
use the merged sketch of their language, small languages that of the corpus.
A document is kept if it passes the base rules and no metric is over its fence.

Defined results: null or empty text has no words and fails the base rules; null
lang or source form groups of their own; repeated rows are judged row by row;
extra columns are ignored (``rule_verdicts``) or carried (``keep_documents``);
an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flight_engine.llm import text as tx
from flight_engine.llm.store import stage

#: metric: (numerator, denominator, scale, floor of the quartile distance)
METRICS = {
    "symbol": ("n_symbols", "word_chars", 1000, 6),
    "upper": ("n_upper", "word_chars", 1000, 25),
    "dup_line": ("n_dup_lines", "n_lines", 1000, 60),
    "repeat": ("n_repeat_words", "n_words", 1000, 25),
    "word_len": ("word_chars", "n_words", 100, 150),
}
SPREAD = 8
#: Documents a group needs for a sketch of its own.
MIN_GROUP = 100
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 10, 20, 5
#: Largest threshold table sent to every task; above it the join shuffles.
MAX_BROADCAST_GROUPS = 50_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LINE = np.ones(256, dtype=bool)
_LINE[10] = False


def _sum_by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(h: np.ndarray) -> np.ndarray:
    """Flags of the values that occur twice or more."""
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    out = np.zeros(len(h), dtype=bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _count_block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    wh, starts, ends, edges = tx.word_hashes(data, offsets, lower=False)
    heads = tx.chars_before(data)
    chars = np.concatenate(([0], np.cumsum(heads[ends] - heads[starts])))
    line_s, line_e = tx.spans(data, offsets, _LINE)
    worded = np.searchsorted(starts, line_e) > np.searchsorted(starts, line_s)
    line_s, line_e = line_s[worded], line_e[worded]
    line_h = tx.span_hash(data, line_s, line_e)
    line_edges = tx.row_edges(tx.rows_of(offsets, line_s), n)
    windows, window_edges = tx.shingles(wh, edges, WINDOW)
    dup, repeat = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        a, b = line_edges[i:i + 2]
        if b - a > 1:
            dup[i] = b - a - len(np.unique(line_h[a:b]))
        a, b = window_edges[i:i + 2]
        if b - a > 1:
            again = _repeated(windows[a:b])
            if again.any():
                steps = np.zeros(b - a + WINDOW, dtype=np.int64)
                steps[:b - a] += again
                steps[WINDOW:] -= again
                repeat[i] = np.count_nonzero(np.cumsum(steps))
    return {"n_words": np.diff(edges), "word_chars": chars[edges[1:]] - chars[edges[:-1]],
            "n_symbols": _sum_by_row(_SYMBOL[data], offsets), "n_dup_lines": dup, "n_repeat_words": repeat,
            "n_lines": np.diff(line_edges), "n_upper": _sum_by_row(_UPPER[data], offsets)}


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def text_counts(texts: pa.Array) -> pa.Array:
    """The integer counts of each text that rules and metrics use."""
    parts = [_count_block(d, o) for _, d, o in
             tx.text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.empty(0, np.int64), pa.int64())
         for c in COUNTS], COUNTS)


def _metric(prefix: str, name: str) -> Column:
    num, den, scale, _ = METRICS[name]
    return F.expr(f"if({prefix}{den} > 0, {prefix}{num} * {scale} div {prefix}{den}, 0L)")


def _bin(v: str) -> str:
    """Lower edge of the log-linear bin of a non-negative integer: six leading bits stay."""
    return f"if({v} < 64, {v}, shiftleft(shiftright({v}, length(bin({v})) - 6), length(bin({v})) - 6))"


def sketch(measured: DataFrame, *keys: str) -> DataFrame:
    """Counts by key, metric and bin. Sketches merge by adding counts."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), _metric("", m).alias("v")) for m in METRICS])
    return (measured.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.metric", F.expr(_bin("p.v")).alias("edge"))
            .groupBy(*keys, "metric", "edge").agg(F.count(F.lit(1)).alias("c")))


def fences(merged: DataFrame, keys: list[str], spread: int = SPREAD) -> DataFrame:
    """One row per key: documents and the upper fence of each metric, from a sketch.

    The windows run over bins (a few hundred a key at most), not documents.
    """
    w = Window.partitionBy(*keys, "metric") if keys else Window.partitionBy("metric")
    ranked = (merged.withColumn("n", F.sum("c").over(w))
              .withColumn("cum", F.sum("c").over(w.orderBy("edge").rowsBetween(Window.unboundedPreceding, 0))))
    quart = ranked.groupBy(*keys, "metric").agg(
        F.max("n").alias("n"),
        F.min(F.expr("if(cum * 4 >= n, edge, null)")).alias("q25"),
        F.min(F.expr("if(cum * 4 >= n * 3, edge, null)")).alias("q75"))
    return quart.groupBy(*keys).agg(F.max("n").alias("n"), *[
        F.max(F.expr(f"if(metric = '{m}', q75 + {spread} * greatest(q75 - q25, {floor}), null)")).alias(f"t_{m}")
        for m, (_, _, _, floor) in METRICS.items()])


def adaptive_fences(measured: DataFrame, min_group: int = MIN_GROUP, spread: int = SPREAD) -> DataFrame:
    """Fences for every (lang, source): its own, else its language's, else the corpus's."""
    cols = [f"t_{m}" for m in METRICS]
    own_sketch = stage(sketch(measured, "lang", "source"), "quality-sketch")
    by_lang = own_sketch.groupBy("lang", "metric", "edge").agg(F.sum("c").alias("c"))
    corpus = by_lang.groupBy("metric", "edge").agg(F.sum("c").alias("c"))
    own = fences(own_sketch, ["lang", "source"], spread)
    lang = fences(by_lang, ["lang"], spread).select(
        F.col("lang").alias("l_lang"), F.col("n").alias("l_n"), *[F.col(c).alias(f"l_{c}") for c in cols])
    every = fences(corpus, [], spread).select(F.struct(*cols).alias("every")).scalar()
    picked = [F.when(F.col("n") >= min_group, F.col(c)).when(F.col("l_n") >= min_group, F.col(f"l_{c}"))
              .otherwise(every.getField(c)).alias(c) for c in cols]
    return (own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
            .select(F.col("lang").alias("k_lang"), F.col("source").alias("k_source"), *picked))


def _with_fences(measured: DataFrame, limits: DataFrame, lang: str, source: str) -> DataFrame:
    """Joined with the fences; they go to every task only if their number is under the bound."""
    if limits.count() <= MAX_BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    return measured.join(limits, F.col(lang).eqNullSafe(F.col("k_lang")) & F.col(source).eqNullSafe(F.col("k_source")), "left")


def _verdict(prefix: str) -> tuple[Column, Column]:
    failed = F.expr(f"{prefix}n_words < {MIN_WORDS} or 100 * {prefix}n_repeat_words > {MAX_REPEAT_PCT} * {prefix}n_words")
    inside = reduce(Column.__and__, [_metric(prefix, m) <= F.col(f"t_{m}") for m in METRICS])
    return failed, ~failed & F.coalesce(inside, F.lit(True))


def measure(docs: DataFrame) -> DataFrame:
    return (docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                        text_counts(F.col("text")).alias("m"))
            .select("doc_id", "lang", "source", "m.*"))


def rule_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the metrics' fences."""
    measured = stage(measure(docs), "quality-counts")
    limits = stage(adaptive_fences(measured), "quality-fences")
    failed, kept = _verdict("")
    return _with_fences(measured, limits, "lang", "source").select(
        "doc_id", *COUNTS, failed.alias("base_failed"), kept.alias("kept"), *[f"t_{m}" for m in METRICS])


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    limits = stage(adaptive_fences(stage(measure(docs), "quality-counts")), "quality-fences")
    own = docs.select(F.struct("*").alias("own_row"), text_counts(F.col("text")).alias("m")).select(
        "own_row", F.col("own_row.lang").cast("string").alias("lang"), F.col("own_row.source").cast("string").alias("source"), "m.*")
    _, kept = _verdict("")
    return _with_fences(own, limits, "lang", "source").where(kept).select("own_row.*")
