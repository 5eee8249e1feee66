"""Repeated-substring removal with longest-previous-factor arrays.

A byte string of LENGTH bytes that starts at two places is a repeat. Text is far
too long for one suffix array, so equal strings are brought together first:

1. The string at x is assigned to an anchor: the place of the least GRAM-byte hash
   among its first WINDOW places. Equal strings have equal anchors, so repeats
   only occur among the contexts (the strings of consecutive x with one anchor,
   as one byte range) whose anchor hash occurs twice or more.
2. Contexts that are equal as a whole are repeats as a whole; one stays for the rest.
3. In each bucket of different contexts with one anchor hash, a suffix array of
   their string starts, to depth LENGTH, is built. Walking it, the previous and
   next smaller text position in suffix order give each start's longest previous
   factor and the link to its earlier copy; starts with a factor of LENGTH bytes
   are later copies, starts that such a link ends in are earlier ones.
4. A bucket over MAX_BUCKET contexts is cut finer: by the bytes common to
   SUB_STARTS neighbouring starts, equal cuts collapsed, and what is left by the
   hash of the string itself, whose groups are counted with map-side sums.

``copies="later"`` removes every copy but the first (in order of doc_id and
position); ``copies="all"`` removes every byte that a repeated string covers.

Defined results: null and empty texts have no bytes; texts under LENGTH bytes
lose nothing; repeated rows are copies of each other; rows without doc_id come
first in the order; extra columns are ignored; an empty table gives an empty
result. Removed ranges may cut a character, so what is kept is returned as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flight_engine.llm import text as tx
from flight_engine.llm.store import release, stage

LENGTH, GRAM = 400, 100
WINDOW = LENGTH - GRAM
MAX_BUCKET = 128
SUB_STARTS = 32
#: Size of the filter of hashed row keys by which texts are passed over early.
KEY_SLOTS = 1 << 20

_SEGMENT = 1 << 19
_POS_BITS = 20
_U64 = np.uint64
_NO_ID = -(1 << 63)


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U64(base), dtype=_U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
_TABLE: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLE or len(_TABLE["up"]) < n:
        _TABLE["up"] = _power_table(_BASE, n)
        _TABLE["down"] = _power_table(pow(_BASE, -1, 1 << 64), n)
    return _TABLE["up"], _TABLE["down"]


def _range_hashes(data: np.ndarray):
    """A function of starts and ends that hashes data[start:end]."""
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U64)
    np.cumsum((data.astype(_U64) + _U64(1)) * up[:len(data)], out=sums[1:])
    return lambda s, e: tx.mix((sums[e] - sums[s]) * down[s])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours."""
    n = len(x)
    if n < w:
        return np.empty(0, x.dtype)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:n] = x
    grid = padded.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def anchors(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, ...]:
    """(lo, hi, anchor, gram hash, context hash) of the string starts of a segment.

    ``limits``: sorted ends of the rows in it; a string that crosses one is left out.
    """
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, _U64),) * 2
    if len(data) < LENGTH:
        return empty
    ranged = _range_hashes(data)
    places = np.arange(len(data) - GRAM + 1)
    gram = ranged(places, places + GRAM)
    low = _U64((1 << _POS_BITS) - 1)
    least = _sliding_min((gram & ~low) | places.astype(_U64), WINDOW)[:len(data) - LENGTH + 1]
    anchor = (least & low).astype(np.int64)
    x = np.arange(len(anchor))
    end_of_row = limits[np.searchsorted(limits, x, side="right")]
    x = x[x + LENGTH <= end_of_row]
    if not len(x):
        return empty
    anchor = anchor[x]
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (x[1:] != x[:-1] + 1))))
    lo, hi = x[first], x[np.concatenate((first[1:] - 1, [len(x) - 1]))]
    at = anchor[first]
    context = ranged(lo, hi + LENGTH) ^ tx.mix((at - lo).astype(_U64) + _U64(7))
    return lo, hi, at, gram[at], context


def _row_anchors(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per segment: row, lo, hi (places in the row), anchor - lo, gram hash and context hash."""
    for start in range(0, max(len(data) - LENGTH + 1, 0), _SEGMENT):
        part = data[start:start + _SEGMENT + LENGTH - 1]
        limits = offsets[1:] - start
        lo, hi, at, gram, context = anchors(part, limits[limits > 0])
        row = tx.rows_of(offsets, lo + start)
        yield row, lo + start - offsets[row], hi + start - offsets[row], at - lo, gram, context


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, h, text): equal rows have equal keys, and equal results."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
                       F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in tx.text_blocks(batches):
        for row, lo, hi, at, gram, context in _row_anchors(data, offsets):
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), batch.column("id").take(own),
                 batch.column("h").take(own), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(at, pa.int32())],
                ["gram", "ctx", "id", "h", "lo", "hi", "at"])


def _slot(cols: str = "id, h") -> F.Column:
    return F.expr(f"pmod(xxhash64({cols}), {KEY_SLOTS})").alias("slot")


def _context_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of one representative of each wanted context, cut from its text."""
    ints = ["gram", "ctx", "members", "lo", "at"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = memoryview(batch.column("text")[k].as_buffer())
                every = batch.column("parts")[k].as_py()
                # contexts overlap, so they are longer than their text: a few hundred at a time
                for parts in (every[i:i + 512] for i in range(0, len(every), 512)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p[c] for p in parts], pa.int64()) for c in ints]
                        + [pa.array([batch.column(c)[k].as_py()] * len(parts), pa.int64()) for c in ("id", "h")]
                        + [pa.array([bytes(raw[p["lo"]:p["hi"] + LENGTH]) for p in parts], pa.binary())],
                        [*ints, "id", "h", "bytes"])

    by_row = (wanted.groupBy("id", "h")
              .agg(F.collect_list(F.struct("gram", "ctx", "members", "lo", "hi", "at")).alias("parts")))
    near = texts.join(F.broadcast(wanted.select(_slot()).distinct()), _slot_is(texts), "left_semi")
    return (near.dropDuplicates(["id", "h"]).join(by_row, ["id", "h"]).select("id", "h", "text", "parts")
            .mapInArrow(cut, "gram long, ctx long, members long, lo long, at long, id long, h long, bytes binary"))


def _slot_is(texts: DataFrame) -> F.Column:
    return F.expr(f"pmod(xxhash64(id, h), {KEY_SLOTS})") == F.col("slot")


def longest_previous(order: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position its earlier copy and whether a later one exists.

    ``order``: positions in suffix order (equal suffixes by position), ``same``:
    whether each equals its predecessor to full depth. Within a run of equal
    suffixes the previous smaller position is the predecessor and the next smaller
    one is absent, so the predecessor is the longest previous factor's place.
    """
    previous = np.full(len(order), -1, dtype=np.int64)
    linked = np.flatnonzero(same)
    previous[order[linked]] = order[linked - 1]
    followed = np.zeros(len(order), dtype=bool)
    followed[order[linked - 1]] = True
    return previous, followed


def bucket_repeats(contexts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per context (given in text order): flags of its starts with an earlier, and with a later copy."""
    data = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    sizes = np.array([len(c) for c in contexts])
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    counts = sizes - LENGTH + 1
    starts = np.concatenate([b + np.arange(c) for b, c in zip(base, counts)])
    rows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[starts]
    order = np.argsort(np.ascontiguousarray(rows).view(f"V{LENGTH}").ravel(), kind="stable")
    ranked = rows[order]
    same = np.concatenate(([False], (ranked[1:] == ranked[:-1]).all(axis=1)))
    previous, followed = longest_previous(order, same)
    cuts = np.cumsum(counts)[:-1]
    return list(zip(np.split(previous >= 0, cuts), np.split(followed, cuts)))


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


_SPAN = "gram long, ctx long, spans array<struct<s: long, e: long, later: boolean>>"


def _span_batch(keys: list[tuple[int, int]], spans: list[list[dict]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
         pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("later", pa.bool_())])))],
        ["gram", "ctx", "spans"])


def _bucket_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated starts of each context, from rows sorted by gram; a bucket is held at a time."""

    def close(bucket: list[tuple]) -> Iterator[pa.RecordBatch]:
        bucket.sort()
        if len(bucket) > 1:
            keys, spans = [], []
            for b, (earlier, later) in zip(bucket, bucket_repeats([b[5] for b in bucket])):
                keys.append((b[3], b[4]))
                spans.append([{"s": s, "e": e, "later": True} for s, e in _runs(earlier)]
                             + [{"s": s, "e": e, "later": False} for s, e in _runs(later & ~earlier)])
            yield _span_batch(keys, spans)

    bucket, gram = [], None
    for batch in batches:
        for r in zip(*[batch.column(c).to_pylist() for c in ("id", "h", "lo", "gram", "ctx", "bytes")]):
            if r[3] != gram:
                yield from close(bucket)
                bucket, gram = [], r[3]
            bucket.append(r)
    yield from close(bucket)


def _sub_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts cut into SUB_STARTS neighbouring starts, counted back from the anchor.

    core: hash of the bytes that all strings of such a cut hold, which equal strings
    share; cut: hash of the cut as a whole. s, e: its first and last start.
    """
    for batch in batches:
        rows = []
        for gram, ctx, at, raw in zip(*[batch.column(c).to_pylist() for c in ("gram", "ctx", "at", "bytes")]):
            last = len(raw) - LENGTH
            for k in range((at - last) // SUB_STARTS, at // SUB_STARTS + 1):
                s, e = max(0, at - k * SUB_STARTS - SUB_STARTS + 1), min(last, at - k * SUB_STARTS)
                core = raw[at - k * SUB_STARTS:at - k * SUB_STARTS - SUB_STARTS + 1 + LENGTH]
                rows.append((gram, ctx, s, e, xxhash.xxh3_64_intdigest(core, seed=k),
                             xxhash.xxh3_64_intdigest(raw[s:e + LENGTH], seed=at - s)))
        cols = list(zip(*rows)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in cols[:4]],
             *[pa.array(np.array(c, dtype=_U64).view(np.int64)) for c in cols[4:]]],
            ["gram", "ctx", "s", "e", "core", "cut"])


def _start_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The string at each start of a cut, as a 128-bit hash."""
    for batch in batches:
        rows = []
        for gram, ctx, s, e, raw in zip(*[batch.column(c).to_pylist() for c in ("gram", "ctx", "s", "e", "bytes")]):
            for x in range(s, e + 1):
                d = xxhash.xxh3_128_intdigest(raw[x:x + LENGTH])
                rows.append((gram, ctx, x, d >> 64, d & ((1 << 64) - 1)))
        cols = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in cols[:3]],
             *[pa.array(np.array(c, dtype=_U64).view(np.int64)) for c in cols[3:]]], ["gram", "ctx", "x", "w1", "w2"])


def _large_bucket_spans(contexts: DataFrame) -> DataFrame:
    """The exact way for buckets over the bound: finer cuts, then the strings' hashes.

    Same columns as the spans of small buckets. All counts have map-side sums.
    """
    place = contexts.select("gram", "ctx", "id", "h", "lo")
    cuts = stage(contexts.select("gram", "ctx", "at", "bytes").mapInArrow(
        _sub_cuts, "gram long, ctx long, s long, e long, core long, cut long"), "lpf-cuts")
    cuts = cuts.join(place, ["gram", "ctx"])
    here = F.struct("id", "h", (F.col("lo") + F.col("s")).alias("pos"), "gram", "ctx", "s", "e")
    one = stage(cuts.groupBy("core", "cut").agg(F.count(F.lit(1)).alias("c"), F.min(here).alias("r")), "lpf-cut-groups")
    whole = (cuts.join(one.where("c > 1").select("core", "cut", "r"), ["core", "cut"])
             .select("gram", "ctx", "s", "e", (here != F.col("r")).alias("later")))
    several = one.groupBy("core").agg(F.count(F.lit(1)).alias("cuts")).where("cuts > 1").select("core")
    rest = one.join(several, "core").select("r.gram", "r.ctx", "r.s", "r.e")
    starts = stage(contexts.select("gram", "ctx", "bytes").join(rest, ["gram", "ctx"])
                   .select("gram", "ctx", "s", "e", "bytes")
                   .mapInArrow(_start_hashes, "gram long, ctx long, x long, w1 long, w2 long"), "lpf-starts")
    starts = starts.join(place, ["gram", "ctx"])
    spot = F.struct("id", "h", (F.col("lo") + F.col("x")).alias("pos"))
    first = starts.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c"), F.min(spot).alias("r")).where("c > 1")
    single = (starts.join(first, ["w1", "w2"])
              .select("gram", "ctx", F.col("x").alias("s"), F.col("x").alias("e"), (spot != F.col("r")).alias("later")))
    return whole.union(single)


def repeated_spans(docs: DataFrame, copies: str = "later") -> DataFrame:
    """(id, h, s, e): byte ranges that repeated strings cover, by row key; ranges may overlap."""
    spark = docs.sparkSession
    texts = _keyed(docs)
    found = stage(texts.mapInArrow(_anchor_rows, "gram long, ctx long, id long, h long, lo long, hi long, at int"), "lpf-anchors")
    twice = found.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram")
    # written first: between two plain exchanges Spark can split a hot gram's rows
    found = stage(found.join(stage(twice, "lpf-grams"), "gram"), "lpf-repeated")
    release(spark)

    ctx = found.groupBy("gram", "ctx").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("id", "h", "lo", "hi", "at")).alias("r"))
    ctx = stage(ctx, "lpf-contexts")
    several = stage(ctx.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "lpf-several")
    wanted = stage(ctx.join(several, "gram").select("gram", "ctx", "members", "r.*"), "lpf-wanted")
    contexts = stage(_context_bytes(texts, wanted), "lpf-bytes")
    release(spark)

    small = (contexts.where(F.col("members") <= MAX_BUCKET).repartition("gram").sortWithinPartitions("gram")
             .select("id", "h", "lo", "gram", "ctx", "bytes").mapInArrow(_bucket_spans, _SPAN))
    small = small.select("gram", "ctx", F.explode("spans").alias("p")).select("gram", "ctx", "p.s", "p.e", "p.later")
    large = contexts.where(F.col("members") > MAX_BUCKET)
    spans = stage(small.union(_large_bucket_spans(large)) if large.take(1) else small, "lpf-spans")

    member = found.join(spans, ["gram", "ctx"]).select("id", "h", (F.col("lo") + F.col("s")).alias("s"),
                                                       (F.col("lo") + F.col("e") + LENGTH).alias("e"), "later")
    copied = found.join(ctx.where("c > 1").select("gram", "ctx", F.col("r.id").alias("r_id"), F.col("r.h").alias("r_h"),
                                                  F.col("r.lo").alias("r_lo")), ["gram", "ctx"])
    copied = copied.select("id", "h", F.col("lo").alias("s"), (F.col("hi") + LENGTH).alias("e"),
                           F.expr("not (id = r_id and h = r_h and lo = r_lo)").alias("later"))
    covered = member.union(copied)
    return (covered.where("later") if copies == "later" else covered).select("id", "h", "s", "e")


def remove_repeats(docs: DataFrame, copies: str = "later") -> DataFrame:
    """doc_id, n_bytes, kept (bytes) and removed (maximal byte ranges) of each document."""
    spark = docs.sparkSession
    spans = stage(repeated_spans(docs, copies), "lpf-removed")
    release(spark)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, sizes = [], [], []
            for k in range(batch.num_rows):
                raw = memoryview(batch.column("text")[k].as_buffer() or b"")
                merged: list[list[int]] = []
                for p in sorted((q["s"], min(q["e"], len(raw))) for q in batch.column("parts")[k].as_py()):
                    if merged and p[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], p[1])
                    else:
                        merged.append(list(p))
                cuts = [0, *[x for m in merged for x in m], len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                removed.append([{"start": a, "end": b} for a, b in merged])
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_bytes", "kept", "removed"])

    schema = "doc_id long, n_bytes long, kept binary, removed array<struct<start: long, end: long>>"
    texts = _keyed(docs).select("*", _slot()).withColumn("doc_id", F.when(F.col("id") > _NO_ID, F.col("id")))
    slots = F.broadcast(spans.select(_slot()).distinct())
    by_row = spans.groupBy("id", "h").agg(F.collect_set(F.struct("s", "e")).alias("parts"))
    changed = (texts.join(slots, "slot", "left_semi").join(by_row, ["id", "h"], "left")
               .select("doc_id", "text", F.coalesce("parts", F.array().cast("array<struct<s: bigint, e: bigint>>")).alias("parts"))
               .mapInArrow(strip, schema))
    same = texts.join(slots, "slot", "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.encode("text", "utf-8").alias("kept"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("removed"))
    return changed.union(same)
