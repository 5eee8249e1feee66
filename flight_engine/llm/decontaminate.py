"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by shingle count into powers of two. Against a
partition with at most u shingles an item, every document is read as overlapping
windows of 2u shingles, u apart, so that containment t of an item becomes a
Jaccard similarity of at least t / 5 in its windows however long the document
is. An item is a candidate where one of its PERMUTATIONS min-hashes equals the
window's; over the windows the chance to miss an item held to 0.8 is below 1e-4
if its shingles lie scattered and about 1e-9 if they stand together. Candidates are
verified by the exact share of the item's shingles in the whole document.

A window can only collide on a min-hash if it holds the item's shingle of that
least hash, so windows without any such shingle are passed over unhashed.

Defined results: null or empty texts hold nothing and items without words match
nothing; an item of 1 to 4 words is one shingle, its whole sequence, which only
a document of the same words holds; repeated documents or items give rows each;
extra columns are ignored or carried; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flight_engine.llm import text as tx

K, NUM, DEN = 5, 80, 100
PERMUTATIONS = 64
#: Items are sent to tasks in blocks of at most so many shingles (8 bytes each).
BLOCK_SHINGLES = 1 << 20
_SEEDS = tx.mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FILTER_BITS = 16


def _min_hashes(sh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each permutation the position of the least hash, and that hash."""
    h = tx.mix(sh[:, None] ^ _SEEDS[None, :])
    at = h.argmin(axis=0)
    return at, h[at, np.arange(PERMUTATIONS)]


class ItemBlock:
    """Size-partitioned MinHash index of a bounded block of items."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        parts: dict[int, list[int]] = {}
        for i, (_, s) in enumerate(items):
            parts.setdefault(len(s).bit_length(), []).append(i)
        self.parts = {}
        triggers = []
        for c, members in sorted(parts.items()):
            heads, mins = zip(*[_min_hashes(items[i][1]) for i in members])
            trigger = np.unique(np.concatenate([items[i][1][at] for i, at in zip(members, heads)]))
            # min-hash of permutation p -> items, as sorted (hash, item) per permutation
            values = np.array(mins)
            order = np.argsort(values, axis=0)
            self.parts[c] = (np.array(members), trigger, np.take_along_axis(values, order, 0), order)
            triggers.append(trigger)
        self.triggers = np.unique(np.concatenate(triggers)) if triggers else np.empty(0, np.uint64)
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[(self.triggers >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, sh: np.ndarray) -> np.ndarray:
        """Positions of shingles that are some item's least."""
        at = np.flatnonzero(self.filter[(sh >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        return at[np.isin(sh[at], self.triggers)]

    def candidates(self, sh: np.ndarray, hits: np.ndarray) -> set[int]:
        """Items that share a min-hash with a window of the document's shingles."""
        found: set[int] = set()
        for c, (members, trigger, values, order) in self.parts.items():
            u = (1 << c) - 1
            own = hits[np.isin(sh[hits], trigger)]
            windows = np.unique(np.concatenate([own // u, np.maximum(own // u - 1, 0)]))
            for w in windows:
                part = np.unique(sh[w * u:w * u + 2 * u])
                _, mins = _min_hashes(part)
                for p in range(PERMUTATIONS):
                    a = np.searchsorted(values[:, p], mins[p], side="left")
                    b = np.searchsorted(values[:, p], mins[p], side="right")
                    found.update(members[order[a:b, p]].tolist())
        return found

    def matches(self, sh: np.ndarray, hits: np.ndarray, num: int, den: int) -> list[tuple[int, int, int]]:
        """(item, its shingles, shared) of the items verified in a document."""
        have = np.unique(sh)
        out = []
        for i in sorted(self.candidates(sh, hits)):
            key, s = self.items[i]
            shared = int(np.isin(s, have, assume_unique=True).sum())
            if den * shared >= num * len(s):
                out.append((key, len(s), shared))
        return out


def item_shingles(items: DataFrame, k: int = K) -> DataFrame:
    """item_id and the distinct shingle hashes of each item that has words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in tx.text_blocks(batches):
            h, _, _, edges = tx.word_hashes(data, offsets)
            sh, at = tx.shingles(h, edges, k)
            sets = [np.unique(sh[a:b]).view(np.int64) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(sets, pa.list_(pa.int64()))],
                                             ["item_id", "shingles"])

    return (items.select(F.col("item_id").cast("long").alias("item_id"), "text")
            .mapInArrow(cut, "item_id long, shingles array<long>").where("size(shingles) > 0"))


def item_blocks(items: DataFrame, k: int = K, size: int = BLOCK_SHINGLES) -> Iterator[ItemBlock]:
    """The items as indexes of bounded size, read from Spark one partition at a time."""
    block, n = [], 0
    for r in item_shingles(items, k).toLocalIterator():
        s = np.array(r.shingles, dtype=np.int64).view(np.uint64)
        if block and n + len(s) > size:
            yield ItemBlock(block)
            block, n = [], 0
        block.append((r.item_id, s))
        n += len(s)
    if block:
        yield ItemBlock(block)


def _search(block: ItemBlock, data: np.ndarray, offsets: np.ndarray, k: int, num: int, den: int) -> Iterator[tuple[int, list]]:
    """(row, matches) of the rows with verified items."""
    h, _, _, edges = tx.word_hashes(data, offsets)
    sh, cut = tx.shingles(h, edges, k)
    hits = block.hits(sh)
    rows = np.searchsorted(cut, hits, side="right") - 1
    for i in np.unique(rows):
        a, b = cut[i:i + 2]
        found = block.matches(sh[a:b], hits[rows == i] - a, num, den)
        if found:
            yield int(i), found


def contained_items(docs: DataFrame, items: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared and containment of each test item found in a document.

    One pass over the documents for each block of items (one for usual benchmarks).
    """
    out = None
    for block in item_blocks(items, k):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch, data, offsets in tx.text_blocks(batches):
                rows, keys, sizes, shared = [], [], [], []
                for i, found in _search(sent.value, data, offsets, k, num, den):
                    for key, n, both in found:
                        rows.append(i), keys.append(key), sizes.append(n), shared.append(both)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(keys, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(shared, pa.int64())],
                    ["doc_id", "item_id", "n_item_shingles", "n_shared"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            search, "doc_id long, item_id long, n_item_shingles long, n_shared long")
        out = part if out is None else out.union(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item_shingles long, n_shared long")
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))


def _holds(sent, k: int, num: int, den: int):
    """An expression of a text: whether it holds an item of the block."""

    @F.arrow_udf(T.BooleanType())
    def holds(texts: pa.Array) -> pa.Array:
        flags = np.zeros(len(texts), dtype=bool)
        done = 0
        for batch, data, offsets in tx.text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
            for i, _ in _search(sent.value, data, offsets, k, num, den):
                flags[done + i] = True
            done += batch.num_rows
        return pa.array(flags)

    return holds


def clean_documents(docs: DataFrame, items: DataFrame, k: int = K, num: int = NUM, den: int = DEN) -> DataFrame:
    """The documents that hold no test item, with all their columns; nothing is shuffled."""
    for block in item_blocks(items, k):
        docs = docs.where(~_holds(docs.sparkSession.sparkContext.broadcast(block), k, num, den)(F.col("text")))
    return docs
