"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is its set of distinct k-word shingles, in one global order: rarest
first, by document frequency estimated from hashed counters over the whole
corpus. If two sets have Jaccard similarity t or more, the first
``n - ceil(t n) + l`` shingles of both share at least l. Each document picks its
own l by estimated candidate cost: a longer prefix scans more postings but asks
for l matches before the exact check; a pair needs the smaller l of the two.

Links are found without writing all pairs of a group:
1. documents with equal sets collapse to one class;
2. per prefix shingle one central member (fewest rarer shingles of its own) is
   compared with all members, and linked classes merge;
3. pairs that still lie in different components and share enough prefix
   shingles are checked one by one, so no link between components is missed.

Defined results: null, empty or wordless texts have an empty set and link with
nothing; a null doc_id gets a null component; repeated rows are equal sets;
texts of one repeated doc_id are separate members whose component is the least
doc_id; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flight_engine.llm import text as tx
from flight_engine.llm.components import components
from flight_engine.llm.store import release, stage

#: Hashed document-frequency counters: a fixed-size table, sent to every task (2 MB).
DF_BUCKETS = 1 << 18
#: Longest extension of a prefix, and the cost of a check in postings.
MAX_MATCHES, CHECK_COST = 4, 20
#: 64-bit words of the parity bitmap that bounds how many shingles two sets do not share.
BITMAP_WORDS = 16
#: Size of the filter of hashed ids by which texts are passed over early.
ID_SLOTS = 1 << 20


def doc_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Distinct shingle hashes of each row, sorted."""
    h, _, _, edges = tx.word_hashes(data, offsets)
    sh, cut = tx.shingles(h, edges, k)
    for a, b in zip(cut[:-1], cut[1:]):
        yield np.unique(sh[a:b])


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(6)) % np.uint64(buckets)).astype(np.int64)


def df_counters(docs: DataFrame, k: int, buckets: int = DF_BUCKETS) -> np.ndarray:
    """Hashed document-frequency counters over all documents; sums of per-task counters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, data, offsets in tx.text_blocks(batches):
            sets = np.concatenate([np.empty(0, np.uint64), *doc_shingles(data, offsets, k)])
            total += np.bincount(_bucket(sets, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        for lo in range(0, len(used), 1 << 16):
            part = used[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["bucket", "c"])

    out = np.zeros(buckets, dtype=np.int64)
    rows = (docs.select("text").mapInArrow(count, "bucket int, c long")
            .groupBy("bucket").agg(F.sum("c").alias("c")).toArrow())
    out[rows.column("bucket").to_numpy()] = rows.column("c").to_numpy()
    return out


def _parity(s: np.ndarray) -> np.ndarray:
    """Bit b: whether an odd number of the shingles hash to b."""
    size = 64 * BITMAP_WORDS
    odd = np.bincount((s >> np.uint64(40)).astype(np.int64) % size, minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _identity(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set; zeros for the empty one."""
    return (int(tx.mix(s).sum()), int(tx.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum())) if len(s) else (0, 0)


def _signatures(docs: DataFrame, counters: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n, 128-bit set identity (s1, s2), l and the prefix tokens in order."""
    buckets = len(counters)
    rank = np.frexp(np.maximum(counters, 1).astype(float))[1].astype(np.uint64)
    extra = np.maximum(counters - counters.sum() / buckets, 0.0)
    sent = docs.sparkSession.sparkContext.broadcast((rank, extra))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, extra = sent.value
        for batch, data, offsets in tx.text_blocks(batches):
            n, s1, s2, ell, prefix, bits = [], [], [], [], [], []
            for s in doc_shingles(data, offsets, k):
                m = len(s)
                n.append(m)
                a, b = _identity(s)
                s1.append(a)
                s2.append(b)
                bits.append(_parity(s))
                need = -(-num * m // den)
                token = np.sort((rank[_bucket(s, buckets)] << np.uint64(58)) | (s >> np.uint64(6)))
                head = token[:m - need + min(MAX_MATCHES, need)] if m else token
                cost = np.cumsum(extra[((head & np.uint64((1 << 58) - 1)) % np.uint64(buckets)).astype(np.int64)])
                best = 1
                if m:
                    tries = range(1, min(MAX_MATCHES, need) + 1)
                    best = min(tries, key=lambda x: cost[min(m, m - need + x) - 1] * (1 + CHECK_COST / x))
                ell.append(best)
                prefix.append(head[:m - need + best].view(np.int64) if m else head.view(np.int64))
            flat = np.concatenate(prefix) if prefix else np.empty(0, np.int64)
            cuts = np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()),
                pa.array(np.array(s1, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(s2, dtype=np.uint64).view(np.int64)), pa.array(ell, pa.int32()),
                pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat)),
                pa.array(bits, pa.list_(pa.int64()))], ["doc_id", "n", "s1", "s2", "l", "prefix", "bits"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(sign, "doc_id long, n long, s1 long, s2 long, l int, prefix array<long>, bits array<long>"))


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set: node id, least doc_id and the prefix.

    The node is the least doc_id; where a repeated doc_id is the least of several
    different sets, a hash of set and id.
    """
    sets = (signed.where("n > 0 and doc_id is not null").groupBy("s1", "s2")
            .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("l").alias("l"),
                 F.first("prefix").alias("prefix"), F.first("bits").alias("bits")))
    sets = stage(sets, "ngram-classes")
    clash = sets.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id")
    if clash.take(1):
        return (sets.join(clash.withColumn("clash", F.lit(True)), "id", "left")
                .withColumn("node", F.expr("if(clash, xxhash64(id, s1, s2), id)")).drop("clash"))
    return sets.withColumn("node", F.col("id"))


def _overlap(a: str, b: str, num: int, den: int) -> str:
    """Least shared shingles of two sets with sizes a, b for similarity num / den."""
    return f"(({num} * ({a} + {b}) + {num + den - 1}) div {num + den})"


def _possible(num: int, den: int) -> Column:
    """Size filter, and the places that a pair's first shared shingle can have."""
    need = _overlap("x_n", "y_n", num, den)
    return F.expr(f"""{den} * least(x_n, y_n) >= {num} * greatest(x_n, y_n)
        and x_pos <= x_n - {need} and y_pos <= y_n - {need}""")


def _close(num: int, den: int) -> Column:
    """Whether the parity bitmaps allow the pair's similarity, and both have the prefix shingles it asks for.

    Each bit that differs is a shingle, at least, that only one of the two has.
    """
    return F.expr(f"least(x_open, y_open) >= {_matches(num, den)} and {_near(num, den)}")


def _near(num: int, den: int) -> str:
    differ = " + ".join(f"bit_count(x_b{i} ^ y_b{i})" for i in range(BITMAP_WORDS))
    return f"{differ} <= x_n + y_n - 2 * {_overlap('x_n', 'y_n', num, den)}"


def _prefix(n: str, l: str, num: int, den: int) -> str:
    """Prefix length of a set of n shingles."""
    return f"least({n}, {n} + {l} - ({num} * {n} + {den - 1}) div {den})"


def _matches(num: int, den: int) -> str:
    """Least prefix shingles that a similar pair shares: l, or more where the prefixes are longer than they need be.

    Past the prefix that ends first, a pair shares at most what is left of that document.
    """
    left = ", ".join(f"{s}_n - {_prefix(f'{s}_n', f'{s}_l', num, den)}" for s in "xy")
    return f"greatest(least(x_l, y_l), {_overlap('x_n', 'y_n', num, den)} - greatest({left}))"


def _side(tokens: DataFrame, s: str, *cols: str) -> DataFrame:
    return tokens.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "n", "l", "pos", *cols)])


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(node, set): sorted 64-bit shingle hashes of the classes in ``pairs(a, b)``.

    A filter of at most ID_SLOTS hashed ids goes to every task and spares most of
    the other texts the shuffle; the join by id is what decides.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch, data, offsets in tx.text_blocks(batches):
            keep, sets = [], []
            nodes, s1 = batch.column("node").to_pylist(), batch.column("s1").to_pylist()
            for i, s in enumerate(doc_shingles(data, offsets, k)):
                if nodes[i] not in seen and int(np.uint64(tx.mix(s).sum()).astype(np.int64)) == s1[i]:
                    seen.add(nodes[i])
                    keep.append(i)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(keep, pa.int64())),
                                              pa.array(sets, pa.binary())], ["node", "set"])

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stage(nodes.join(classes.select("id", "node", "s1"), "node"), "ngram-wanted")
    slot = F.expr(f"pmod(xxhash64(id), {ID_SLOTS})").alias("slot")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").select("*", slot)
    texts = texts.join(F.broadcast(wanted.select(slot).distinct()), "slot", "left_semi")
    found = texts.join(wanted, "id").select("node", "s1", "text").mapInArrow(build, "node long, set binary")
    return stage(found, "ngram-sets")


def _check(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, linked): the exact similarity test of candidate pairs."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("x_set"), batch.column("y_set")):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                both = int(np.count_nonzero(q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p))
                out.append(den * both >= num * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.bool_())],
                                             ["a", "b", "linked"])

    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x_set")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("set").alias("y_set")), "b"))
    return joined.select("a", "b", "x_set", "y_set").mapInArrow(check, "a long, b long, linked boolean")


def _memberships(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """The rows' signatures, and each set's group: (s1, s2, component, component_id).

    Groups of different sets can have one least doc_id; their components differ.
    """
    spark = docs.sparkSession
    signed = stage(_signatures(docs, df_counters(docs, k), k, num, den), "ngram-signed")
    classes = _classes(signed)
    release(spark)

    tokens = classes.select("node", "n", "l", F.posexplode("prefix").alias("pos", "token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    tokens = stage(tokens.join(shared, "token"), "ngram-tokens")
    release(spark)

    # the member with the fewest rarer shingles before the token, then the longest
    lead = tokens.groupBy("token").agg(F.max(F.struct((-F.col("pos")).alias("rate"), "n", "node", "l", "pos")).alias("m")).select(
        "token", *[F.col(f"m.{c}").alias(f"x_{c}") for c in ("node", "n", "l", "pos")])
    stars = (_side(tokens, "y").join(lead, "token").where("x_node <> y_node").where(_possible(num, den))
             .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct())
    bitmap = [f"b{i}" for i in range(BITMAP_WORDS)]
    bits = classes.select("node", "n", *[F.get("bits", F.lit(i)).alias(b) for i, b in enumerate(bitmap)])
    for pair, s in (("a", "x"), ("b", "y")):
        stars = stars.join(bits.select(F.col("node").alias(pair), *[F.col(c).alias(f"{s}_{c}") for c in ("n", *bitmap)]), pair)
    stars = stars.where(F.expr(_near(num, den))).select("a", "b")
    stars = stage(stars, "ngram-stars")
    sets = _sets(docs, classes, stars, k)
    release(spark)
    stars = stage(_check(stars, sets, num, den), "ngram-checked")
    joined = stage(components(stars.where("linked").select("a", "b")), "ngram-merged")
    release(spark)

    labelled = (tokens.join(joined, "node", "left")
                .withColumn("comp", F.coalesce("component", "node")).drop("component"))
    split = (labelled.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo <> hi").select("token"))
    open_tokens = labelled.join(split, "token")
    heads = open_tokens.groupBy("node").agg(F.first("l").alias("l"), F.first("n").alias("n"), F.collect_list("token").alias("head"))
    heads = stage(heads.join(bits.drop("n"), "node"), "ngram-heads")
    open_tokens = stage(open_tokens.join(heads.select("node", F.size("head").alias("open"), *bitmap), "node"), "ngram-open")
    rest = (_side(open_tokens, "x", "comp", "open", *bitmap).join(_side(open_tokens, "y", "comp", "open", *bitmap), "token")
            .where("x_node < y_node and x_comp <> y_comp").where(_possible(num, den)).where(_close(num, den))
            .select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct())
    for pair, s in (("a", "x"), ("b", "y")):
        rest = rest.join(heads.select(F.col("node").alias(pair), *[F.col(c).alias(f"{s}_{c}") for c in ("l", "n", "head")]), pair)
    rest = (rest.where(f"size(array_intersect(x_head, y_head)) >= {_matches(num, den)}").select("a", "b"))
    rest = stage(rest.join(stars.select("a", "b"), ["a", "b"], "left_anti"), "ngram-rest")
    found = stage(_check(rest, _sets(docs, classes, rest, k), num, den).where("linked").select("a", "b"), "ngram-found")
    links = joined.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    groups = components(links.union(found)) if found.take(1) else joined

    member = classes.select("s1", "s2", "node", "id").join(groups, "node", "left")
    member = member.withColumn("component", F.coalesce("component", "node"))
    least = member.groupBy("component").agg(F.min("id").alias("component_id"))
    member = stage(member.join(least, "component").select("s1", "s2", "component", "component_id"), "ngram-members")
    release(spark)
    return signed, member


def _grouped(signed: DataFrame, member: DataFrame) -> DataFrame:
    """The rows' signatures with component and component_id, the row's own doc_id where nothing links."""
    return (signed.select("doc_id", "n", F.expr("if(n > 0 and doc_id is not null, s1, null)").alias("s1"), "s2")
            .join(member, ["s1", "s2"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id")))


def similar_components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, linked at num / den or more."""
    return _grouped(*_memberships(docs, k, num, den)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _set_of(k: int):
    """An expression of a text: the identity (s1, s2) of its set."""

    @F.arrow_udf("struct<s1: long, s2: long>")
    def identity(texts: pa.Array) -> pa.Array:
        s1, s2 = [], []
        for _, data, offsets in tx.text_blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
            for s in doc_shingles(data, offsets, k):
                a, b = _identity(s)
                s1.append(a)
                s2.append(b)
        return pa.StructArray.from_arrays([pa.array(np.array(s, dtype=np.uint64).view(np.int64)) for s in (s1, s2)], ["s1", "s2"])

    return identity


def one_per_group(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """A row of each group: one of the group's least id. Rows without an id stay.

    Where one doc_id stands on several texts, each goes or stays with its own
    group; repeated rows of one id and one set are one row.
    """
    signed, member = _memberships(docs, k, num, den)
    # wordless texts have no component; those of one id are one row
    first = (_grouped(signed, member).where("doc_id = component_id").groupBy("component", "doc_id")
             .agg(F.min(F.struct(F.coalesce("s1", F.lit(0)).alias("s1"), F.when(F.col("s1").isNotNull(), F.col("s2")).otherwise(0).alias("s2"))).alias("s"))
             .select(F.col("doc_id").alias("kept_id"), "s"))
    first = stage(first, "ngram-first")
    # rows as one column, so that no column of theirs can clash with the names here
    named = docs.select(F.struct("*").alias("own_row"), F.col("doc_id").cast("long").alias("own_id"))
    no_id, named = named.where("own_id is null").select("own_row.*"), named.where("own_id is not null")
    many = stage(signed.where("doc_id is not null").groupBy(F.col("doc_id").alias("many_id")).agg(F.count(F.lit(1)).alias("c"))
                 .where("c > 1").select("many_id"), "ngram-repeated")
    once = named.join(first.select("kept_id").distinct(), F.col("own_id") == F.col("kept_id"), "left_semi")
    if not many.take(1):
        return once.select("own_row.*").unionByName(no_id)
    once = once.join(many, F.col("own_id") == F.col("many_id"), "left_anti").select("own_row.*")
    rows = named.join(many, F.col("own_id") == F.col("many_id")).select("own_row", "many_id", _set_of(k)(F.col("own_row.text")).alias("own_set"))
    rows = rows.join(first, (F.col("many_id") == F.col("kept_id")) & (F.col("own_set") == F.col("s")), "left_semi")
    rows = rows.dropDuplicates(["many_id", "own_set"]).select("own_row.*")
    return once.unionByName(rows).unionByName(no_id)
