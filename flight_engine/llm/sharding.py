"""Sharding by jump consistent hashing.

A row's shard follows from a 64-bit hash of its key and the number of shards alone: no
ring, table or state, so any task finds any row's shard. The key's hash seeds a linear congruential
generator whose draws are the shard counts at which the key jumps; the last jump at or
below the present count is its shard. One more shard takes 1 / (n + 1) of the keys, and
they move into it only.

Rows of one key always share a shard, so a key with a third of all rows makes that shard
large; the writer cuts a shard into as many files as its bytes ask for.

Defined results: a null key counts as the empty string; repeated rows share a shard and
have slots of their own; a null text has size 1 and checksum 0; extra columns are
carried in the general functions, and ignored in ``shard_slots``; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flight_engine.llm.numbering import numbered
from flight_engine.llm.store import stage

_STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key among ``shards``."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    state = keys.astype(np.uint64)
    shard = np.zeros(len(keys), dtype=np.int64)
    live, jump_to = np.arange(len(keys)), np.zeros(len(keys), dtype=np.int64)
    while len(live):
        shard[live] = jump_to
        state = state * _STEP + np.uint64(1)
        draw = ((state >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump_to = ((shard[live] + 1) * (2147483648.0 / draw)).astype(np.int64)
        on = jump_to < shards
        live, state, jump_to = live[on], state[on], jump_to[on]
    return shard


def key_hash(key: Column) -> Column:
    """The first 64 bits of the key's SHA-256, as a signed long (null: the empty string)."""
    digest = F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key column among ``shards``, from 0."""

    @F.arrow_udf("int")
    def shard(keys: pa.Array) -> pa.Array:
        return pa.array(jump(keys.to_numpy(zero_copy_only=False).view(np.uint64), shards), pa.int32())

    return shard(key_hash(key))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores added as columns of ``df`` ask for."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_shards(df: DataFrame, shards: int, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``df`` with its shard, in a column ``name`` (with underscores added while ``df`` has one so named)."""
    return df.withColumn(free_name(df, name), shard_of(F.col(key), shards))


def moved(df: DataFrame, shards: int, grown: int, key: str = "doc_id") -> DataFrame:
    """Rows that change place when ``shards`` grow to ``grown``: row, from_shard, to_shard."""
    row = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    out = df.select(row, shard_of(F.col(key), shards).alias("from_shard"), shard_of(F.col(key), grown).alias("to_shard"))
    return out.where("from_shard <> to_shard")


def write_shards(df: DataFrame, path: str, shards: int, key: str = "doc_id", name: str = "shard") -> None:
    """Write ``df`` as Parquet with one folder a shard; large shards become several files.

    The rows are rebalanced by shard, which lets Spark split a shard that is too large for a task.
    """
    name = free_name(df, name)
    with_shards(df, shards, key, name).hint("rebalance", name).write.partitionBy(name).parquet(path)


def shard_slots(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, law, shard, slot and grown_shard of every row.

    slot: place in the shard from 0, by key, size and checksum; grown_shard: the shard
    with one shard more. Only these few columns are sorted, never the texts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    thin = stage(docs.select(
        F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard")), "shards")
    order = [F.col(key).asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    return numbered(thin, order, ["shard"], "slot").select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
