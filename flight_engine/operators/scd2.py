"""Type-2 dimensions kept from a change feed, and the join of facts with the version of their time.

The stored dimension has two parts, both partitioned by a hash bucket of the key: the log (one
row per key and time of change, the change of the highest sequence number) and the versions made from
it. A batch of changes touches only its buckets; their versions are made anew from the
log, so changes may come in any order, repeat, or arrive again after a lost driver: versions are
opened, closed, split or merged as if the feed had come sorted. The log is what makes this
possible: a change that repeats its predecessor opens no version, but it does once another change
slips in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flight_engine.files import delete, exists
from flight_engine.operators.joins import bounded_broadcast
from flight_engine.operators.sequence import with_previous
from flight_engine.session import scratch_path

BUCKETS = 32


def change_log(changes: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """key, attrs, valid_from, seq: the last word on each key and time."""
    best = F.max(F.struct("seq", *attrs))
    return (changes.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).groupBy(key, "valid_from").agg(best.alias("r"))
            .select(key, "valid_from", "r.seq", *[F.col(f"r.{a}").alias(a) for a in attrs]))


def versions_of(log: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Versions of a change log: valid_from <= t < valid_to (null: open end), numbered from 1.

    Previous changes come from ``with_previous``, so a key that changes all the time spreads
    over tasks; only real versions, those that change an attribute, are windowed by key.
    """
    seen = with_previous(log.select(key, "valid_from", *attrs), key, "valid_from", ["valid_from", *attrs])
    same = F.col("prev1_valid_from").isNotNull()
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"prev1_{a}"))
    w = Window.partitionBy(key).orderBy("valid_from")
    end = F.lead("valid_from").over(w)
    return seen.where(~same).select(key, *attrs, "valid_from", end.alias("valid_to"),
                                    F.row_number().over(w).alias("version"), end.isNull().alias("is_current"))


def apply_changes(spark: SparkSession, path: str, changes: DataFrame, key: str, attrs: list[str], buckets: int = BUCKETS) -> list[int]:
    """Merge a batch of changes (key, attrs, valid_from, seq) into the stored dimension; the buckets it touched.

    Applying a batch again changes nothing. Only the touched buckets are read and replaced.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    batch = change_log(changes, key, attrs).withColumn("bucket", bucket)
    log, versions = f"{path}/log", f"{path}/versions"
    touched = sorted(r[0] for r in batch.select("bucket").distinct().collect())  # at most ``buckets``
    if exists(spark, log) and touched:
        old = spark.read.schema(batch.schema).parquet(log).where(F.col("bucket").isin(touched))
        batch = change_log(batch.unionByName(old), key, attrs).withColumn("bucket", bucket)
    staging = scratch_path(spark, "scd2")  # a folder cannot be read and replaced at once
    batch.write.partitionBy("bucket").parquet(staging)
    merged = spark.read.schema(batch.schema).parquet(staging)
    made = versions_of(merged, key, attrs).withColumn("bucket", bucket)
    for rows, target in ((merged, log), (made, versions)):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)
    delete(spark, staging)
    return touched


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/versions").drop("bucket")


def asof_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, cols: dict[str, str],
              period: int = 86400, max_rows: int = 2_000_000) -> DataFrame:
    """Facts with columns of the version of their key that was valid at ``ts``; nulls where none was.

    ``cols`` maps columns of the versions to new names. Versions are cut at the borders of periods, within the
    facts' span of time, so a fact meets only versions of its key that touch its own period: an
    equi-join on (key, period), broadcast if the cut versions have at most ``max_rows`` rows.
    """
    span = facts.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi")).alias("s")).scalar()
    first = F.floor(F.greatest(F.col("valid_from"), span["lo"]) / period)
    last = F.floor(F.least(F.coalesce(F.col("valid_to") - 1, span["hi"]), span["hi"]) / period)
    cut = (versions.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
                           *[F.col(c).alias(f"_v_{n}") for c, n in cols.items()], first.alias("_first"), last.alias("_last"))
           .where("_first <= _last").withColumn("_period", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last"))
    cut = bounded_broadcast(cut, max_rows)
    t = F.col(ts)
    met = ((F.col(key) == F.col("_key")) & (F.floor(t / period) == F.col("_period")) & (t >= F.col("_from"))
           & (F.col("_to").isNull() | (t < F.col("_to"))))
    return facts.join(cut, met, "left").select(*facts.columns, *[F.col(f"_v_{n}").alias(n) for n in cols.values()])
