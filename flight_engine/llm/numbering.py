"""Gapless numbers in a given order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flight_engine.llm.store import stage

_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], by: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2 ... in each group of ``by``, in ``order``.

    Rows are sorted over range partitions and written; a row's number is its place in its
    partition plus the rows of its group in earlier partitions. Only counts by
    partition and group meet, never the rows of a group. Rows that are equal in the order
    are told apart by a hash of their place in the input, so they spread over partitions too.
    """
    tie = F.xxhash64(F.monotonically_increasing_id())
    keys = [*[F.col(c) for c in by], *order]
    ranked = (df.select("*", tie.alias("_tie")).repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
              .drop("_tie").select("*", F.monotonically_increasing_id().alias("_at")))
    ranked = stage(ranked.select("*", F.shiftright("_at", _ROW_BITS).alias("_part")), "numbered")
    parts = ranked.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *by, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return (ranked.join(parts, ["_part", *by])
            .select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias(name)))
