"""Per-aircraft ordered access (previous rows) in one pass, whatever one key holds.

A plain ``lag`` over ``Window.partitionBy(icao24)`` puts every row of one
aircraft into one task. Here the rows are range-partitioned by (key, time, tie): a key with
a third of all rows, even all within one second, spreads over as many tasks as its rows ask
for, and the partitions hold one sorted sequence. Previous rows are then taken
inside each partition; only a partition's first rows look back over its border, to
the last ``n`` rows of the partitions before (the carry: at most ``n`` rows a
partition, whatever the data). Rows cross the network once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flight_engine.files import delete_at_end
from flight_engine.session import scratch_path


def _last(kept: pa.Table | None, part: pa.Table, n: int) -> pa.Table:
    """The last n rows after ``part``."""
    if kept is not None and part.num_rows < n:
        part = pa.concat_tables([kept, part])
    return part.slice(max(0, part.num_rows - n)).combine_chunks()


def _starts(keys: pa.ChunkedArray) -> np.ndarray:
    """Whether each row begins a run of one key (nulls are one key)."""
    codes = keys.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate(([True], codes[1:] != codes[:-1]))


def _lags(key: str, cols: list[str], n: int, names: list[str]):
    """Rows with the previous rows of their key in the partition, and the partition's borders.

    ``_at`` is the place of the first n rows of the partition's first key (they may look back over
    the border), ``_end`` the place from the end of the last n rows of its last key (the carry).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, kept, before, first_run, held = TaskContext.get().partitionId(), None, 0, True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch]).select(list(dict.fromkeys([key, *cols])))
            both = part if kept is None else pa.concat_tables([kept, part])
            m, total = both.num_rows - batch.num_rows, both.num_rows
            starts = _starts(both.column(key))
            run_start = np.maximum.accumulate(np.where(starts, np.arange(total), 0))[m:]
            arrays = list(batch.columns)
            for i in range(1, n + 1):
                at = np.arange(m, total) - i
                at = pa.array(at, pa.int64(), mask=at < run_start)
                arrays += [both.column(c).combine_chunks().take(at) for c in cols]
            place = np.full(batch.num_rows, n)
            if first_run:
                # a row of another key than the row before ends the partition's first run
                other = np.flatnonzero(starts[max(m, 1):])
                lead = int(other[0]) + max(m, 1) - m if len(other) else batch.num_rows
                place[:lead] = np.minimum(before + np.arange(lead), n)
                first_run = not len(other)
            arrays += [pa.array(place, pa.int32(), mask=place >= n), pa.array(np.full(batch.num_rows, pid), pa.int32())]
            before, kept = before + batch.num_rows, _last(kept, part, n)
            made = pa.Table.from_arrays(arrays, names[:-1])
            made = made if held is None else pa.concat_tables([held, made])
            cut = max(0, made.num_rows - n)
            for ready in made.slice(0, cut).append_column("_end", pa.nulls(cut, pa.int32())).to_batches():
                yield ready
            held = made.slice(cut)
        if held is not None:
            rows = held.num_rows
            of_last = np.arange(rows) >= np.flatnonzero(_starts(held.column(key)))[-1]
            end = pa.array(rows - np.arange(rows), pa.int32(), mask=~of_last)
            yield from held.append_column("_end", end).to_batches()

    return run


def _ranged(df: DataFrame, key: str, ts: str, cols: list[str], n: int, tiebreak: tuple[str, ...], parts: int) -> DataFrame:
    """One scan, one exchange: rows in key and time order with what their partition knows of the rows before."""
    # the last one tells even equal rows apart, so that a replayed row spreads too
    ties = [F.xxhash64(*df.columns).alias("_tie"), F.monotonically_increasing_id().alias("_row")]
    order = [key, ts, *tiebreak, "_tie", "_row"]
    rows = df.select("*", *ties).repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([*df.schema.fields, *[T.StructField(f"_{i}_{c}", types[c]) for i in range(1, n + 1) for c in cols],
                           *[T.StructField(c, T.IntegerType()) for c in ("_at", "_pid", "_end")]])
    return rows.mapInArrow(_lags(key, cols, n, schema.names), schema)


def with_previous(df: DataFrame, key: str, ts: str, cols: list[str], n: int = 1,
                  tiebreak: tuple[str, ...] = (), partitions: int | None = None,
                  prefix: str = "prev") -> DataFrame:
    """Add ``{prefix}{i}_{c}`` = value of ``c`` in the i-th previous row of the same key.

    Rows are ordered by ``ts`` then ``tiebreak`` (ascending).  Equivalent to
    ``lag(c, i) over (partition by key order by ts, tiebreak)``; rows that tie in all of
    them stand in the order of a hash of the row. ``partitions`` defaults to the session's
    shuffle partitions. All columns of ``df`` go through the sort, so select the needed ones before.

    The sorted rows are written to the shared scratch folder (deleted when the application
    ends): the borders must come from the very partitions that the rows stand in, also when a
    lost executor's tasks run again.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged, path = _ranged(df, key, ts, cols, n, tiebreak, parts), scratch_path(spark, "sequence")
    ranged.write.parquet(path)
    delete_at_end(spark, path)
    rows = spark.read.schema(ranged.schema).parquet(path)

    # a partition's first key asks, its last rows answer; of one key, the last n answers before hold the n rows
    ask = rows.where("_at = 0").select(F.col(key).alias("k"), F.col("_pid").alias("pid"), F.lit(0).alias("kind"))
    tail = F.sort_array(F.collect_list(F.struct((-F.col("_end")).alias("o"), F.struct(*dict.fromkeys(cols)).alias("r"))))
    answer = (rows.where("_end is not null").groupBy(F.col(key).alias("k"), F.col("_pid").alias("pid"))
              .agg(F.transform(tail, lambda x: x["r"]).alias("tail")).withColumn("kind", F.lit(1)))
    earlier = Window.partitionBy("k").orderBy("pid", "kind").rowsBetween(-2 * n, -1)
    carry = (answer.unionByName(ask, allowMissingColumns=True)
             .select("pid", "kind", F.flatten(F.collect_list("tail").over(earlier)).alias("_carry"))
             .where((F.col("kind") == 0) & (F.size("_carry") > 0)).select("pid", "_carry"))
    # one row a partition of at most 2 n * n rows: its size is fixed by ``parts``
    rows = rows.join(F.broadcast(carry), F.when(F.col("_at").isNotNull(), F.col("_pid")) == F.col("pid"), "left")
    back = [F.try_element_at("_carry", F.col("_at") - i) for i in range(1, n + 1)]
    return rows.select(*df.columns, *[
        F.when(F.col("_at") < i, back[i - 1][c]).otherwise(F.col(f"_{i}_{c}")).alias(f"{prefix}{i}_{c}")
        for i in range(1, n + 1) for c in cols])
