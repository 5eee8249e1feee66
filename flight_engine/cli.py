"""Command line entry points for the pipeline jobs and registered queries.

  python -m flight_engine.cli ingest --input SNAPSHOT_DIR --sink kafka --servers H:P \
      --out-topic flights_raw --checkpoint CK
  python -m flight_engine.cli transform --source kafka --servers H:P --topic flights_raw \
      --sink kafka --out-topic flights_processed --checkpoint CK
  python -m flight_engine.cli transform --source json --input DIR --sink json --output DIR --checkpoint CK
  python -m flight_engine.cli sink --source json --input DIR --table PATH --checkpoint CK
  python -m flight_engine.cli serve --table PATH --limit 500
  python -m flight_engine.cli query NAME --sf-dir DIR --output PATH

Streaming jobs run continuously unless ``--available-now`` is given.
Checkpoints default to a folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys


def _source(spark, a):
    from flight_engine.streaming import pipeline as pl
    if a.source == "kafka":
        return pl.kafka_source(spark, a.servers, a.topic, a.starting_offsets, a.max_offsets)
    return pl.file_source(spark, a.input, a.source)


def _checkpoint(spark, a, name):
    from flight_engine.session import scratch_path
    return a.checkpoint or scratch_path(spark, name)


def cmd_ingest(spark, a):
    """Landed snapshot documents (one per file) -> one raw message per aircraft."""
    from flight_engine.operators.transform import serialize_unkeyed
    from flight_engine.sources.snapshot import decode_snapshot, stream_snapshot_files
    from flight_engine.streaming import pipeline as pl
    msgs = serialize_unkeyed(decode_snapshot(stream_snapshot_files(spark, a.input, a.max_files)))
    ck = _checkpoint(spark, a, "ingest-ck")
    if a.sink == "kafka":
        q = pl.kafka_sink(msgs, a.servers, a.out_topic, ck)
    else:
        w = (msgs.writeStream.format(a.sink).option("path", a.output)
             .option("checkpointLocation", ck).outputMode("append"))
        q = (w.trigger(availableNow=True) if a.available_now else w).start()
    q.awaitTermination()


def cmd_transform(spark, a):
    from flight_engine.operators.transform import process_raw, serialize_keyed
    from flight_engine.streaming import pipeline as pl
    src = _source(spark, a)
    ck = _checkpoint(spark, a, "transform-ck")
    if a.sink == "kafka":
        q = pl.kafka_sink(serialize_keyed(process_raw(src)), a.servers, a.out_topic, ck)
    else:
        q = pl.stream_transform(src, a.output, ck, available_now=a.available_now, fmt=a.sink)
    q.awaitTermination()


def cmd_sink(spark, a):
    from flight_engine.streaming import pipeline as pl
    q = pl.stream_sink_table(_source(spark, a), a.table, _checkpoint(spark, a, "sink-ck"),
                             available_now=a.available_now)
    q.awaitTermination()


def cmd_serve(spark, a):
    from flight_engine.operators.serve import api_json, recent_flights_from_table
    page = recent_flights_from_table(spark, a.table, a.limit)
    for row in api_json(page).toLocalIterator():  # at most 500 rows by construction
        print(row.json)


def cmd_query(spark, a):
    from flight_engine.plans.catalog import QUERIES
    df = QUERIES[a.name](spark, a.sf_dir)
    if a.output:
        df.write.mode("overwrite").format(a.format).save(a.output)
    else:
        df.show(a.show, truncate=False)


def main(argv=None):
    p = argparse.ArgumentParser(prog="flight_engine")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def stream_args(sp):
        sp.add_argument("--source", choices=["kafka", "json", "text", "parquet"], default="kafka")
        sp.add_argument("--servers")
        sp.add_argument("--topic")
        sp.add_argument("--input")
        sp.add_argument("--starting-offsets", default="latest")
        sp.add_argument("--max-offsets", type=int, default=None)
        sp.add_argument("--checkpoint")
        sp.add_argument("--available-now", action="store_true")

    g = sub.add_parser("ingest")
    g.add_argument("--input", required=True)
    g.add_argument("--max-files", type=int, default=None)
    g.add_argument("--sink", choices=["kafka", "json", "parquet"], default="kafka")
    g.add_argument("--servers")
    g.add_argument("--out-topic", default="flights_raw")
    g.add_argument("--output")
    g.add_argument("--checkpoint")
    g.add_argument("--available-now", action="store_true")
    t = sub.add_parser("transform")
    stream_args(t)
    t.add_argument("--sink", choices=["kafka", "json", "parquet"], default="kafka")
    t.add_argument("--out-topic", default="flights_processed")
    t.add_argument("--output")
    s = sub.add_parser("sink")
    stream_args(s)
    s.add_argument("--table", required=True)
    v = sub.add_parser("serve")
    v.add_argument("--table", required=True)
    v.add_argument("--limit", default="")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--output")
    q.add_argument("--format", default="parquet")
    q.add_argument("--show", type=int, default=20)
    a = p.parse_args(argv)

    from flight_engine.session import get_spark
    spark = get_spark("flight_engine-" + a.cmd, master=a.master)
    {"ingest": cmd_ingest, "transform": cmd_transform, "sink": cmd_sink, "serve": cmd_serve, "query": cmd_query}[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
