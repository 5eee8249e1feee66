"""Snapshot documents: ``{"time": t, "states": [[17 cells], ...]}``.

``decode_snapshot`` turns landed documents (one per line, or whole files)
into one row per aircraft.  ``snapshot_documents`` builds such documents
from typed states so the decoder can be exercised on data of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flight_engine.schema import RAW_COLUMNS, RAW_CELL_TYPES

SNAPSHOT_SCHEMA = "time BIGINT, states ARRAY<STRING>"
N_CELLS = len(RAW_COLUMNS)


def _parse(docs: DataFrame, value_col: str) -> DataFrame:
    """One parse per document: its time and the JSON text of each state.

    A null time is kept (the key is there), an absent one is not; only documents
    without a time value are searched for the key.
    """
    v = F.col(value_col).cast("string")
    return (docs.select(v.alias("v"), F.from_json(v, SNAPSHOT_SCHEMA).alias("d"))
            .select("d", (F.col("d.time").isNotNull() | F.col("v").rlike(r'"time"\s*:')).alias("has_time")))


def explode_states(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """(time, state cells) per element; documents without a ``time`` key yield nothing.

    Each element is parsed on its own, so one that is no array (a number, text, an
    object, null) is a state without cells and leaves its neighbours alone.
    """
    cells = F.when(F.ltrim("s").startswith("["), F.from_json("s", "ARRAY<STRING>"))
    return (_parse(docs, value_col).where(F.col("has_time"))
            .select(F.col("d.time").alias("timestamp"), F.explode("d.states").alias("s"))
            .select("timestamp", cells.alias("st")))


def state_is_complete():
    return F.coalesce(F.size("st") >= N_CELLS, F.lit(False))


def decode_snapshot(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """Documents -> 17 typed cells + ``timestamp`` (= document time).

    Missing/null/empty ``states`` give no rows; a null state or one with
    fewer than 17 cells is skipped; extra cells are ignored.  Cells are cast
    with ``try_cast`` so a wrong-typed cell becomes null, never an error.
    """
    st = explode_states(docs, value_col).where(state_is_complete())
    cells = []
    for i, name in enumerate(RAW_COLUMNS):
        cell = F.get(F.col("st"), i)
        typ = RAW_CELL_TYPES[name]
        if name == "on_ground":
            cells.append(F.lower(cell).alias(name))  # JSON true/false as text
        elif typ == "string":
            cells.append(cell.alias(name))
        else:
            cells.append(cell.try_cast(typ).alias(name))
    return st.select(*cells, "timestamp")


def malformed_counts(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """Accepted vs rejected (short) state vectors."""
    st = explode_states(docs, value_col)
    ok = state_is_complete()
    return st.agg(F.count(F.when(ok, 1)).alias("accepted"),
                  F.count(F.when(~ok, 1)).alias("rejected"))


def ingest_counters(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """Ingest-side counters: polls (snapshot times, empty ones too, and failed fetches), states
    published, fetch errors (documents without content) and malformed state vectors."""
    v = F.col(value_col).cast("string")
    d = docs.select(v.alias("v"), F.from_json(v, SNAPSHOT_SCHEMA).alias("d"))
    states = F.when(F.col("d.time").isNotNull() | F.col("v").rlike(r'"time"\s*:'), F.col("d.states"))
    kinds = F.transform(F.coalesce(states, F.array().cast("array<string>")), lambda s: F.coalesce(
        F.when(F.ltrim(s).startswith("["), F.size(F.from_json(s, "ARRAY<STRING>")) >= N_CELLS), F.lit(False)))
    empty = F.coalesce(F.trim("v"), F.lit("")).isin("", "null", "{}")
    return (d.select("d.time", kinds.alias("ok"), empty.alias("empty"))
            .agg((F.countDistinct("time") + F.count(F.when(F.col("time").isNull(), 1))).alias("polls_total"),
                 F.coalesce(F.sum(F.size(F.filter("ok", lambda x: x))), F.lit(0)).cast("bigint").alias("flights_sent_total"),
                 F.count(F.when(F.col("empty"), 1)).alias("errors_fetch"),
                 F.coalesce(F.sum(F.size(F.filter("ok", lambda x: ~x))), F.lit(0)).cast("bigint").alias("errors_malformed")))


def _cell_json(c, kind: str = "number"):
    """JSON token of one typed value: '"abc"', '12.5', 'true', 'null'.

    Only strings need escaping (to_json); numbers and booleans print as
    their Spark string form, which is valid JSON (e.g. 1.0E-5).
    """
    if kind == "string":
        tok = F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    else:
        tok = c.cast("string")
    return F.coalesce(tok, F.lit("null"))


def snapshot_documents(states: DataFrame, max_states: int = 1000,
                       short_every: int = 41) -> DataFrame:
    """Group typed states into snapshot documents of at most ``max_states``.

    States with ``last_contact % short_every == 0`` are written with only two
    cells (malformed).  Documents never hold more than ``max_states`` states,
    however many aircraft share one snapshot time.
    """
    og = F.when(F.col("on_ground") == "true", F.lit(True)) \
        .when(F.col("on_ground") == "false", F.lit(False))
    string_cols = ("icao24", "callsign", "origin_country")
    cells = [_cell_json(F.col(c), "string" if c in string_cols else "number") for c in (
        "icao24", "callsign", "origin_country", "time_position", "last_contact",
        "longitude", "latitude", "baro_altitude")]
    cells += [_cell_json(og)] + [_cell_json(F.col(c)) for c in (
        "velocity", "true_track", "vertical_rate")]
    cells += [F.lit("null"), _cell_json(F.col("baro_altitude")), F.lit("null"), F.lit("false"),
              F.lit("0")]
    short = (F.col("last_contact") % short_every) == 0
    state = F.when(short, F.concat(F.lit("["), F.concat_ws(",", *cells[:2]), F.lit("]"))) \
        .otherwise(F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")))
    chunk = F.floor(F.monotonically_increasing_id() / F.lit(max_states))
    return (states.select("timestamp", chunk.alias("chunk"), state.alias("state"))
            .groupBy("timestamp", "chunk")
            .agg(F.concat(F.lit('{"time":'), F.col("timestamp").cast("string"),
                          F.lit(',"states":['), F.concat_ws(",", F.collect_list("state")),
                          F.lit("]}")).alias("value"))
            .select("value"))


def read_snapshot_files(spark, path: str) -> DataFrame:
    """Landed snapshot documents, one document per file (whole text, never split)."""
    return spark.read.text(path, wholetext=True)


def stream_snapshot_files(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of ``read_snapshot_files``: new files become micro-batches."""
    r = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
