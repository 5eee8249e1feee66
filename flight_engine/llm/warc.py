"""WARC archives as chunked record tables.

``write_archives`` turns pages into WARC/1.1 records in gzip archives. A payload
over CHUNK_BYTES is written as a segmented record: the first segment and
continuation records, each with its number, the length and the SHA-256 of the
payload so far, so neither side ever holds or copies a whole record.
``read_chunks`` streams archives back as rows (record, chunk number, bytes):
Spark unpacks each archive line by line and one task puts its lines together to
records, so neither an archive nor a record is ever one value, and archives of
other writers may have any size (a line of them without a line break is one
value). Their unsegmented payloads over CHUNK_BYTES come as several chunks too,
with the running digests made on reading. ``read_records`` digests chunks in
order, one at a time, and checks each running digest. Equal payloads of
MIN_REVISIT bytes or more are stored once: the smallest page_id is the response,
the others are revisits of it. An own archive holds at most RECORDS_PER_ARCHIVE
segments, 270 MB unpacked.

Defined results: null html is an empty payload; a null page_id stays null, and is
never referred to unless all equal payloads have none; rows that repeat the
smallest page_id are all responses; a null url leaves the header out, control
characters in it are percent-encoded; extra columns are ignored; an empty table
gives empty archives and an empty result; records that are no response, revisit,
resource or continuation are passed over; a truncated or damaged archive is an error.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flight_engine.llm.store import stage

CHUNK_BYTES = 64 << 10
MIN_REVISIT = 100
RECORDS_PER_ARCHIVE = 4096
#: Revisit targets sent to every task up to so many rows; above, the join shuffles.
MAX_BROADCAST_TARGETS = 100_000
DATE = "2000-01-01T00:00:00Z"
_BREAK = "\r\n"


def _header(fields: list[tuple[str, object]]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"


def _uri(url: str | None) -> str | None:
    return None if url is None else "".join(c if " " < c < "\x7f" or c >= "\xa0" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def _cuts(payload: memoryview, first_room: int) -> Iterator[tuple[int, int]]:
    """Chunk borders, at beginnings of characters."""
    lo, room = 0, first_room
    while True:
        hi = min(lo + room, len(payload))
        while hi < len(payload) and payload[hi] & 0xC0 == 0x80:
            hi -= 1
        yield lo, hi
        if hi >= len(payload):
            return
        lo, room = hi, CHUNK_BYTES


def page_records(page_id: int | None, url: str | None, html: memoryview, refers_to: int | None, name: str) -> Iterator[str]:
    """The WARC records of a page, each without its last line break."""
    record = f"<urn:uuid:{uuid.UUID(hashlib.md5(name.encode()).hexdigest())}>"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)), ("X-Page-ID", page_id)]
    if refers_to is not None:
        yield _header([("WARC-Type", "revisit"), ("WARC-Record-ID", record), *common,
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("X-Refers-To-Page-ID", refers_to), ("X-Payload-Length", len(html)),
                       ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(html).hexdigest()}"),
                       ("Content-Length", 0)]) + "\r\n"
        return
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n"
    running, number = hashlib.sha256(), 0
    single = len(html) <= CHUNK_BYTES
    for lo, hi in _cuts(html, CHUNK_BYTES):
        number += 1
        running.update(html[lo:hi])
        body = (http if number == 1 else "") + str(html[lo:hi], "utf-8")
        segment = [] if single else [("WARC-Segment-Number", number), ("X-Payload-So-Far", hi)]
        if number > 1:
            segment += [("WARC-Segment-Origin-ID", record)]
            if hi == len(html):
                segment += [("WARC-Segment-Total-Length", len(http) + len(html))]
        rid = record if number == 1 else f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{name}/{number}'.encode()).hexdigest())}>"
        yield _header([("WARC-Type", "response" if number == 1 else "continuation"), ("WARC-Record-ID", rid), *common,
                       ("Content-Type", "application/http;msgtype=response" if number == 1 else None), *segment,
                       ("X-Running-Digest", f"sha256:{running.copy().hexdigest()}"),
                       ("Content-Length", (len(http) if number == 1 else 0) + hi - lo)]) + body + "\r\n"


def revisit_targets(pages: DataFrame) -> DataFrame:
    """(digest, target): the smallest page_id of payloads that several pages have."""
    keys = pages.select("page_id", F.sha2(F.encode(F.coalesce("html", F.lit("")), "utf-8"), 256).alias("digest"),
                        F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
    return (keys.where(F.col("n") >= MIN_REVISIT).groupBy("digest")
            .agg(F.min("page_id").alias("target"), F.count(F.lit(1)).alias("c")).where("c > 1").select("digest", "target"))


def write_archives(pages: DataFrame, path: str) -> None:
    """One record per page, as gzip WARC archives in a folder."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, urls, targets = (batch.column(c).to_pylist() for c in ("page_id", "url", "target"))
            html = batch.column("html")
            out, size = [], 0
            for k in range(batch.num_rows):
                n += 1
                raw = memoryview(html[k].as_buffer() or b"")
                own = targets[k] is None or ids[k] == targets[k]
                for text in page_records(ids[k], urls[k], raw, None if own else targets[k], f"{part}/{n}/{ids[k]}"):
                    out.append(text)
                    size += len(text)
                    if size > 16 * CHUNK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    targets = stage(revisit_targets(pages), "warc-targets")
    n = targets.count()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    if n:
        rows = rows.withColumn("digest", F.when(F.octet_length("html") >= MIN_REVISIT, F.sha2(F.encode("html", "utf-8"), 256)))
        rows = rows.join(F.broadcast(targets) if n <= MAX_BROADCAST_TARGETS else targets, "digest", "left").select("page_id", "url", "html", F.col("target").cast("long").alias("target"))
    else:
        rows = rows.withColumn("target", F.lit(None).cast("long"))
    (rows.mapInArrow(records, "value string").write.mode("overwrite")
     .option("lineSep", _BREAK).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(path))


def read_pieces(lines: Iterator[memoryview]) -> Iterator[tuple[dict[str, str], bytes, bytes, bool]]:
    """(header, HTTP head, piece, last) of the records in an archive's lines.

    A payload comes in pieces of CHUNK_BYTES, the head with the first one; no more than
    a line and a piece are held at a time.
    """
    for line in lines:
        if not bytes(line[:5]) == b"WARC/":
            raise ValueError(f"not a WARC record: {bytes(line[:40])!r}")
        header = {}
        for line in lines:
            if not len(line):
                break
            name, _, value = str(line, "utf-8").partition(":")
            header[name] = value.strip()
        else:
            raise ValueError("truncated WARC header")
        size = int(header["Content-Length"])
        in_head = header.get("Content-Type", "").startswith("application/http") and header.get("WARC-Segment-Number", "1") == "1"
        head, held, done, first = bytearray(), bytearray(), 0, True
        while True:
            if (line := next(lines, None)) is None:
                raise ValueError("truncated WARC block")
            if not first:
                done += 2
                (head if in_head else held).extend(b"\r\n")
            done += len(line)
            if done > size:
                raise ValueError("WARC block longer than its Content-Length")
            if in_head:
                head.extend(line)
                if not len(line) and not first and done + 2 <= size:
                    # the blank line's own break still belongs to the head
                    head.extend(b"\r\n")
                    done, in_head, first = done + 2, False, True
                    continue
            else:
                for lo in range(0, max(len(line), 1), CHUNK_BYTES):
                    held.extend(line[lo:lo + CHUNK_BYTES])
                    while len(held) > CHUNK_BYTES:
                        yield header, bytes(head), bytes(held[:CHUNK_BYTES]), False
                        head = b""
                        del held[:CHUNK_BYTES]
            first = False
            if done == size:
                break
        end = next(lines, None)
        if end is None or len(end):
            raise ValueError("WARC block not closed")
        yield header, bytes(head), bytes(held), True


def parse_archive(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of one small gzip archive, unpacked whole."""
    lines = gzip.decompress(raw).split(_BREAK.encode())
    block = bytearray()
    for header, head, piece, last in read_pieces(iter(map(memoryview, lines[:-1]))):
        block += head + piece
        if last:
            yield header, bytes(block)
            block = bytearray()


def chunk_rows(lines: Iterator[memoryview], whole: bool) -> Iterator[tuple]:
    """The rows of ``read_chunks`` from the lines of an archive."""
    running, number, so_far = None, 0, 0
    for header, _, piece, last in read_pieces(lines):
        kind, record = header["WARC-Type"], header["WARC-Record-ID"]
        page, to = header.get("X-Page-ID"), header.get("X-Refers-To-Page-ID")
        page, to = None if page is None else int(page), None if to is None else int(to)
        digest = header.get("X-Running-Digest", header.get("WARC-Payload-Digest", ""))
        digest = digest[7:].lower() if digest.startswith("sha256:") else None
        if kind == "revisit":
            if last:
                yield record, page, kind, to, 1, False, int(header.get("X-Payload-Length", 0)), digest, 0, b"" if whole else None
        elif "WARC-Segment-Number" in header:
            if not last or "X-Payload-So-Far" not in header:
                raise ValueError(f"segment {record} is over {CHUNK_BYTES} bytes or has no place in its payload")
            yield (header.get("WARC-Segment-Origin-ID", record), page, "response", to, int(header["WARC-Segment-Number"]),
                   "WARC-Segment-Total-Length" not in header, int(header["X-Payload-So-Far"]), digest, len(piece), piece)
        elif kind in ("response", "resource"):
            if running is None:
                running, number, so_far = hashlib.sha256(), 0, 0
            running.update(piece)
            number, so_far = number + 1, so_far + len(piece)
            found = running.copy().hexdigest()
            if last and digest not in (None, found):
                raise ValueError(f"digest mismatch in {record}")
            keep = whole or number > 1 or not last
            yield record, page, "response", to, number, not last, so_far, found, len(piece), piece if keep else None
            if last:
                running = None


_CHUNK = ("record_id string, page_id long, record_type string, refers_to long, chunk_no long, chunks_follow boolean, "
          "payload_so_far long, running_digest string, n_bytes long, payload binary")


def _archive_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[memoryview]]:
    """The lines of each archive of a task, archive by archive."""

    def flat() -> Iterator[tuple[int, memoryview]]:
        for batch in batches:
            values = batch.column("value").cast(pa.binary())
            _, places, data = values.buffers()
            at = np.frombuffer(places, np.int32)[values.offset:values.offset + len(values) + 1].tolist() if len(values) else [0]
            raw = memoryview(data or b"")
            for k, file in enumerate(batch.column("file").to_pylist()):
                yield file, raw[at[k]:at[k + 1]]

    rows = flat()
    ahead = next(rows, None)

    def of_file(file: int) -> Iterator[memoryview]:
        nonlocal ahead
        while ahead is not None and ahead[0] == file:
            line, ahead = ahead[1], next(rows, None)
            yield line

    while ahead is not None:
        yield of_file(ahead[0])


def read_chunks(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """The chunked record table of a folder of archives.

    One row per chunk of a record: the record's id, the chunk's number and bytes, and
    length and digest of the payload up to it. With ``whole`` false the bytes of
    records of a single chunk are digested on the spot and left out.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _CHUNK.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
        kinds = [types[f.split()[1]] for f in _CHUNK.split(", ")]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        rows, size = [], 0
        for lines in _archive_lines(batches):
            for row in chunk_rows(lines, whole):
                rows.append(row)
                size += 64 if row[-1] is None else 64 + len(row[-1])
                if size > 16 * CHUNK_BYTES:
                    yield table(rows)
                    rows, size = [], 0
        if rows:
            yield table(rows)

    # gzip is not split: a task reads an archive's lines from its first to its last
    lines = (spark.read.option("lineSep", _BREAK).option("pathGlobFilter", "*.gz").text(path)
             .select("value", F.xxhash64("_metadata.file_path").alias("file")))
    return lines.mapInArrow(chunks, _CHUNK)


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each segmented record from its chunks in order, a chunk in memory at a time."""
    record, running, done, last = None, None, 0, None
    for batch in batches:
        out = []
        for k, (rid, no, so_far, digest, follow) in enumerate(zip(*[batch.column(c).to_pylist() for c in (
                "record_id", "chunk_no", "payload_so_far", "running_digest", "chunks_follow")])):
            if rid != record:
                record, running, done, last = rid, hashlib.sha256(), 0, 0
            raw = batch.column("payload")[k].as_buffer()
            running.update(raw)
            done += raw.size
            if no != last + 1 or done != so_far or running.copy().hexdigest() != digest:
                raise ValueError(f"chunk {no} of {rid} is missing or damaged")
            last = no
            if not follow:
                out.append((rid, batch.column("page_id")[k].as_py(), done, digest))
        cols = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                         ["record_id", "page_id", "payload_bytes", "payload_digest"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """record_id, page_id, payload_bytes, payload_digest, record_type and refers_to of each record."""
    chunks = stage(read_chunks(spark, path, whole=False), "warc-chunks")
    single = chunks.where("payload is null").select(
        "record_id", "page_id", F.col("payload_so_far").alias("payload_bytes"), F.col("running_digest").alias("payload_digest"),
        "record_type", "refers_to")
    parts = (chunks.where("payload is not null")
             .select("record_id", "page_id", "chunk_no", "payload_so_far", "running_digest", "chunks_follow", "payload")
             .repartition("record_id").sortWithinPartitions("record_id", "chunk_no"))
    joined = parts.mapInArrow(_digest_chunks, "record_id string, page_id long, payload_bytes long, payload_digest string")
    return single.union(joined.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")))
