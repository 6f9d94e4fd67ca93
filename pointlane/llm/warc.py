"""WARC archives written and read by Spark, with payloads as tables of chunks.

A record's payload is a run of rows (record_id, chunk_no, chunk). A payload of
up to ``chunk_bytes`` is one ``response`` record; a larger one is segmented as
WARC 1.1 lays down: the first chunk in the ``response``, each further one in a
``continuation`` record with WARC-Segment-Number and -Origin-ID. So neither
writing nor reading holds more than a chunk of a payload beside the input row,
whose bytes are sliced where Arrow holds them. A chunk also ends inside any
occurrence of ``WARC/1.`` in a payload, so that this mark, which ``read`` splits
at, only ever begins a record.

Records go through Spark's text writer with the WARC record end as line
separator, gzip-compressed, one file a task, to any store that Spark writes;
each file begins with a ``warcinfo`` record. ``read`` is Spark's text reader
split at the mark. It takes WARC 1.0 and 1.1 and joins what a mark within a
payload of a foreign archive split, as long as it doesn't look like a record.
Files are named .txt.gz, as that writer names them, and are one gzip stream
each, so readers that seek by record need them compressed anew.

``digests`` runs over the chunks of each record in order and carries the
SHA-1 state from row to row; single-chunk records take no shuffle.

Payloads of at least ``least_bytes`` that are equal (by SHA-256) are stored
once: the record of the smallest page_id is the response, others are
``revisit`` records (profile identical-payload-digest) without payload that
name the response's page and address and the payload's digest and size.

Defined cases: null html is an empty payload; null page_id gets a record
without X-Page-ID and is never a response that others refer to; rows that
repeat the smallest page_id are all responses; url null: the target URI is
left out; line ends in a url become spaces; further columns are not read; an
empty table writes no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import new_path, stored

CHUNK_BYTES = 1 << 18
_VERSION, _SPLIT, _END = "WARC/1.1\r\n", "WARC/1.", "\r\n\r\n"
_MARK = _SPLIT.encode()


def bounds(payload, chunk_bytes: int) -> list[tuple[int, int]]:
    """Chunks of a payload (one at least), none longer than ``chunk_bytes``, none holding the mark. No more than a chunk is copied at once."""
    view, cuts, at = memoryview(payload), [0], 0
    while at < len(view):
        end = min(at + chunk_bytes, len(view))
        mark = bytes(view[at:end]).find(_MARK)
        at = at + mark + 5 if mark >= 0 else end
        cuts.append(at)
    return list(zip(cuts, cuts[1:], strict=False)) or [(0, 0)]


def b32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _records(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[bytes]:
    begun = False
    for batch in batches:
        for k in range(batch.num_rows):
            page, url, row, refers, refers_url = (batch.column(c)[k].as_py() for c in range(5))
            payload = batch.column(5)[k]
            payload = memoryview(payload.as_buffer() if payload.is_valid else b"")
            name = hashlib.md5(f"{page}|{row}".encode()).hexdigest()
            record_id = f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:]}>"
            if not begun:
                begun, about = True, b"software: pointlane\r\nformat: WARC File Format 1.1\r\n"
                lines = ["WARC-Type: warcinfo", f"WARC-Record-ID: {record_id[:-1]}:info>", _DATE, "Content-Type: application/warc-fields", f"Content-Length: {len(about)}"]
                yield _row(lines, about)
            digest = f"sha1:{b32(hashlib.sha1(payload).digest())}"
            common = ([f"WARC-Target-URI: {_uri(url)}"] if url else []) + [f"X-Page-ID: {page}"] * (page is not None)
            common += [_DATE, f"WARC-Payload-Digest: {digest}"]
            if refers is not None:
                lines = ["WARC-Type: revisit", f"WARC-Record-ID: {record_id}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers}", f"X-Payload-Length: {len(payload)}"]
                lines += ([f"WARC-Refers-To-Target-URI: {_uri(refers_url)}"] if refers_url else []) + [_DATE.replace("WARC-", "WARC-Refers-To-")]
                yield _row([*lines, *common, "Content-Length: 0"], b"")
                continue
            parts = bounds(payload, chunk_bytes)
            for n, (a, b) in enumerate(parts):
                own = [f"WARC-Type: {'continuation' if n else 'response'}", f"WARC-Record-ID: {record_id if n == 0 else record_id[:-1] + f':{n + 1}>'}", "Content-Type: text/html; charset=utf-8"]
                if len(parts) > 1:
                    own += [f"WARC-Segment-Number: {n + 1}"] + [f"WARC-Segment-Origin-ID: {record_id}"] * (n > 0)
                    own += [f"WARC-Segment-Total-Length: {len(payload)}"] * (n == len(parts) - 1)
                yield _row([*own, *common, f"Content-Length: {b - a}"], payload[a:b])


_DATE = "WARC-Date: 1970-01-01T00:00:00Z"


def _uri(url: str) -> str:
    """An address without white space or the mark, which ``read`` splits at."""
    return " ".join(url.split()).replace(_SPLIT, "WARC%2F1.")


def _row(lines: list[str], payload) -> bytes:
    return b"".join([_VERSION.encode(), "\r\n".join(lines).encode(), _END.encode(), payload])


def _record_batches(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for record in _records(batches, chunk_bytes):
        held.append(record)
        size += len(record)
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
            held, size = [], 0
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])


def write(pages: DataFrame, path: str, least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> None:
    """A record for each row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    size = F.octet_length("payload")
    keys = rows.where((size >= least_bytes) & F.col("page_id").isNotNull()).groupBy(F.sha2("payload", 256).alias("of")).agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.min(F.struct("page_id", "url")).getField("url").alias("first_url"))
    # Only payloads of several pages are joined; this table is written first so that its size is known.
    repeated = stored(keys.where("first < last").select("of", "first", "first_url"), "repeated")
    # Payloads too small to refer to have a key of their own each, so that they don't meet in one task.
    apart = F.concat(F.lit("!"), F.xxhash64("page_id", "url", F.monotonically_increasing_id()).cast("string"))
    rows = rows.withColumn("key", F.when(size >= least_bytes, F.sha2("payload", 256)).otherwise(apart)).join(repeated, F.col("key") == F.col("of"), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    ready = rows.select("page_id", "url", F.monotonically_increasing_id().alias("row"), refers.alias("refers"), "first_url", "payload")
    records = ready.mapInArrow(lambda it: _record_batches(it, chunk_bytes), "value binary")
    # The row begins with the version line; the separator ends the record.
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", _END).option("compression", "gzip").text(path)


_CHUNKS = "record_id string, chunk_no int, record_type string, page_id long, target_uri string, refers_to long, header_digest string, revisit_length long, last boolean, intact boolean, chunk binary"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in _CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    short: list[bytes] | None = None  # a record that wants more bytes than came so far, in pieces
    missing = 0
    for batch in batches:
        rows: list[tuple] = []
        for value in batch.column(0).to_pylist():
            if short is not None and not _HEAD.match(value):
                short += [_MARK, value]
                missing -= len(_MARK) + len(value)
                if missing <= 0:
                    rows += _record(b"".join(short))
                    short = None
                continue
            if short is not None:
                rows += _record(b"".join(short))
                short = None
            if (missing := _missing(value)) > 0:
                short = [value]
            else:
                rows += _record(value)
        yield table(rows)
    if short is not None:
        yield table(_record(b"".join(short)))


#: What follows the mark where a record begins.
_HEAD = re.compile(rb"[01]\r\nWARC-", re.IGNORECASE)


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))}


def _missing(value: bytes) -> int:
    """Bytes that a record lacks of what its head says."""
    head, found, body = value.partition(b"\r\n\r\n")
    return int(_fields(head).get("content-length", 0)) - len(body) if found else 0


def _record(value: bytes) -> list[tuple]:
    head, found, body = value.partition(b"\r\n\r\n")
    fields = _fields(head)
    if not found or fields.get("warc-type", "warcinfo") == "warcinfo":
        return []
    length, number = int(fields.get("content-length", 0)), int(fields.get("warc-segment-number", 0))
    number_of = lambda name: int(fields[name]) if name in fields else None
    return [(
        fields.get("warc-segment-origin-id", fields.get("warc-record-id")), max(number - 1, 0), fields["warc-type"], number_of("x-page-id"), fields.get("warc-target-uri"), number_of("x-refers-to-page"),
        fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, number_of("x-payload-length"), number == 0 or "warc-segment-total-length" in fields, len(body) >= length, body[:length],
    )]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives under ``path``: a row for each record or segment but ``warcinfo``.

    ``intact`` is false where an archive holds fewer bytes than the record says.
    """
    text = spark.read.option("lineSep", _SPLIT).text(path)
    return text.select(F.col("value").cast("binary").alias("value")).mapInArrow(_parsed, _CHUNKS)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a record stand together in order; the digest's state goes from row to row."""
    name, state, size = None, hashlib.sha1(), 0
    for batch in batches:
        digests, sizes = [], []
        for record_id, chunk in zip(batch.column(0).to_pylist(), batch.column(batch.num_columns - 1), strict=True):
            if record_id != name:
                name, state, size = record_id, hashlib.sha1(), 0
            data = chunk.as_buffer()
            state.update(data)
            size += len(data)
            digests.append(b32(state.digest()))
            sizes.append(size)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], names=[*batch.schema.names[:-1], "bytes_so_far", "digest_so_far"])


def digests(chunks: DataFrame) -> DataFrame:
    """Chunks without their bytes, each with size and digest of its record so far."""
    out = _CHUNKS.removesuffix(", chunk binary") + ", bytes_so_far long, digest_so_far string"
    alone = chunks.where("chunk_no = 0 AND last").mapInArrow(_running, out)
    several = chunks.where("NOT (chunk_no = 0 AND last)").repartition("record_id").sortWithinPartitions("record_id", "chunk_no").mapInArrow(_running, out)
    return alone.union(several)


def pages(chunks: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri, intact of each record that isn't a continuation."""
    rows = digests(chunks)
    whole = rows.where("chunk_no = 0 AND last")
    revisit = F.col("record_type") == "revisit"
    one = whole.select("page_id", F.when(revisit, F.col("revisit_length")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"), F.when(revisit, F.col("header_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"), "record_type", F.col("refers_to"), "target_uri", "intact")
    parts = rows.where("NOT (chunk_no = 0 AND last)").groupBy("record_id").agg(
        F.max("page_id").alias("page_id"), F.max("bytes_so_far").alias("payload_bytes"), F.max_by("digest_so_far", "chunk_no").alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"), F.max("target_uri").alias("target_uri"), (F.min("intact") & F.max("last")).alias("intact"),
    )
    return one.union(parts.drop("record_id"))


def round_trip(table: DataFrame, least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the archives of ``table`` to the shared folder and read them back."""
    spark = table.sparkSession
    path = new_path(spark, "warc")
    write(table, path, least_bytes, chunk_bytes)
    return pages(read(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
