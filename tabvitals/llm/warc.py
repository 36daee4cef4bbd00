"""WARC archives written from pages and read back, by way of a table of chunks.

A page becomes rows of a record and a chunk number: no chunk is longer than the limit, and each
carries the digest of the payload up to its end, which is taken further chunk by chunk. An archive
holds a record per chunk: the first is the page's `response`, further ones are its `continuation`
(segments, as the format has them for oversized payloads). Nothing holds a record in full beside
the page's own cell, and reading holds a chunk at a time.

Of pages with equal payloads of some length, the one with the largest id is the response; others
are `revisit` records without payload, which name it. Equal payloads are found by length and SHA-1,
counted with partial aggregates; the join back is Spark's to plan and to split where copies abound.

Archives are written by Spark's text writer, whose line separator is the end of a record, and so
are committed as a whole, to any file system that Spark writes to. They are read by its text
reader, separated by the first line of a record. The cuts between chunks are such that this line
stands in no chunk, so a payload that holds it comes back as it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
LEAST_BYTES = 1000  # of payloads that are worth a revisit record

_VERSION = b"WARC/1.1\r\n"
_BEGIN = re.compile(re.escape(_VERSION.rstrip()))
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def typed(
    pages: DataFrame, key: str, url: str, payload: str, least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """The pages as key, url, payload (binary), n_bytes, digest, record_type and refers_to.

    Rows with a payload that the response has too are revisits, but for those with its id: rows
    that repeat an id and a payload are all responses. A null payload is empty. A null id is
    smaller than all others; copies without any id are all responses.
    """
    data = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{url}`").cast("string").alias("url"),
        data.alias("payload"),
    ).withColumns({"n_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    copies = (
        rows.filter(F.col("n_bytes") >= least_bytes)
        .groupBy("digest", "n_bytes")
        .agg(F.max("key").alias("owner"), F.count("*").alias("n_copies"))
        .filter((F.col("n_copies") > 1) & F.col("owner").isNotNull())
        .select("digest", "n_bytes", "owner")
    )
    revisit = F.col("owner").isNotNull() & ~F.col("key").eqNullSafe(F.col("owner"))
    return rows.join(copies, ["digest", "n_bytes"], "left").select(
        "key",
        "url",
        "payload",
        "n_bytes",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("owner")).alias("refers_to"),
    )


def cuts(whole: bytes | memoryview, limit: int) -> Iterator[tuple[int, int]]:
    """Where chunks begin and end: at the limit, or inside the words that begin a record.

    The line break is not looked for, as the end of a record begins with one.
    """
    start, size = 0, len(whole)
    while start < size or start == 0:
        end = min(start + limit, size)
        if found := _BEGIN.search(whole, start, end):
            end = found.start() + 4
        yield start, end
        start = end
        if not size:
            return


def pieces(cell: pa.Scalar, limit: int) -> Iterator[tuple[int, bool, str, int, bytes]]:
    """Number, whether it is the last, digest so far, end and octets of each chunk of a payload.

    The payload stays in its Arrow buffer; a chunk at a time is copied.
    """
    view, running = memoryview(cell.as_buffer() or b""), hashlib.sha1()
    for number, (start, end) in enumerate(cuts(view, limit)):
        running.update(view[start:end])
        yield number, end == len(view), running.hexdigest(), end, bytes(view[start:end])


_CHUNKS = pa.schema(
    [
        ("record_id", pa.string()),
        ("chunk_no", pa.int64()),
        ("is_last", pa.bool_()),
        ("digest_so_far", pa.string()),
        ("bytes_so_far", pa.int64()),
        ("key", pa.string()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("digest", pa.string()),
        ("n_bytes", pa.int64()),
        ("chunk", pa.binary()),
    ]
)
_CHUNKS_SQL = (
    "record_id string, chunk_no bigint, is_last boolean, digest_so_far string, "
    "bytes_so_far bigint, key string, url string, record_type string, refers_to string, "
    "digest string, n_bytes bigint, chunk binary"
)
_BATCH_BYTES = 8 << 20


@dataclass
class _Batches:
    """Rows, given out as a batch when they have got long."""

    schema: pa.Schema
    rows: list[tuple] = field(default_factory=list)
    size: int = 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 200
        if self.size >= _BATCH_BYTES:
            yield self.taken()

    def taken(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in self.schema]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def chunked(records: DataFrame, limit: int = CHUNK_BYTES) -> DataFrame:
    """Typed pages as chunks: a row per record and chunk number, with the digest up to there.

    A record without payload, such as a revisit, has one empty chunk. The id of a record is new
    for every row, also of rows that repeat another.
    """
    source = records.select(
        F.col("key").cast("string"),
        "url",
        "record_type",
        F.col("refers_to").cast("string"),
        "digest",
        "n_bytes",
        F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"),
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, task, n = _Batches(_CHUNKS), TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                key, url, kind, refers_to, digest, n_bytes = (
                    batch.column(c)[i].as_py() for c in range(6)
                )
                for *place, chunk in pieces(batch.column(6)[i], limit):
                    row = (
                        f"{task}-{n}", *place,
                        key, url, kind, refers_to, digest, n_bytes, chunk,
                    )
                    yield from out.add(row, len(chunk))
                n += 1
        yield out.taken()

    return source.mapInArrow(split, _CHUNKS_SQL)


def _text(value: str | None) -> str:
    """A header's value on one line."""
    return (value or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _value(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _record(row: dict, date: str) -> bytes:
    """The record of one chunk, without its end."""
    number, segmented = row["chunk_no"], row["chunk_no"] > 0 or not row["is_last"]
    kind = row["record_type"] if number == 0 else "continuation"
    page = f"<urn:page:{_text(row['key'])}>"
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", page if number == 0 else f"<urn:page:{_text(row['key'])}#{number}>"),
        ("WARC-Date", date),
        ("X-Row", row["record_id"]),
    ]
    if row["key"] is not None:
        head.append(("X-Key", _text(row["key"])))
    if row["url"] is not None:
        head.append(("WARC-Target-URI", _text(row["url"])))
    head += [
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("X-Payload-Length", str(row["n_bytes"])),
    ]
    if segmented:
        head += [
            ("WARC-Segment-Number", str(number + 1)),
            ("X-Digest-So-Far", row["digest_so_far"]),
        ]
        if number:
            head.append(("WARC-Segment-Origin-ID", page))
        if row["is_last"]:
            head.append(("WARC-Segment-Total-Length", str(row["bytes_so_far"])))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {row['n_bytes']}{_END}"
    block = b"" if kind == "continuation" else http.encode()
    if kind == "revisit":
        head += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", f"<urn:page:{_text(row['refers_to'])}>"),
        ]
    head += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block) + len(row["chunk"]))),
    ]
    lines = "\r\n".join(f"{name}: {value}" for name, value in head)
    return _VERSION + lines.encode() + _END.encode() + block + row["chunk"]


def write(chunks: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """The chunks as archives (gzip) in a folder of Spark's file system."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [_record(row, date) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])

    rows = chunks.mapInArrow(records, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", _END).option(
        "compression", "gzip"
    ).text(path)


_FOUND = pa.schema([(f.name, f.type) for f in _CHUNKS])


def _parsed(record: bytes) -> tuple | None:
    """A chunk from a record without its first line; a whole payload is digested at once."""
    head, found, rest = record.partition(_END.encode())
    if not found:
        return None
    names = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    block = memoryview(rest)[: int(names["Content-Length"])]
    if len(block) < int(names["Content-Length"]):
        raise ValueError(f"record of {names.get('X-Row')} is cut off")
    kind, number = names["WARC-Type"], int(names.get("WARC-Segment-Number", 1)) - 1
    begin = 0 if kind == "continuation" else rest.index(_END.encode()) + len(_END)
    chunk = block[begin:]
    whole = "WARC-Segment-Number" not in names
    digest = names["WARC-Payload-Digest"].removeprefix("sha1:")
    so_far, n_bytes = names.get("X-Digest-So-Far"), int(names["X-Payload-Length"])
    if kind == "revisit":
        so_far = digest
    elif whole:
        so_far = hashlib.sha1(chunk).hexdigest()
        if len(chunk) != n_bytes:
            raise ValueError(f"payload of {names.get('X-Row')} is cut off")
    url, refers_to = names.get("WARC-Target-URI"), names.get("WARC-Refers-To")
    return (
        names["X-Row"],
        number,
        whole or "WARC-Segment-Total-Length" in names,
        so_far,
        int(names.get("WARC-Segment-Total-Length", n_bytes if whole else 0)),
        _value(names["X-Key"]) if "X-Key" in names else None,
        None if url is None else _value(url),
        kind,
        None if refers_to is None else _value(refers_to[len("<urn:page:") : -1]),
        digest,
        n_bytes,
        None if whole else bytes(chunk),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The chunks in the archives of a folder. Payloads of one chunk are checked and left out."""
    lines = spark.read.option("lineSep", _VERSION.decode()).text(path)
    source = lines.filter(F.length("value") > 0).select(F.col("value").cast("binary"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _Batches(_FOUND)
            for value in batch.column(0):
                row = _parsed(value.as_py())
                if row:
                    yield from out.add(row, len(row[-1] or b""))
            yield out.taken()

    return source.mapInArrow(parse, _CHUNKS_SQL)


_PAGES = pa.schema(
    [
        ("key", pa.string()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.string()),
        ("n_chunks", pa.int64()),
    ]
)


def checked(chunks: DataFrame) -> DataFrame:
    """A row per record: its page, with length and digest worked out anew from its chunks.

    The chunks of a record meet in order and go by one at a time. A chunk that is missing, or
    whose digest up to there is another, ends the job with an error.
    """
    order = ["record_id", "chunk_no"]
    ordered = chunks.repartition("record_id").sortWithinPartitions(*order)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, running, n_bytes, last = _Batches(_PAGES), hashlib.sha1(), 0, (None, -1, True)
        head: tuple = ()
        for batch in batches:
            for i in range(batch.num_rows):
                (
                    record, number, is_last, so_far, total, key, url, kind, refers_to,
                    digest, length, chunk,
                ) = (batch.column(c)[i].as_py() for c in range(12))
                if number == 0:
                    if not last[2]:
                        raise ValueError(f"chunks of record {last[0]} are missing")
                    running, n_bytes, head = hashlib.sha1(), 0, (kind, refers_to)
                elif (record, number - 1) != last[:2]:
                    raise ValueError(f"chunk {number} of record {record} follows none")
                last = (record, number, is_last)
                if chunk is not None:
                    running.update(chunk)
                    n_bytes += len(chunk)
                    if running.hexdigest() != so_far:
                        raise ValueError(f"chunk {number} of record {record} has been changed")
                if not is_last:
                    continue
                n_bytes = length if chunk is None else n_bytes
                if so_far != digest or n_bytes != length or (chunk is not None and total != length):
                    raise ValueError(f"record {record} has been changed")
                row = (key, url, n_bytes, so_far, head[0], head[1], number + 1)
                yield from out.add(row, 200)
        if not last[2]:
            raise ValueError(f"chunks of record {last[0]} are missing")
        yield out.taken()

    return ordered.mapInArrow(
        assemble,
        "key string, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to string, n_chunks bigint",
    )


def round_trip(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """Pages, written to archives below the path and read from there.

    Null payloads are empty, null ids and addresses come back as null; an empty table gives
    archives without records; other columns are not archived.
    """
    kind = pages.schema[key].dataType
    write(chunked(typed(pages, key, url, payload), limit), path)

    def typed_key(name: str) -> Column:
        return F.col(name).cast(kind)

    back = checked(read(pages.sparkSession, path))
    return back.select(
        typed_key("key").alias(key),
        "payload_bytes",
        "payload_digest",
        "record_type",
        typed_key("refers_to").alias("refers_to"),
        "url",
        "n_chunks",
    )
