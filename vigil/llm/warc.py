"""Web archives (WARC 1.1) written and read by Spark, as a chunked record table.

Writing.  Payloads longer than ``chunk_bytes`` become segments, as the format provides: the first in
the record itself, the others in ``continuation`` records right behind it, so that no record on disk is
larger.  Of records with equal payloads the one with the smallest id holds the payload, the others are
``revisit`` records that name it.  Archives are gzip files written by Spark's text writer (any bytes
pass through it), so they go to whatever store the path names.

Reading.  A gzip file is one sequential stream of lines.  Each task walks its files with one record's
header, at most ``chunk_bytes`` of payload and one running SHA-1 in hand, and emits rows (record id,
chunk number, start, bytes, digest of the payload so far): no payload is ever held whole, and a
consumer can check or stop at any chunk.  The last chunk's row closes the record.

Defined results: a null payload is written as an empty one; a record without payload has one empty chunk;
rows with a null id are written, never as the target of a revisit; rows that repeat the smallest id of
their payload are all responses; line breaks in a URL are percent-encoded; an empty table gives an
empty archive.  A continuation that does not follow its record is read as a record of its own; a file cut off
in a record gives that record's chunks without a last one.
"""

from __future__ import annotations

from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import written

CHUNK = ("record_id string, warc_type string, target_uri string, refers_to string, declared_digest string, declared_bytes bigint, "
         "chunk_no int, chunk_start bigint, chunk binary, running_digest string, is_last boolean")
URN = "urn:record:"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 (eight times 20 bits, as four digits)."""
    digits = F.concat(*(F.lpad(F.conv(F.substring(F.sha1(data), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def urn(record: Column) -> Column:
    return F.concat(F.lit(f"<{URN}"), F.coalesce(record.cast("string"), F.lit("null")), F.lit(">"))


def urn_id(record: Column, kind: str = "bigint") -> Column:
    """The id in a record's URN; null where there is none."""
    return F.regexp_extract(record, f"^<{URN}(.*)>$", 1).try_cast(kind)


def write(rows: DataFrame, path: str, id_col: str, uri_col: str, payload: Column, chunk_bytes: int = 1 << 20,
          revisit_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write a record per row; payloads of at least ``revisit_bytes`` are stored once."""
    base = rows.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), F.coalesce(payload, F.lit(b"")).alias("p"))
    base = base.select("*", F.sha2("p", 256).alias("sha"), F.length("p").cast("bigint").alias("n"))
    kept = (base.where((F.col("n") >= revisit_bytes) & F.col("id").isNotNull()).groupBy("sha")
            .agg(F.min("id").alias("keeper"), F.count("*").alias("c")).where("c > 1").select("sha", "keeper"))
    # a table of its own, so that the join can split the partitions of a frequent payload
    out = base.join(written(kept, "kept-payloads"), "sha", "left")
    out = out.withColumn("keeper", F.when((F.col("id") != F.col("keeper")) & (F.col("n") >= revisit_bytes), F.col("keeper")))
    revisit = F.col("keeper").isNotNull()
    segments = F.when(revisit, 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("n") / chunk_bytes)).cast("int"))
    out = out.select("*", base32_sha1(F.col("p")).alias("digest"), segments.alias("segments"))
    out = out.select("*", F.explode(F.sequence(F.lit(1), F.col("segments"))).alias("segment"))
    chunk = F.when(revisit, F.lit(b"")).otherwise(F.substring(F.col("p"), (F.col("segment") - 1) * chunk_bytes + 1, F.lit(chunk_bytes)))
    out = out.withColumn("chunk", chunk)
    first, last = F.col("segment") == 1, F.col("segment") == F.col("segments")
    uri = F.replace(F.replace(F.coalesce("uri", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
        return text if when is None else F.when(F.coalesce(when, F.lit(False)), text).otherwise("")

    record = urn(F.col("id"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").when(first, "response").otherwise("continuation")),
        line("WARC-Record-ID", F.when(first, record).otherwise(urn(F.concat_ws(":", F.lit("segment"), F.col("id"), F.col("segment"))))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), revisit),
        line("WARC-Refers-To", urn(F.col("keeper")), revisit),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("Payload-Length", F.col("n"), first),
        line("WARC-Segment-Number", F.col("segment"), F.col("segments") > 1),
        line("WARC-Segment-Origin-ID", record, ~first),
        line("WARC-Segment-Total-Length", F.col("n"), last & ~first),
        line("Content-Type", F.lit("application/octet-stream"), ~revisit),
        line("Content-Length", F.length("chunk")), F.lit("\r\n"))
    bytes_ = F.concat(header.cast("binary"), F.col("chunk"), F.lit(b"\r\n\r"))
    out.select(bytes_.cast("string").alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(path)


class _Record:
    """One record while it is read: header, running digest, the chunk that fills up."""

    def __init__(self, head: dict[str, str]):
        self.id, self.head = head.get("warc-record-id"), head
        self.digest, self.chunk, self.no, self.start = sha1(), bytearray(), 0, 0

    def row(self, last: bool) -> tuple:
        digest = self.head.get("warc-payload-digest")
        size = self.head.get("payload-length", "")
        out = (self.id, self.head.get("warc-type"), self.head.get("warc-target-uri"), self.head.get("warc-refers-to"),
               digest and digest.rpartition(":")[2], int(size) if size.isdigit() else None, self.no, self.start,
               bytes(self.chunk), b32encode(self.digest.digest()).decode(), last)
        self.no, self.start = self.no + 1, self.start + len(self.chunk)
        self.chunk.clear()
        return out

    def add(self, data: bytes, most: int) -> Iterator[tuple]:
        for i in range(0, len(data), most):
            part = data[i:i + most]
            while part:
                if len(self.chunk) == most:
                    yield self.row(False)
                take, part = part[:most - len(self.chunk)], part[most - len(self.chunk):]
                self.digest.update(take)
                self.chunk += take


def _walk(lines: Iterator[tuple[str, bytes]], most: int) -> Iterator[tuple]:
    """Chunk rows of (file, line) pairs in order."""
    file, record, head, left, parts = None, None, None, 0, False
    for name, line in lines:
        if name != file:
            file, record, head, left = name, None, None, 0
        if left:  # in a block; the line's own end belongs to it as far as the block reaches
            data = (line + b"\n")[:left]
            left -= len(data)
            yield from record.add(data, most)
            if not left and not parts:
                yield record.row(True)
                record = None
            continue
        text = line.rstrip(b"\r").decode("utf-8", "replace")
        if head is None:
            if text.startswith("WARC/"):
                head = {}
        elif text:
            key, _, value = text.partition(":")
            head[key.strip().lower()] = value.strip()
        else:
            number = head.get("warc-segment-number")
            total = head.get("warc-segment-total-length")
            if not (record and head.get("warc-segment-origin-id") == record.id):
                record = _Record(head)
            parts = number is not None and total is None  # more segments follow
            size = head.get("content-length", "")
            left, head = int(size) if size.isdigit() else 0, None
            if not left and not parts:
                yield record.row(True)
                record = None


def _reader(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in CHUNK.split(", ")]
        kinds = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}[x.split()[1]]
                 for x in CHUNK.split(", ")]

        def lines():
            for b in batches:
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist())

        held, size = [], 0
        for row in _walk(lines(), most):
            held.append(row)
            size += len(row[8]) + 200
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)

    return run


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = 1 << 20) -> DataFrame:
    """The chunk rows of every gzip archive below ``path``."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    return lines.mapInArrow(_reader(chunk_bytes), CHUNK)


def records(chunks: DataFrame) -> DataFrame:
    """One row per complete record: its type and target, and the length and digest of its payload, as read
    for records that hold it, as declared for revisits; ``n_chunks``; ``intact`` where both agree."""
    held = F.col("warc_type") != "revisit"
    size = F.col("chunk_start") + F.length("chunk")
    return chunks.where("is_last").select(
        "record_id", "target_uri", F.col("warc_type").alias("record_type"), "refers_to",
        F.when(held, size).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(held, F.col("running_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        (F.col("chunk_no") + 1).alias("n_chunks"),
        (~held | F.coalesce(F.col("running_digest") == F.col("declared_digest"), F.lit(True))).alias("intact"))
