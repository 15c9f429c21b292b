"""WARC: a writer and a sequential reader, one gzip member per record.

Writing: every row becomes one gzip member.  Members are appended by Spark's
text writer, so archives land on any file system Spark can write, and a
retried task replaces its own file.  The last byte of a member is the top byte
of its length, 0 below 16 MiB; that byte is left off and written by the text
writer as its line separator ``\\x00``.  A longer record is followed by an
empty member, which ends in that byte too; readers skip it.

Reading: each archive is inflated piece by piece; a member's end is found by
zlib, the block by Content-Length, and both digests are checked.

Cases: a null payload is written as empty; a null url leaves the target URI
out; a null id gives a record id without a number and reads back as null;
control characters of a url are percent-encoded.  Of equal payloads of at
least ``revisit_from`` bytes, rows with the smallest id are responses (several
if that id repeats); if all their ids are null, all are responses.  Extra
columns are ignored, an empty table gives an empty archive folder.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..session import scratch_path
from .common import table

REVISIT_FROM = 100
RECORDS_PER_ARCHIVE = 4096
PIECE = 1 << 16
SALTS = 16
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
EPOCH = "1970-01-01T00:00:00Z"  # the tables carry no crawl time
READ_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, payload binary, "
               "payload_length bigint, payload_digest string")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC/1.1 record; ``first`` set makes it a revisit of that page."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http + payload if first is None else http
    name = "" if page_id is None else page_id
    head = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"),
            ("WARC-Date", EPOCH)]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(("WARC-Target-URI", safe))
    if first is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{first}>")]
    head += [("WARC-Payload-Digest", f"sha256:{digest}"),
             ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """The gzip member(s) of a record without the closing zero byte."""
    packed = gzip.compress(data, compresslevel=6, mtime=0)
    if packed[-1]:
        packed += EMPTY_MEMBER
    return packed[:-1]


@F.arrow_udf(BinaryType())
def _packed(page_id: pa.Array, url: pa.Array, payload: pa.Array, digest: pa.Array, first: pa.Array) -> pa.Array:
    rows = zip(*(c.to_pylist() for c in (page_id, url, payload, digest, first)))
    return pa.array([member(record(*r)) for r in rows], pa.binary())


def inflate(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The content of each gzip member, fed by pieces of an archive."""
    box, out, clean = zlib.decompressobj(31), bytearray(), True
    for piece in pieces:
        while piece:
            out += box.decompress(piece)
            clean, piece = box.eof, box.unused_data
            if box.eof:
                if out:
                    yield bytes(out)
                box, out = zlib.decompressobj(31), bytearray()
    if not clean:
        raise ValueError("archive ends inside a gzip member")


def headers(lines: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = lines.decode("utf-8").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest)}


def parse(data: bytes) -> tuple:
    """A row of READ_SCHEMA; raises ValueError where framing or a digest is wrong."""
    at = data.find(b"\r\n\r\n")
    version, head = headers(data[:at] if at >= 0 else b"")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC version line")
    length, start = int(head["content-length"]), at + 4
    block = data[start:start + length]
    if len(block) != length or data[start + length:] != b"\r\n\r\n":
        raise ValueError(f"{head.get('warc-record-id')}: block and Content-Length differ")

    def verify(name: str, what: bytes) -> None:
        said = head.get(name, "").partition(":")
        if said[2] and (said[0].lower() != "sha256" or hashlib.sha256(what).hexdigest() != said[2].lower()):
            raise ValueError(f"{head.get('warc-record-id')}: {name} is wrong")

    verify("warc-block-digest", block)
    split = block.find(b"\r\n\r\n")
    _, http = headers(block[:split])
    payload, kind = block[split + 4:], head["warc-type"]
    size = int(http["content-length"])
    if kind == "response":
        verify("warc-payload-digest", payload)
        if len(payload) != size:
            raise ValueError(f"{head.get('warc-record-id')}: payload and its length differ")
    return (head["warc-record-id"].strip("<>"), kind, head.get("warc-target-uri"),
            head.get("warc-refers-to", "").strip("<>") or None, payload if kind == "response" else None, size,
            head.get("warc-payload-digest", "").partition(":")[2] or None)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
                        ("refers_to", pa.string()), ("payload", pa.binary()), ("payload_length", pa.int64()),
                        ("payload_digest", pa.string())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for files in batches:
        for content in files.column(0):
            whole, rows, held = memoryview(content.as_buffer()), [], 0
            for data in inflate(bytes(whole[i:i + PIECE]) for i in range(0, len(whole), PIECE)):
                rows.append(parse(data))
                held += len(data)
                if held > 1 << 22:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", revisit_from: int = REVISIT_FROM,
               records_per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    """Write a record per row under ``path``.  The smallest id of each digest
    is found by a map-side combined minimum; its join back is salted, so one
    payload held by a third of all rows spreads over ``SALTS`` tasks."""
    rows = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
            .withColumn("digest", F.sha2("payload", 256)))
    copies = (rows.filter(F.length("payload") >= revisit_from).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1 and first is not null")
              .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    linked = salted.join(copies, ["digest", "salt"], "left")
    first = F.when(F.col("first") != F.coalesce("page_id", F.col("first") - 1), F.col("first"))
    (linked.select(_packed("page_id", "url", "payload", "digest", first).cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("maxRecordsPerFile", records_per_archive).text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record under ``path`` (READ_SCHEMA), checked while read."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, READ_SCHEMA)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("bigint"))
    return read_warc(spark, path).select(
        as_id("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
        "record_type", as_id("refers_to").alias("refers_to"))


WARC_SQL = """
with rows as (select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as payload_bytes,
                     sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (select payload_digest, min(page_id) as first_id from rows where payload_bytes >= 100 group by payload_digest)
select r.page_id, r.payload_bytes::bigint as payload_bytes, r.payload_digest,
       case when f.first_id <> r.page_id then 'revisit' else 'response' end as record_type,
       case when f.first_id <> r.page_id then f.first_id end as refers_to
from rows r left join firsts f on r.payload_digest = f.payload_digest and r.payload_bytes >= 100
"""
