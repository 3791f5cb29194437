"""WARC archives: a writer that stores equal payloads once, and a salvage reader.

The writer makes one record per page: a ``response`` with the whole payload, or a ``revisit`` that
refers to the response with the same payload. Records are built by SQL expressions and written by
Spark's text writer, whose line separator is the two line ends that close a record; with
``gzip=True`` each record is a gzip member of its own, parted by a zero byte, which readers of gzip
skip as padding.

The reader takes every file as bytes. A record must pass all checks (version line, header fields,
length, closing line ends, block and payload digests; for gzip also the member's own checksum). After
a failed check it searches for the next member or version line from which a whole record can be read,
goes on from there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The format's version line, record end, and the two base32 alphabets.
VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"
RECORDS_PER_FILE = 2000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits at a time are four base32 digits."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def records(pages: DataFrame, id_column: str = "page_id", min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` with ``payload``, ``payload_digest`` and ``refers_to``: the id of the response
    with the same payload, or NULL for the responses themselves.

    Of equal payloads of ``min_revisit_bytes`` or more the row with the largest id is the response;
    rows that repeat that id are responses too. A NULL id is smaller than any other; rows without id
    refer only to a row with one. Only groups of two or more take part in the join, and the page side
    of it can be split when one payload is very common.
    """
    pages = pages.withColumn("payload", F.coalesce(F.col("html"), F.lit(""))).withColumn(
        "payload_digest", base32_sha1(F.encode("payload", "UTF-8"))
    )
    long_enough = F.octet_length("payload") >= min_revisit_bytes
    holders = (
        pages.filter(long_enough)
        .groupBy("payload_digest")
        .agg(F.max(id_column).alias("_holder"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(F.col("payload_digest").alias("_digest"), "_holder")
    )
    same = (F.col("payload_digest") == F.col("_digest")) & long_enough
    other = F.col("_holder").isNotNull() & ~F.col(id_column).eqNullSafe(F.col("_holder"))
    return (
        pages.join(holders, same, "left")
        .withColumn("refers_to", F.when(other, F.col("_holder")))
        .drop("_digest", "_holder")
    )


def _field(name: str, value: Column) -> Column:
    """One header line, absent where the value is NULL; line ends in it would break the header."""
    clean = F.regexp_replace(value, r"[\x00-\x1f\x7f]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def record_text(id_column: str = "page_id") -> Column:
    """A WARC record, without its end, from the columns of ``records``."""
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("payload").cast("string")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size,
        F.lit("\r\n\r\n"),
    )
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    uri = lambda c: F.concat(F.lit(f"<{PAGE_URN}"), c.cast("string"), F.lit(">"))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", F.coalesce(uri(F.col(id_column)), F.lit(f"<{PAGE_URN}>"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.encode(block, "UTF-8")))),
        _field("WARC-Refers-To", F.when(revisit, uri(F.col("refers_to")))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        # what a revisit stands for; an extension field
        _field("WARC-Payload-Length", size),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


@F.pandas_udf(T.BinaryType())
def _member(record):
    """Each record, with its end, as a gzip member. A member's last byte belongs to its length and is
    zero below 16 MB; it is left to the separator then."""
    def one(text: str) -> bytes:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        return (pack.compress((text + RECORD_END).encode()) + pack.flush()).removesuffix(b"\x00")

    return record.map(one)


def write_warc(
    recorded: DataFrame,
    path: str,
    id_column: str = "page_id",
    gzip: bool = False,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write the rows of ``records`` as WARC files into the folder ``path``."""
    text = recorded.select(record_text(id_column).alias("record"))
    if gzip:
        text = text.select(_member("record").cast("string").alias("record"))
    text.write.option("lineSep", "\x00" if gzip else RECORD_END).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def _digest(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


_START = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = re.compile(rb"\x1f\x8b\x08")
_ANY = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")
_HEAD_END = re.compile(rb"\r\n\r\n")
#: Where a header ends as a rule; a longer one, of a very long url, ends before the next version line.
USUAL_HEADER = 1 << 16
STEP = 1 << 16


def _plain_record(data, start: int) -> tuple[dict | None, int, str]:
    """Record at ``start``: its fields, block range and end, or the check that failed."""
    match = _START.match(data, start)
    if not match:
        return None, start, "no version line"
    end = _HEAD_END.search(data, match.end() - 2, start + USUAL_HEADER)
    if not end:
        following = _START.search(data, match.end())
        end = _HEAD_END.search(data, match.end() - 2, following.start() if following else len(data))
    if not end:
        return None, start, "header has no end"
    fields: dict[str, str] = {}
    for line in bytes(data[match.end() : end.start()]).split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None, start, "malformed header line"
        # the format lets no other field repeat; this one did where a record broke off in its header
        if name.lower() != b"warc-concurrent-to" and name.decode("latin-1").lower() in fields:
            return None, start, "repeated header field"
        fields[name.decode("latin-1").lower()] = value.decode("utf-8", "replace").strip()
    if not (fields.get("content-length", "").isdecimal() and "warc-type" in fields):
        return None, start, "no length or type"
    first = end.end()
    last = first + int(fields["content-length"])
    if bytes(data[last : last + 4]) != b"\r\n\r\n":
        return None, start, "truncated or wrong length"
    block = data[first:last]
    for name, part in (("warc-block-digest", block), ("warc-payload-digest", None)):
        algorithm, _, wanted = fields.get(name, "").partition(":")
        if algorithm != "sha1" or (part is None and fields["warc-type"] == "revisit"):
            continue
        if part is None:
            head = _HEAD_END.search(block)
            part = block[head.end() :] if head else block
        if _digest(part) != wanted:
            return None, start, f"{name} differs"
    return {"fields": fields, "block": block}, last + 4, ""


def _record(data, start: int) -> tuple[dict | None, int, str]:
    if not _MEMBER.match(data, start):
        return _plain_record(data, start)
    pack, parts, at = zlib.decompressobj(31), [], start
    try:
        while not pack.eof and at < len(data):  # what lies behind the member is never copied
            parts.append(pack.decompress(data[at : at + STEP]))
            at = min(at + STEP, len(data))
    except zlib.error:
        return None, start, "broken member"
    if not pack.eof:
        return None, start, "truncated member"
    plain = b"".join(parts)
    found, end, why = _plain_record(plain, 0)
    if found is None or end != len(plain):
        return None, start, why or "more than one record in a member"
    return found, at - len(pack.unused_data), ""


def salvage(data) -> Iterator[tuple]:
    """``(kind, offset, length, record or reason)`` of one file, in order: ``record`` for what was
    read, ``gap`` for what was quarantined. Every byte but padding lies in exactly one of them."""
    data = memoryview(data)
    at, gap, why = 0, None, ""
    while at < len(data):
        if data[at] == 0 and gap is None:  # padding between members
            at += 1
            continue
        found, end, failed = _record(data, at)
        if found is not None:
            if gap is not None:
                yield "gap", gap, at - gap, why
                gap = None
            yield "record", at, end - at, found
            at = end
            continue
        if gap is None:
            gap, why = at, failed
        ahead = _ANY.search(data, at + 1)
        at = ahead.start() if ahead else len(data)
    if gap is not None:
        yield "gap", gap, len(data) - gap, why


READ = (
    "path string, kind string, offset long, length long, reason string, record_type string, "
    "record_id string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes long"
)


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record and per quarantined gap of the files in ``path``.

    ``payload_digest`` and ``payload_bytes`` of a response are those of the bytes that were read;
    a revisit gives what its header says of the payload it stands for."""
    schema = READ + ", payload binary" * with_payload
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64() if c.endswith("long") else pa.binary() if c.endswith("binary") else pa.string()
             for c in schema.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for kind, offset, length, what in salvage(content.as_buffer()):
                    row = (file.as_py(), kind, offset, length)
                    if kind == "gap":
                        row += (what, None, None, None, None, None, None)
                        payload = None
                    else:
                        fields, block = what["fields"], what["block"]
                        head = _HEAD_END.search(block)
                        payload = block[head.end() :] if head else block
                        digest = fields.get("warc-payload-digest", "").partition(":")[2]
                        size: int | None = len(payload)
                        if fields["warc-type"] == "revisit":
                            said = fields.get("warc-payload-length", "")
                            size = int(said) if said.isdecimal() else None
                        else:
                            digest = _digest(payload)
                        row += (
                            None,
                            fields["warc-type"],
                            fields.get("warc-record-id"),
                            fields.get("warc-target-uri"),
                            fields.get("warc-refers-to"),
                            digest,
                            size,
                        )
                    if with_payload:
                        row += (None if payload is None else bytes(payload),)
                        held += 0 if payload is None else len(payload)
                    rows.append(row)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield flushed(rows)
                        rows, held = [], 0
                if rows:
                    yield flushed(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, schema)


def page_of(uri: Column) -> Column:
    return F.try_to_number(
        F.regexp_extract(uri, rf"^<{PAGE_URN}(-?\d+)>$", 1), F.lit("S9999999999999999999")
    ).cast("long")


def round_trip(pages: DataFrame, path: str, gzip: bool = False) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) to WARC files and read them back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to``. NULL html is empty, a NULL url leaves its
    field out, a NULL id comes back as NULL; repeated rows are written as often as they occur; an empty
    table gives no rows; further columns are ignored."""
    write_warc(records(pages.select("page_id", "url", "html")), path, gzip=gzip)
    found = read_warc(pages.sparkSession, path, with_payload=False).filter("kind = 'record'")
    return found.select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
        F.col("target_uri").alias("url"),
    )
