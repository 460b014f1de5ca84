"""WARC archives written by Spark tasks, and a reader that salvages damaged ones.

Writing: each record is one zstd frame with a checksum. Spark's text writer
puts the frames into ``part-*`` files under its commit protocol (a lost
executor leaves no half files); its line separator is an empty skippable zstd
frame, so every file is a valid multi-frame ``.warc.zst``. Of pages with equal
payloads the one with the largest page_id is stored, the others are revisits.
Only payload digests are shuffled to find them; pages meet the (usually few)
shared digests by a join that adaptive execution broadcasts or splits.

Reading: archives of the writer's layout are read by ranges (``read_frames``):
Spark's text source splits them at the record separator wherever they are cut. Other
archives are read whole by its binary source (``read_archives``; a file must
fit a task). Both are walked member by member (zstd frame, gzip member, or plain record). A member counts only if it
decompresses, its version line, headers, length and end are in order, and its
digests hold. Otherwise the reader looks for the next place where a member or
version line begins *and* a valid record follows, goes on from there, and logs
the bytes between as a quarantined gap.

Defined cases: null html is an empty payload; a null url leaves its header out;
a null page_id has a record id without a number and reads back as null; rows
repeating the largest page_id of a payload are all stored; an empty table
gives archives without records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import cut

#: Fixed values of the formats.
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A skippable zstd frame of no bytes, all ASCII: the writer's record separator.
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"

RECORDS_PER_FILE = 20_000
DATE = "1970-01-01T00:00:00Z"
ID_PREFIX = "urn:x-page:"
FEED = 1 << 16


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _escaped_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
           date: str = DATE) -> bytes:
    """One plain WARC record; a revisit keeps the HTTP headers (with the payload's length) only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    number = "" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{ID_PREFIX}{number}>"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_escaped_url(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{ID_PREFIX}{refers_to}>"]
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
              f"WARC-Block-Digest: sha1:{base32_sha1(block)}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(df: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write one record per row of ``df`` below ``path``."""
    pages = df.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"),
                      F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("sha1", F.unhex(F.sha1("payload")))
    shared = cut(pages.groupBy("sha1").agg(F.count("*").alias("n"), F.max("page_id").alias("stored"))
                 .filter("n > 1 and stored is not null").select(F.col("sha1").alias("shared_sha1"), "stored"),
                 "shared_payloads")
    joined = pages.join(shared, pages["sha1"] == shared["shared_sha1"], "left").select(
        "page_id", "url", "payload", "stored")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(write_checksum=True, write_content_size=True)
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                page, link, payload, stored = (c[i].as_py() for c in batch.columns)
                revisit = stored is not None and page != stored
                out.append(press.compress(record(page, link, payload, stored, revisit)))
            yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["frame"])

    framed = joined.mapInArrow(frames, "frame binary")
    # Spark's strings are bytes that neither the cast nor the text source checks or changes.
    (framed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME)
     .option("compression", "none").option("maxRecordsPerFile", records_per_file).text(path))


# ------------------------------------------------------------------- reading
class Damaged(Exception):
    """A member that fails a check."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def payload_length(self) -> int | None:
        """From the stored HTTP headers, so known for revisits too."""
        found = re.search(rb"(?im)^content-length:[ \t]*(\d+)", self.block.partition(b"\r\n\r\n")[0])
        return int(found[1]) if found else None


def parse_record(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The plain record at ``at`` and the place after it; raises Damaged."""
    if not VERSION.match(data, at):
        raise Damaged("no version line")
    headers = {}
    # Line by line to the blank one: a damaged run is left at its first line that is no header, not searched to its end.
    begin = data.find(b"\r\n", at) + 2
    while (end := data.find(b"\r\n", begin)) != begin:
        if end < 0:
            raise Damaged("headers do not end")
        name, colon, value = data[begin:end].decode("utf-8", "replace").partition(":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.strip().lower()] = value.strip()
        begin = end + 2
    length = headers.get("content-length", "")
    if not length.isdecimal():
        raise Damaged("no content length")
    begin, stop = end + 2, end + 2 + int(length)
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("block does not end where its length says")
    found = Record(headers, bytes(data[begin:stop]))
    if (claimed := headers.get("warc-block-digest")) and claimed != "sha1:" + base32_sha1(found.block):
        raise Damaged("block digest differs")
    if headers.get("warc-type") == "response" and (claimed := headers.get("warc-payload-digest")) \
            and claimed != "sha1:" + base32_sha1(found.payload):
        raise Damaged("payload digest differs")
    return found, stop + 4


def _inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """The compressed member at ``at`` and the place after it."""
    unpack = (zstandard.ZstdDecompressor().decompressobj() if data.startswith(ZSTD_MAGIC, at)
              else zlib.decompressobj(16 + zlib.MAX_WBITS))
    out, fed = [], at
    try:
        while not unpack.eof:
            if fed >= len(data):
                raise Damaged("member is cut off")
            out.append(unpack.decompress(data[fed:fed + FEED]))
            fed = min(fed + FEED, len(data))
    except (zlib.error, zstandard.ZstdError) as e:
        raise Damaged(f"member does not decompress: {e}") from None
    return b"".join(out), fed - len(unpack.unused_data)


def _skippable(data: bytes, at: int) -> int | None:
    """End of the skippable frame at ``at``, if there is one."""
    if data[at + 1:at + 4] == b"\x2a\x4d\x18" and data[at] >> 4 == 5 and at + 8 <= len(data):
        end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        return end if end <= len(data) else None
    return None


def _inside(plain: bytes) -> list[tuple[Record | None, str | None]]:
    """The records of an inflated member, and a reason for each gap between them; raises Damaged if it holds no record."""
    out, at, gap, failure = [], 0, False, None
    while at < len(plain):
        try:
            found, at = parse_record(plain, at)
        except Damaged as e:
            if not gap:
                out.append((None, f"inside a member: {e}"))
            gap, failure = True, failure or e
            following = VERSION.search(plain, at + 1)
            at = following.start() if following else len(plain)
            continue
        out.append((found, None))
        gap = False
    if not any(found for found, _ in out):
        raise failure or Damaged("no version line")
    return out


def _member(data: bytes, at: int) -> tuple[list[tuple[Record | None, str | None]], int]:
    """The records and inner gaps of the member at ``at``, and the place after it; raises Damaged."""
    if data.startswith(ZSTD_MAGIC, at) or data.startswith(GZIP_MAGIC, at):
        plain, end = _inflate(data, at)
        return _inside(plain), end
    found, end = parse_record(data, at)
    return [(found, None)], end


_BEGIN = re.compile(b"|".join((re.escape(ZSTD_MAGIC), re.escape(GZIP_MAGIC), VERSION.pattern)))


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | None, str | None]]:
    """(offset, length, record, None) for each valid record and (offset, length, None, reason) for each gap.

    Records and gaps inside a compressed member have the member's place.
    """
    at, gap, reason = 0, None, None
    while at < len(data):
        if gap is None and (end := _skippable(data, at)) is not None:
            at = end
            continue
        try:
            found, end = _member(data, at)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            following = _BEGIN.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at - gap, None, reason
            gap = None
        for one, why in found:
            yield at, end - at, one, why
        at = end
    if gap is not None:
        yield gap, len(data) - gap, None, reason


READ_SCHEMA = ("archive string, offset long, length long, gap_reason string, warc_type string, record_id string, "
               "refers_to string, target_uri string, payload_digest string, payload_length long, payload binary")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, glob: str = "*") -> DataFrame:
    """One row per record and per gap of the archives below ``path``.

    Gaps have ``gap_reason`` set and nothing but their place. Without
    ``with_payload`` payloads are checked but not returned.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(path).select("path", "content"))
    return files.mapInArrow(_reader(with_payload), READ_SCHEMA)


def read_frames(spark: SparkSession, path: str, with_payload: bool = True, glob: str = "*") -> DataFrame:
    """``read_archives`` for archives whose records are separated by empty frames, as ``write_archives`` does.

    Spark's text source cuts files of any size into ranges and starts each range at
    the next separator, so a file is read by many tasks, each holding a record at a
    time. Damaged frames are salvaged; damage to a separator joins its neighbours,
    which are then salvaged together. ``offset`` counts from the separator before.
    """
    frames = (spark.read.option("lineSep", EMPTY_FRAME).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
              .text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("content")))
    return frames.mapInArrow(_reader(with_payload), READ_SCHEMA)


def _reader(with_payload: bool):
    """Rows of ``READ_SCHEMA`` for batches of (path, bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                archive, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for offset, length, found, reason in salvage(data):
                    if found is None:
                        rows.append((archive, offset, length, reason, *[None] * 7))
                        continue
                    h = found.headers
                    digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    rows.append((archive, offset, length, None, h.get("warc-type"), h.get("warc-record-id"),
                                 h.get("warc-refers-to"), h.get("warc-target-uri"), digest, found.payload_length,
                                 found.payload if with_payload else None))
                    size += len(found.block) if with_payload else 0
                    if len(rows) >= 5000 or size >= 16 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
            if rows:
                yield _batch(rows)
                rows, size = [], 0

    return run


_TYPES = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
_NAMES = [f.split()[0] for f in READ_SCHEMA.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)],
                                      names=_NAMES)


def page_number(record_id):
    """The page_id inside a record id of ours (null if it has none)."""
    return F.nullif(F.regexp_extract(record_id, f"^<{ID_PREFIX}(-?[0-9]+)>$", 1), F.lit("")).cast("long")
