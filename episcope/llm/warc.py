"""WARC archives: a writer with revisit records and a splittable reader.

Each record is one gzip member, so an archive is a chain of members.  The reader cuts every
archive into byte ranges; a task scans its range for the gzip magic, takes the first place
where a member decodes to a WARC record head, and from there follows the chain.  It owns the
records that start inside its range and reads past the range's end to finish the last one, so
every record is read once whatever the range size.

Of records with equal payloads (SHA-1) of at least ``revisit_bytes`` bytes, the one with the
smallest key is written as a response, the others as revisits that name it.  Payloads below
that size are always responses, and so are rows without a key and rows that repeat the
smallest key.  A null payload is empty; a null url is left out of the record; control
characters and spaces in a url are percent-encoded; an empty table gives no archives; only
the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episcope.llm.common import cut, open_fs, partitions_of, write_whole

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"
RECORD_ID = "<urn:x-page:{}>"

FILES = "path string, records long, bytes long"
RECORDS = ("key long, url string, record_type string, refers_to long, payload_digest string, "
           "payload_bytes long, payload binary, path string, offset long")


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def encode_record(key, url, payload: bytes, refers_to, date: str) -> bytes:
    """The uncompressed bytes of one record (a revisit if ``refers_to`` is given)."""
    digest = payload_digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [VERSION.decode(), f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {RECORD_ID.format('' if key is None else key)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean_url(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {RECORD_ID.format(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
               revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one archive per task below ``folder``; returns the archives (path, records, bytes)."""
    src = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"),
                       F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    src = src.withColumn("sha", F.sha1("payload"))
    # only payloads that occur again need a partner: one small row each
    first = pages.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("p")) \
        .filter(F.octet_length("p") >= revisit_bytes).groupBy(F.sha1("p").alias("first_sha")) \
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null")
    rows = src.join(first, F.col("sha") == F.col("first_sha"), "left") \
        .select("key", "url", "payload", F.when(F.col("key") > F.col("first"), F.col("first")).alias("refers_to"))

    def write(batches):
        n = 0

        def members():
            nonlocal n
            for b in batches:
                for k, u, p, r in zip(*(c.to_pylist() for c in b.columns)):
                    n += 1
                    yield gzip_member(encode_record(k, u, p, r, date))

        body = members()
        start = next(body, None)
        if start is None:
            return
        from itertools import chain
        path = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        size = write_whole(path, chain([start], body))
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())],
                                         names=["path", "records", "bytes"])

    return cut(rows.mapInArrow(write, FILES), "archives")


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the archives below a folder of any store that Spark reads."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true") \
        .load(folder).select("path", F.col("length").alias("bytes"))


class _Source:
    """Forward reads from one place of a file, in blocks."""

    def __init__(self, f, at: int, block: int = 1 << 18):
        self.f, self.size, self.next, self.block = f, f.size(), at, block

    def more(self) -> bytes:
        got = bytes(self.f.read_at(min(self.block, self.size - self.next), self.next)) if self.next < self.size else b""
        self.next += len(got)
        return got


def _heads_record(f, at: int, size: int) -> bool:
    """Whether a gzip member starts at ``at`` whose data begin as a WARC record."""
    d, data, place = zlib.decompressobj(31), b"", at
    try:
        while len(data) < len(VERSION) and place < size:
            raw = bytes(f.read_at(min(512, size - place), place))
            place += len(raw)
            data += d.decompress(raw, len(VERSION))
        return data[:5] == VERSION[:5]
    except zlib.error:
        return False


def find_start(f, start: int, end: int) -> int | None:
    """The first record start in [start, end)."""
    size, at, block = f.size(), start, 1 << 18
    while at < end:
        raw = bytes(f.read_at(min(block + 2, size - at), at))
        i = raw.find(GZIP_MAGIC)
        while i >= 0 and at + i < end:
            if _heads_record(f, at + i, size):
                return at + i
            i = raw.find(GZIP_MAGIC, i + 1)
        if len(raw) <= 2:
            return None
        at += min(block, len(raw) - 2) if len(raw) == block + 2 else len(raw)
    return None


def members(f, start: int, end: int):
    """(offset, data) of the gzip members that start in [start, end), ``start`` being one."""
    src, at, buf = _Source(f, start), start, b""
    while at < end:
        buf = buf or src.more()
        if not buf:
            return
        d, parts, used = zlib.decompressobj(31), [], 0
        while not d.eof:
            if not buf:
                buf = src.more()
                if not buf:
                    raise ValueError(f"archive ends inside a record at {at}")
            parts.append(d.decompress(buf))
            used += len(buf) - len(d.unused_data)
            buf = d.unused_data
        yield at, b"".join(parts)
        at += used


def parse_record(data: bytes) -> dict | None:
    """Fields of a response or revisit record; None for other record types."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}

    def key_of(value):
        m = re.fullmatch(r"<urn:x-page:(-?\d+)>", value or "")
        return int(m[1]) if m else None

    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and digest and payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return {"key": key_of(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": key_of(fields.get("warc-refers-to")), "payload_digest": digest,
            "payload_bytes": len(payload) if kind == "response" else int(named.get("content-length", 0)),
            "payload": payload if kind == "response" else None}


def read_warc(archives: DataFrame, split_bytes: int = 32 << 20) -> DataFrame:
    """Records of ``archives`` (path, bytes): key, url, record_type, refers_to, payload_digest,
    payload_bytes (of the full payload, also for revisits), payload, path, offset."""
    ranges = archives.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)),
                                                          F.lit(split_bytes).cast("long"))).alias("start"))
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, kinds)], names=names)

    def read(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, p = open_fs(path)
                rows, held = [], 0
                with fs.open_input_file(p) as f:
                    end = min(start + split_bytes, f.size())
                    first = find_start(f, start, end)
                    for at, data in members(f, first, end) if first is not None else ():
                        r = parse_record(data)
                        if r is None:
                            continue
                        rows.append(r | {"path": path, "offset": at})
                        held += len(data)
                        if held > 8 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return ranges.repartition(partitions_of(archives.sparkSession), "path", "start").mapInArrow(read, RECORDS)
