"""WARC records in ZIP archives: a writer, and a reader that range-reads records without extracting anything.

Each write task packs its pages into archives ``pages-<task>-<n>-<attempt>.zip``. An archive has two *stored* (uncompressed) members:
``records.warc.gz``, the WARC/1.1 records, each its own gzip member, and ``index.cdxj``, one line per record with its
offset and length inside the member. ZIP64 fields are written where a size or offset needs them (or when forced).
The reader parses the end record, the ZIP64 end record and the central directory, finds where the stored members' data
begin, reads the index, and then reads each record by its byte range.

Of records with equal payloads of at least ``REVISIT_FROM`` bytes the one with the smallest page id is a response; the
others are revisit records that refer to it and carry its payload digest and length. Equal payloads are found by
aggregating digests, so a payload that very many pages share is combined before the shuffle.

Defined cases: null html is an empty payload; payloads under ``REVISIT_FROM`` bytes are all responses; a null url has an
empty target URI; repeated rows (same page id and payload) are all responses with that id when it is the smallest;
an empty table writes no archive and reads back no rows; other columns are not read. Files are reached through the file
system of the shared folder's URI; a retried task writes archives of its own and only the names that succeeded are read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import ship, slices, stored, table
from culvert.session import checkpoint_dir

REVISIT_FROM = 100
#: An archive is closed when its records member has reached so many bytes.
ARCHIVE_BYTES = 256 << 20
RECORDS, INDEX = "records.warc.gz", "index.cdxj"
#: Record members are read in ranges of about so many bytes.
READ_BYTES = 4 << 20
_MAX32 = 0xFFFFFFFF


# --- ZIP -------------------------------------------------------------------------------------------------------------

def zip_tail(members: list[tuple[str, int, int, int]], at: int, zip64: bool = False) -> bytes:
    """Central directory and end records of stored members (name, crc32, size, offset of the local header)."""
    out = b""
    for name, crc, size, offset in members:
        wide = zip64 or size >= _MAX32 or offset >= _MAX32
        extra = struct.pack("<HHQQQ", 1, 24, size, size, offset) if wide else b""
        s, o = (_MAX32, _MAX32) if wide else (size, offset)
        raw = name.encode()
        out += struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0x808, 0, 0, 0x21, crc, s, s, len(raw), len(extra), 0, 0, 0, 0, o) + raw + extra
    size, n = len(out), len(members)
    if zip64 or at + size >= _MAX32 or n >= 0xFFFF:
        out += struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, at)
        out += struct.pack("<4sIQI", b"PK\x06\x07", 0, at + size, 1)
        n, size, at = 0xFFFF, _MAX32, _MAX32
    return out + struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, n, n, size, at, 0)


class Archive:
    """Writes stored members one after another; sizes and checksums follow each member's data."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.members, self.zip64 = out, 0, [], zip64

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc, self.size = name, self.at, 0, 0
        raw = name.encode()
        self._put(struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0x808, 0, 0, 0x21, 0, 0, 0, len(raw), 0) + raw)

    def add(self, data: bytes) -> int:
        """Append to the open member; the data's offset inside it."""
        at = self.size
        self._put(data)
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        return at

    def end(self) -> None:
        wide = self.zip64 or self.size >= _MAX32
        self._put(struct.pack("<4sIQQ" if wide else "<4sIII", b"PK\x07\x08", self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.header))

    def close(self) -> None:
        self._put(zip_tail(self.members, self.at, self.zip64))


def directory(read, size: int) -> dict[str, tuple[int, int]]:
    """Name -> (data offset, size) of the stored members, from range reads ``read(offset, length)`` of an archive."""
    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, n, length, at, _ = struct.unpack("<4sHHHHIIH", tail[end:end + 22])
    if n == 0xFFFF or length == _MAX32 or at == _MAX32:
        sig, _, where, _ = struct.unpack("<4sIQI", read(tail_at + end - 20, 20))
        if sig == b"PK\x06\x07":
            _, _, _, _, _, _, _, n, length, at = struct.unpack("<4sQHHIIQQQQ", read(where, 56))
    raw, pos, out = read(at, length), 0, {}
    for _ in range(n):
        sig, _, _, _, method, _, _, _, packed, full, k, extra_size, comment, _, _, _, header = struct.unpack("<4sHHHHHHIIIHHHHHII", raw[pos:pos + 46])
        if sig != b"PK\x01\x02":
            raise ValueError("broken central directory")
        name = raw[pos + 46:pos + 46 + k].decode()
        extra = raw[pos + 46 + k:pos + 46 + k + extra_size]
        pos += 46 + k + extra_size + comment
        while len(extra) >= 4:
            kind, size_of = struct.unpack("<HH", extra[:4])
            if kind == 1:  # ZIP64: only the fields that are at their maximum, in this order
                wide = iter(struct.unpack(f"<{size_of // 8}Q", extra[4:4 + size_of // 8 * 8]))
                full = next(wide) if full == _MAX32 else full
                packed = next(wide) if packed == _MAX32 else packed
                header = next(wide) if header == _MAX32 else header
            extra = extra[4 + size_of:]
        if method:
            raise ValueError(f"{name} is not stored")
        local = struct.unpack("<4sHHHHHIIIHH", read(header, 30))
        out[name] = (header + 30 + local[9] + local[10], packed)
    return out


# --- WARC ------------------------------------------------------------------------------------------------------------

def record(page_id, url: str, payload: bytes, digest: str, size: int, refers_to=None) -> bytes:
    """One gzip member with a response or, when ``refers_to`` is given, a revisit record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {url.splitlines()[0] if url.splitlines() else ''}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + body + b"\r\n\r\n", 3, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[:int(headers["Content-Length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def _store(uri: str):
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    return fs, path


def _page(urn: str):
    return int(urn[10:-1]) if len(urn) > 11 else None


def digests(pages: DataFrame) -> DataFrame:
    """(page_id, digest, size, first): ``first`` is the smallest page id of the payload where it may be revisited."""
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(html.cast("binary"), 256).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    large = own.where(F.col("size") >= REVISIT_FROM)
    shared = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    return large.join(shared, "digest").where(F.col("page_id") > F.col("first")).select("page_id", "digest", "first").distinct()


def write(pages: DataFrame, folder: str, zip64: bool = False, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages to archives below ``folder`` (a URI that every executor reaches); returns (archive, bytes, records), stored."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    revisits = digests(pages)
    key = F.sha2(F.col("html").cast("binary"), 256)
    rows = rows.withColumn("digest", key).join(revisits, ["page_id", "digest"], "left").select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "first")

    def run(batches):
        fs, base = _store(folder)
        fs.create_dir(base, recursive=True)
        task, n = TaskContext.get(), 0
        archive = out = path = None
        index: list[str] = []

        def finish():
            archive.end()
            archive.begin(INDEX)
            archive.add("".join(index).encode())
            archive.end()
            archive.close()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([archive.at], pa.int64()), pa.array([len(index)], pa.int64())], ["archive", "bytes", "records"])

        for batch in batches:
            for part in slices(batch, 2):
                for page, url, html, digest, first in zip(*(c.to_pylist() for c in part.columns)):
                    if archive is None:
                        path = f"pages-{task.partitionId():06d}-{n:04d}-{task.taskAttemptId()}.zip"
                        n, index = n + 1, []
                        out = fs.open_output_stream(f"{base}/{path}")
                        archive = Archive(out, zip64)
                        archive.begin(RECORDS)
                    data = record(page, url, html, digest, len(html), first)
                    at = archive.add(data)
                    index.append(json.dumps({"page": page, "offset": at, "length": len(data)}) + "\n")
                    if archive.size >= limit:
                        yield finish()
                        archive = None
        if archive is not None:
            yield finish()

    return stored(rows.mapInArrow(run, "archive string, bytes long, records long"), "archives")


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives, read by byte range; the digest and size of a response are those of its payload as read."""

    def ranges(batches):
        fs, base = _store(folder)
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{base}/{path}") as f:
                    members = directory(lambda at, n: f.read_at(n, at), size)
                    at, n = members[INDEX]
                    lines = [json.loads(x) for x in f.read_at(n, at).decode().splitlines()]
                start = members[RECORDS][0]
                i = 0
                while i < len(lines):
                    j, total = i, 0
                    while j < len(lines) and (j == i or total + lines[j]["length"] <= READ_BYTES):
                        total += lines[j]["length"]
                        j += 1
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([start + lines[i]["offset"]], pa.int64()), pa.array([[x["length"] for x in lines[i:j]]], pa.list_(pa.int64()))], ["archive", "at", "lengths"])
                    i = j

    def records(batches):
        fs, base = _store(folder)
        for batch in batches:
            for path, at, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                got = []
                with fs.open_input_file(f"{base}/{path}") as f:
                    raw = f.read_at(sum(lengths), at)
                pos = 0
                for n in lengths:
                    h, payload = parse(raw[pos:pos + n])
                    pos += n
                    kind = h["WARC-Type"]
                    first = h.get("WARC-Refers-To")
                    digest, size = (hashlib.sha256(payload).hexdigest(), len(payload)) if kind == "response" else (h["WARC-Payload-Digest"].partition(":")[2], int(h["X-Payload-Length"]))
                    if f"sha256:{digest}" != h["WARC-Payload-Digest"]:
                        raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
                    got.append((_page(h["WARC-Record-ID"]), size, digest, kind, _page(first) if first else None, h["WARC-Target-URI"]))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    listed = archives.select("archive", "bytes").mapInArrow(ranges, "archive string, at long, lengths array<long>")
    return listed.repartition("archive", "at").mapInArrow(records, READ)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/culvert-warc-{uuid.uuid4().hex}"
    return read(write(pages, folder), folder)
