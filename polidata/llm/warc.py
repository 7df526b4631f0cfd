"""WARC records in stored ZIP members (the WACZ layout), written and range-read by Spark tasks.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz`` holds one gzip member per
WARC record and ``indexes/index.cdxj`` one line per record with its byte range.  The reader parses the
end record, the ZIP64 records and the central directory, finds both members and reads single ranges;
nothing is unpacked to disk.  Archives lie in the shared folder, since executors differ between
writing and reading.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.llm.common import shared_folder, written

DATA_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
#: An archive is closed once its data member has so many bytes; a task goes on in a new one.
ARCHIVE_BYTES = 256 << 20
#: Records are read in ranges of about so many bytes, each by one task at a time.
RANGE_BYTES = 4 << 20

MANIFEST = "archive string, n_records long"
RANGES = "archive string, start long, stop long"
RECORDS = ("archive string, record_id string, record_type string, target_uri string, refers_to string, "
           "payload_digest string, payload_bytes long, payload binary")

# Fixed values of the WARC 1.1 and ZIP formats.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file; a name without a scheme is a mounted path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- one record -----------------------------------------------------------------------------------

def one_line(value: str | None) -> str:
    """A header value; line breaks, which would end the header, become spaces."""
    return " ".join((value or "").splitlines()).strip()


def record_bytes(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or a revisit (HTTP headers only) when refers_to names the response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    head = {"WARC-Type": "revisit" if refers_to else "response", "WARC-Record-ID": f"<{record_id}>",
            "WARC-Target-URI": one_line(uri), "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
            "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    if refers_to:
        head |= {"WARC-Refers-To": f"<{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v or k != "WARC-Target-URI")
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse_record(raw: bytes) -> dict:
    """Fields of one uncompressed record; raises ValueError when it is cut short or its digest is wrong."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    h = headers(head)
    block = rest[: int(h["content-length"])]
    if len(block) != int(h["content-length"]):
        raise ValueError(f"{h['warc-record-id']}: the block is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    kind = h["warc-type"]
    if kind == "response" and payload_digest(payload) != digest:
        raise ValueError(f"{h['warc-record-id']}: the payload does not have its digest")
    return {"record_id": h["warc-record-id"].strip("<>"), "record_type": kind,
            "target_uri": h.get("warc-target-uri"), "refers_to": h.get("warc-refers-to", "").strip("<>") or None,
            "payload_digest": digest, "payload": payload if kind == "response" else None,
            "payload_bytes": len(payload) if kind == "response" else int(headers(http).get("content-length", 0))}


# ---- reading ZIP directories and ranges --------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    header_offset: int


def directory(f, size: int) -> list[Member]:
    """Members of a ZIP file from its central directory; the ZIP64 records win where they exist."""
    tail_at = max(0, size - 22 - 65_535 - 20)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    end = tail.rfind(END)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(END, 0, end)
    if end < 0:
        raise ValueError("no end record: not a ZIP file, or cut short")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20: end - 16] == LOCATOR64:
        f.seek(struct.unpack_from("<Q", tail, end - 12)[0])
        record = f.read(56)
        if record[:4] != END64:
            raise ValueError("the ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    f.seek(start)
    data, at, members = f.read(length), 0, []
    for _ in range(count):
        if data[at: at + 4] != ENTRY:
            raise ValueError("the central directory is damaged")
        method, _, _, _, packed, plain, n_name, n_extra, n_note = struct.unpack_from("<HHHIIIHHH", data, at + 10)
        offset = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46: at + 46 + n_name].decode("utf-8")
        extra, at = data[at + 46 + n_name: at + 46 + n_name + n_extra], at + 46 + n_name + n_extra + n_note
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # 64-bit values, in this order, of the fields that are full
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + n:]
        members.append(Member(name, method, packed, offset))
    return members


def data_start(f, member: Member) -> int:
    """Place of a stored member's first byte, from its local header."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    f.seek(member.header_offset)
    local = f.read(30)
    if local[:4] != LOCAL:
        raise ValueError(f"{member.name}: no local header")
    return member.header_offset + 30 + sum(struct.unpack_from("<HH", local, 26))


def index_ranges(f, size: int, range_bytes: int = RANGE_BYTES) -> Iterator[tuple[int, int]]:
    """Byte ranges of the archive with whole records, each about range_bytes long."""
    members = {m.name: m for m in directory(f, size)}
    base, index = data_start(f, members[DATA_MEMBER]), members[INDEX_MEMBER]
    f.seek(data_start(f, index))
    start = stop = None
    for line in f.read(index.size).splitlines():
        at = json.loads(line.split(b" ", 2)[2])
        lo = base + int(at["offset"])
        hi = lo + int(at["length"])
        if start is None:
            start = lo
        elif hi - start > range_bytes:
            yield start, stop
            start = lo
        stop = hi
    if start is not None:
        yield start, stop


def records_in(data: bytes) -> Iterator[dict]:
    """The records of a range: gzip members, one after another."""
    while data:
        unzip = zlib.decompressobj(wbits=31)
        raw = unzip.decompress(data) + unzip.flush()
        yield parse_record(raw)
        data = unzip.unused_data


# ---- Spark jobs -----------------------------------------------------------------------------------------

class ArchiveWriter:
    """One archive at a time; finished ones are listed in `done` as (path, number of records)."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.folder = open_folder(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.limit, self.zip, self.done = limit, None, []

    def add(self, key: str, uri: str, record: bytes) -> None:
        if self.zip is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.wacz"
            self.out = self.fs.open_output_stream(self.path)
            self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
            self.member = self.zip.open(DATA_MEMBER, "w", force_zip64=True)
            self.offset, self.index = 0, []
        pack = zlib.compressobj(wbits=31)
        data = pack.compress(record) + pack.flush()
        self.member.write(data)
        at = json.dumps({"offset": self.offset, "length": len(data), "record": key})
        self.index.append(f"{one_line(uri).replace(' ', '%20') or '-'} - {at}\n".encode())
        self.offset += len(data)
        if self.offset >= self.limit:
            self.close()

    def close(self) -> None:
        if self.zip is not None:
            self.member.close()
            self.zip.writestr(INDEX_MEMBER, b"".join(self.index))
            self.zip.close()
            self.out.close()
            self.done.append((self.path, len(self.index)))
            self.zip = None


def write_archives(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a WARC record per row of pages(page_id, url, html); returns the manifest (archive, n_records).

    Of the rows with one payload of at least min_revisit_bytes, that with the smallest page_id becomes a
    response and the others revisits.  A NULL html is an empty payload and a NULL url gives no target.
    Rows that repeat the smallest id are responses too; a NULL id is larger than any other, and if a
    payload has only NULL ids its rows are responses.  An empty table gives no archive.  Other columns
    are not read.  The names of archives are new for every attempt of a task, and the manifest lists
    those of the attempt that Spark committed, so a lost executor leaves nothing that is read.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    first = rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"))
    refers = F.when((F.length("payload") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")),
                    F.col("first_id"))
    rows = rows.join(first, "sha1").select("page_id", "url", "payload", refers.alias("refers_to"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, archive_bytes)
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                key = f"urn:page:{page_id}"
                writer.add(key, url, record_bytes(key, url, payload, None if refers_to is None else f"urn:page:{refers_to}"))
        writer.close()
        if writer.done:
            paths, counts = zip(*writer.done)
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], ["archive", "n_records"])

    scheme = folder.split("://")[0] if "://" in folder and not folder.startswith("file:") else None
    manifest = rows.mapInArrow(write, MANIFEST)
    if scheme:
        manifest = manifest.withColumn("archive", F.concat(F.lit(f"{scheme}://"), "archive"))
    return written(manifest, "warc-manifest")


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the listed archives (columns RECORDS), read by byte range; payload is NULL for revisits.

    The ranges are dealt to tasks anew, so one large archive is read by many.  A damaged archive or
    record raises; nothing is skipped.
    """
    def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = open_folder(name)
                with fs.open_input_file(path) as f:
                    found = list(index_ranges(f, f.size(), range_bytes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array([a for a, _ in found], pa.int64()),
                     pa.array([b for _, b in found], pa.int64())], ["archive", "start", "stop"])

    fields = [f.strip().split()[0] for f in RECORDS.split(",")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(f, kinds.get(f, pa.string())) for f in fields])

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                fs, path = open_folder(name)
                with fs.open_input_file(path) as f:
                    f.seek(start)
                    data = f.read(stop - start)
                yield pa.RecordBatch.from_pylist([{"archive": name} | r for r in records_in(data)], schema)

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = manifest.select("archive").repartition(tasks).mapInArrow(ranges, RANGES)
    return parts.repartition(tasks).mapInArrow(records, RECORDS)


def page_records(pages: DataFrame) -> DataFrame:
    """pages written to archives and read back: one digest row per page."""
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) AS BIGINT)")
    return read_archives(write_archives(pages)).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))
