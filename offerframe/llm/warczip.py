"""WARC records in ZIP packages, written and range-read with Spark.

An archive is one ZIP file per task.  Its members are stored, not compressed:
`archive/data-NNNNN.warc.gz` (WARC records, each a gzip member of its own) and
`indexes/index.cdxj` (one JSON line per record: page, member, offset, length).
So one record is one byte range of the archive.

Writing: a record's payload is repeated in no other record; of equal payloads
the largest page_id's record is the response and the others revisit it.  Who
refers to whom is found on (page_id, SHA-1) rows; the pages themselves are
shuffled once.  Archives go through Spark's own file writer (one row is one
ZIP entry; the line feed it puts after a row is a gap between entries, and the
last one the archive's comment), so they land in any store Spark writes to,
and a task that is lost or run twice leaves no half archive.

Reading: archives are listed without being read; a task reads an archive's
end record, ZIP64 locator and end record, central directory, and the index
member; records then are read by byte ranges (neighbours together), dealt out
by archive and range.  Nothing is extracted or copied.

Defined results: NULL html is an empty payload; a NULL url leaves the target
out; NULL page_ids are written as records without a number, never chosen over
a numbered one; a page row that repeats gives equal records, and rows of the
chosen page_id are all responses.  Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zlib
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

INDEX = "indexes/index.cdxj"
# Fixed values of the ZIP format.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_DATE = "2024-01-01T00:00:00Z"  # a stored page has no fetch time


@dataclass(frozen=True)
class Params:
    member_bytes: int = 4 << 20   # a member is closed when it reaches this
    range_bytes: int = 4 << 20    # neighbouring records are read together up to this
    zip64: bool = True            # write ZIP64 records always, not only where a field overflows
    least_payload: int = 0        # shorter payloads are never revisits


# --- records ----------------------------------------------------------------------------

def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header, not the payload."""
    name = lambda i: f"<urn:page:{'' if i is None else i}:{digest}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head += [f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {name(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of one record."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    number = lambda urn: int(n) if (n := urn.strip("<>").split(":")[2]) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload), digest_of(payload)) != (size, digest):
        raise ValueError("a payload differs from its digest")
    refers = number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
    return number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers


# --- ZIP writing ------------------------------------------------------------------------

class Package:
    """Builds a ZIP entry by entry; every chunk returned is followed by one gap byte."""

    def __init__(self, zip64: bool):
        self.zip64, self.at, self.entries = zip64, 0, []

    def entry(self, name: str, data: bytes) -> bytes:
        crc, raw = zlib.crc32(data), name.encode()
        out = struct.pack("<4sHHHHHIIIHH", _LOCAL, 45, 0x800, 0, 0, 0x21, crc, len(data), len(data), len(raw), 0) + raw + data
        self.entries.append((raw, crc, len(data), self.at))
        self.at += len(out) + 1
        return out

    def end(self) -> bytes:
        """Central directory, ZIP64 records and end record, without the one byte of the comment."""
        out = bytearray()
        for raw, crc, size, at in self.entries:
            wide = self.zip64 or at >= _FULL32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at) if wide else b""
            shown = (_FULL32, _FULL32, _FULL32) if wide else (size, size, at)
            out += struct.pack("<4sHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x800, 0, 0, 0x21, crc, shown[0], shown[1], len(raw),
                               len(extra), 0, 0, 0, 0, shown[2]) + raw + extra
        size, count = len(out), len(self.entries)
        wide = self.zip64 or count >= _FULL16 or self.at >= _FULL32
        if wide:
            out += struct.pack("<4sQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, count, count, size, self.at)
            out += struct.pack("<4sIQI", _LOCATOR64, 0, self.at + size, 1)
        shown = (_FULL16, _FULL32, _FULL32) if wide else (count, size, self.at)
        return bytes(out + struct.pack("<4sHHHHIIH", _END, 0, 0, shown[0], shown[0], shown[1], shown[2], 1))


def _write_side(p: Params):
    def run(batches):
        package, index, member, size, number = Package(p.zip64), [], [], 0, 0
        row = lambda data: pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

        def close():
            return row(package.entry(f"archive/data-{number:05d}.warc.gz", b"".join(member)))

        for batch in batches:
            pages, refs, revisits = (batch.column(c).to_pylist() for c in ("page_id", "refers_to", "revisit"))
            urls, htmls = batch.column("url"), batch.column("html").cast(pa.binary())
            for i, page in enumerate(pages):
                payload = htmls[i].as_py() or b""
                raw = gzip.compress(record(page, urls[i].as_py(), payload, digest_of(payload), refs[i], revisits[i]), 4, mtime=0)
                index.append(json.dumps({"page": page, "member": number, "offset": size, "length": len(raw)}))
                member.append(raw)
                size += len(raw)
                if size >= p.member_bytes:
                    yield close()
                    member, size, number = [], 0, number + 1
        if member:
            yield close()
        if index:
            yield row(package.entry(INDEX, "\n".join(index).encode()))
            yield row(package.end())

    return run


def write_archives(pages: DataFrame, path: str, params: Params = Params(), id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> None:
    """One WARC record per row of `pages`, in ZIP archives below `path`."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    sha = F.sha1(F.col("html").cast("binary")).alias("sha")
    narrow = rows.select("page_id", sha, F.octet_length("html").alias("size"))
    chosen = (narrow.where(F.col("size") >= params.least_payload).groupBy("sha")
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    refers = (narrow.join(chosen, "sha").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
              .select(F.col("page_id").alias("r_page"), F.col("sha").alias("r_sha"), "refers_to").distinct())
    both = (rows.withColumn("sha", sha)
            .join(refers, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("sha") == F.col("r_sha")), "left")
            .select("page_id", "url", "html", "refers_to", F.col("refers_to").isNotNull().alias("revisit")))
    # Rows are raw bytes: the text writer writes a string's bytes as they are.
    both.mapInArrow(_write_side(params), "value binary").select(F.col("value").cast("string")).write.text(path)


# --- ZIP reading ------------------------------------------------------------------------

class Ranges:
    """Byte ranges of one file in any store pyarrow reaches."""

    def __init__(self, path: str):
        from pyarrow import fs

        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]
        store, inside = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        self.file = store.open_input_file(inside)
        self.size = self.file.size()

    def read(self, start: int, length: int) -> bytes:
        out = self.file.read_at(length, start)
        if len(out) != length:
            raise ValueError("the archive is cut short")
        return out


def directory(ranges: Ranges) -> dict[str, tuple[int, int]]:
    """Members of an archive: name -> (start of the local header, size), from the central directory."""
    tail_size = min(ranges.size, 22 + 20 + 65535)
    tail = ranges.read(ranges.size - tail_size, tail_size)
    end = tail.rfind(_END)
    ends = lambda at: at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)
    while end >= 0 and not ends(end):
        end = tail.rfind(_END, 0, end)  # those bytes were part of a comment
    if end < 0:
        raise ValueError("no end record")
    count, size, at = struct.unpack_from("<HII", tail, end + 10)
    if _FULL16 == count or _FULL32 in (size, at):
        kind, _, at64, _ = struct.unpack_from("<4sIQI", tail, end - 20)
        if kind != _LOCATOR64:
            raise ValueError("no ZIP64 locator")
        kind, *_, count, size, at = struct.unpack("<4sQHHIIQQQQ", ranges.read(at64, 56))
        if kind != _END64:
            raise ValueError("no ZIP64 end record")
    raw, members, place = ranges.read(at, size), {}, 0
    for _ in range(count):
        (kind, _, _, _, method, _, _, _, packed, full, name_len, extra_len, comment_len, _, _, _,
         start) = struct.unpack_from("<4sHHHHHHIIIHHHHHII", raw, place)
        if kind != _CENTRAL or method != 0:
            raise ValueError("a member is not stored")
        name = raw[place + 46:place + 46 + name_len].decode()
        extra, stop = place + 46 + name_len, place + 46 + name_len + extra_len
        while extra + 4 <= stop:
            tag, length = struct.unpack_from("<HH", raw, extra)
            if tag == 1:  # 64-bit values of the fields that are full, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", raw, extra + 4))
                full, packed, start = (next(wide) if v == _FULL32 else v for v in (full, packed, start))
            extra += 4 + length
        members[name] = (start, packed)
        place += 46 + name_len + extra_len + comment_len
    return members


def data_start(ranges: Ranges, header: int) -> int:
    """First byte of a member's data."""
    raw = ranges.read(header, 30)
    if raw[:4] != _LOCAL:
        raise ValueError("no local header")
    return header + 30 + sum(struct.unpack_from("<HH", raw, 26))


_PLACE = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64())])


def _locate(batches):
    for batch in batches:
        for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            if not length:
                continue
            ranges = Ranges(path)
            members = directory(ranges)
            starts = {int(n[13:18]): data_start(ranges, at) for n, (at, _) in members.items() if n.startswith("archive/data-")}
            at, size = members[INDEX]
            lines = ranges.read(data_start(ranges, at), size).decode().split("\n")
            for k in range(0, len(lines), 20_000):
                found = [json.loads(x) for x in lines[k:k + 20_000]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found)), pa.array([starts[f["member"]] + f["offset"] for f in found], pa.int64()),
                     pa.array([f["length"] for f in found], pa.int64())], schema=_PLACE)


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def _read_side(p: Params):
    def run(batches):
        path, ranges = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "start", "length"))))
            out, k = [], 0
            while k < len(rows):
                last = k
                while (last + 1 < len(rows) and rows[last + 1][0] == rows[k][0] and rows[last + 1][1] >= rows[last][1]
                       and rows[last + 1][1] + rows[last + 1][2] - rows[k][1] <= p.range_bytes):
                    last += 1
                if rows[k][0] != path:
                    path, ranges = rows[k][0], Ranges(rows[k][0])
                base = rows[k][1]
                raw = ranges.read(base, rows[last][1] + rows[last][2] - base)
                out += [parse_record(gzip.decompress(raw[s - base:s - base + n])) for _, s, n in rows[k:last + 1]]
                k = last + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _READ)], schema=_READ)

    return run


def read_archives(spark: SparkSession, path: str, params: Params = Params()) -> DataFrame:
    """One row per record of the archives below `path`: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    archives = spark.read.format("binaryFile").load(path).select("path", "length")  # listed, not read
    places = archives.mapInArrow(_locate, "archive string, start long, length long")
    part = F.floor(F.col("start") / F.lit(4 * params.range_bytes))
    dealt = places.repartition("archive", part).sortWithinPartitions("archive", "start")
    return dealt.mapInArrow(_read_side(params), "page_id long, payload_bytes long, payload_digest string, "
                                                "record_type string, refers_to long")


def through_archives(pages: DataFrame, params: Params = Params()) -> DataFrame:
    """Write `pages` to new archives in the shared folder and read them back."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, params)
    return read_archives(pages.sparkSession, path, params)
