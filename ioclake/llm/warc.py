"""WARC archives in ZIP packages: written, then read by range.

A package holds two stored (uncompressed) members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.jsonl`` with offset and length of
each record.  Packages always carry ZIP64 directories, so neither size nor count
is limited to 32 bits.  The reader looks only at the end of a package for the
directory (the ZIP64 one if its locator is there, else the classic one), finds
the members' local headers, then reads single records by range; nothing is
extracted.

Of records with equal payloads of at least ``REVISIT_FROM`` bytes the one with
the smallest id is the response and the others revisit it.

Tasks write through pyarrow's file systems (local paths, HDFS, object stores),
to a name of their own per attempt; only packages that the finished job lists are
read, so a lost executor or a second attempt leaves no half or double record.

Defined results: null html is an empty payload; rows that repeat the smallest
id of a payload are all responses; rows with a null id are written and refer to
the smallest known id of their payload, or are responses if none is known; extra
columns are ignored; an empty table writes no package.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake.llm.common import shared_dir

REVISIT_FROM = 100
#: a package is closed beyond this many bytes; records read at once
PACKAGE_BYTES, AT_ONCE = 64 << 20, 256
LEVEL = 3
DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"

# fixed values of the ZIP format: signatures, "see ZIP64", the ZIP64 extra field
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
SEE64, EXTRA64 = 0xFFFFFFFF, 0x0001


def file_system(url: str):
    """(pyarrow file system, path) of a URL or absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(url) if "://" in url or url.startswith("file:") else (fs.LocalFileSystem(), url)


# ------------------------------------------------------------------ records

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record.  A revisit holds the HTTP header only; its
    Content-Length still tells the payload's size."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (b"" if refers_to is not None else payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(url.split()))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if _}


def _page(urn: str | None) -> int | None:
    number = (urn or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def parse_record(raw: bytes) -> dict:
    """Fields of one record; the payload of a response is read in full and
    its digest computed anew, a revisit gives what its headers tell."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = _fields(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(_fields(http)["content-length"])
    digest = warc["warc-payload-digest"].removeprefix("sha256:")
    response = warc["warc-type"] == "response"
    if response and (len(payload) != told or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {warc['warc-record-id']}")
    return {"page_id": _page(warc["warc-record-id"]), "url": warc.get("warc-target-uri"),
            "payload": payload if response else None, "payload_bytes": told, "payload_digest": digest,
            "record_type": warc["warc-type"], "refers_to": _page(warc.get("warc-refers-to"))}


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# ----------------------------------------------------------------- packages

class PackageWriter:
    """Streams stored members into ``out``; sizes follow in data descriptors."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.head, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", EXTRA64, 16, 0, 0)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 33, 0, SEE64, SEE64, len(self.name), len(extra))
                  + self.name + extra)

    def write(self, data: bytes) -> None:
        self._put(data)
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)

    def end(self) -> None:
        self._put(b"PK\x07\x08" + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.head))

    def close(self) -> None:
        start = self.at
        for name, crc, size, head in self.members:
            extra = struct.pack("<HHQQQ", EXTRA64, 24, size, size, head)
            self._put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, 33, crc, SEE64, SEE64, len(name),
                                            len(extra), 0, 0, 0, 0, SEE64) + name + extra)
        size, n, end64 = self.at - start, len(self.members), self.at
        self._put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
        self._put(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        self._put(END + struct.pack("<HHHHIIH", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), SEE64, SEE64, 0))


class Package:
    """Directory of a ZIP package over a seekable file of known size."""

    def __init__(self, file, size: int):
        self.file = file
        tail = self.range(max(0, size - 65557), min(size, 65557))
        at = tail.rfind(END)
        if at < 0:
            raise ValueError("no ZIP directory")
        n, length, start = struct.unpack("<HII", tail[at + 10:at + 20])
        where = max(0, size - 65557) + at - 20
        locator = self.range(where, 20) if where >= 0 else b""
        if locator.startswith(LOCATOR64):
            end64 = self.range(struct.unpack("<Q", locator[8:16])[0], 56)
            if not end64.startswith(END64):
                raise ValueError("no ZIP64 directory where its locator points")
            n, length, start = struct.unpack("<QQQ", end64[32:56])
        self.members = dict(self._entries(self.range(start, length), n))

    def range(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)

    def _entries(self, data: bytes, n: int) -> Iterator[tuple[str, tuple[int, int]]]:
        at = 0
        for _ in range(n):
            if data[at:at + 4] != CENTRAL:
                raise ValueError("damaged ZIP directory")
            method, = struct.unpack("<H", data[at + 10:at + 12])
            packed, size, n_name, n_extra, n_note = struct.unpack("<IIHHH", data[at + 20:at + 34])
            head, = struct.unpack("<I", data[at + 42:at + 46])
            name = data[at + 46:at + 46 + n_name].decode()
            extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
            while len(extra) >= 4:
                kind, length = struct.unpack("<HH", extra[:4])
                if kind == EXTRA64:
                    wide = iter(struct.unpack(f"<{length // 8}Q", extra[4:4 + length // 8 * 8]))
                    size = next(wide) if size == SEE64 else size
                    packed = next(wide) if packed == SEE64 else packed
                    head = next(wide) if head == SEE64 else head
                extra = extra[4 + length:]
            if method == 0:  # only stored members can be read by range
                yield name, (head, size)
            at += 46 + n_name + n_extra + n_note

    def locate(self, name: str) -> tuple[int, int]:
        """(first byte, bytes) of a stored member's data."""
        head, size = self.members[name]
        local = self.range(head, 30)
        if not local.startswith(LOCAL):
            raise ValueError("damaged ZIP member")
        n_name, n_extra = struct.unpack("<HH", local[26:30])
        return head + 30 + n_name + n_extra, size

    def index(self) -> Iterator[dict]:
        start, size = self.locate(INDEX)
        yield from (json.loads(x) for x in self.range(start, size).splitlines())

    def record(self, data_at: int, entry: dict) -> dict:
        return parse_record(zlib.decompress(self.range(data_at + entry["offset"], entry["length"]), 31))


# -------------------------------------------------------------------- Spark

def _writing(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        out = package = path = None
        index: list[bytes] = []

        def close() -> pa.RecordBatch:
            package.end()
            package.begin(INDEX)
            for at in range(0, len(index), 1000):
                package.write(b"".join(index[at:at + 1000]))
            package.end()
            package.close()
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [package.at], "records": [len(index)]})

        for b in batches:
            for page_id, url, html, refers_to in zip(*b.columns, strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.wacz"
                    path = f"{folder}/{name}"
                    out = system.open_output_stream(str(PurePosixPath(root) / name))
                    package, index = PackageWriter(out), []
                    package.begin(DATA)
                payload = html.as_py() or b""
                raw = _gzip(record(page_id.as_py(), url.as_py(), payload, hashlib.sha256(payload).hexdigest(),
                                   refers_to.as_py()))
                index.append(json.dumps({"page": page_id.as_py(), "offset": package.size, "length": len(raw)})
                             .encode() + b"\n")
                package.write(raw)
                if package.size >= PACKAGE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   folder: str | None = None) -> DataFrame:
    """Writes all pages and returns the packages (path, bytes, records)."""
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark).rstrip('/')}/ioclake-warc-{uuid.uuid4().hex}"
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"))
    long = p.filter(F.octet_length("html") >= REVISIT_FROM).select("id", F.sha2("html", 256).alias("digest"))
    first = long.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                       F.count(F.lit(1)).alias("n"), F.count("id").alias("known")) \
        .filter("known < n and known > 0 or first < last").select("digest", "first")
    # only ids travel for the digests; the html moves once, by id
    again = long.join(first, "digest").filter("id is null or id <> first").select("id", "digest", "first").distinct()
    known = again.filter("id is not null")
    keyed = p.filter("id is not null").join(known.select("id", F.struct("digest", "first").alias("r"))
                                            .groupBy("id").agg(F.collect_list("r").alias("rs")), "id", "left")
    refers = F.filter("rs", lambda r: r.digest == F.sha2("html", 256))
    rows = keyed.select("id", "url", "html", F.when(F.col("rs").isNotNull(), F.try_element_at(refers, F.lit(1)).first)
                        .alias("refers_to"))
    nulls = p.filter("id is null").withColumn("digest", F.sha2("html", 256)) \
        .join(again.filter("id is null").select("digest", "first"), "digest", "left") \
        .select("id", "url", "html", F.col("first").alias("refers_to"))
    made = rows.union(nulls).mapInArrow(_writing(folder), "path string, bytes long, records long")
    made.write.parquet(f"{folder}/packages")
    return spark.read.schema("path string, bytes long, records long").parquet(f"{folder}/packages")


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                      ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                      ("record_type", pa.string()), ("refers_to", pa.int64())])
    for b in batches:
        for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            system, root = file_system(path)
            with system.open_input_file(root) as file:
                package = Package(file, size)
                data_at, _ = package.locate(DATA)
                rows: list[dict] = []
                for entry in package.index():
                    rows.append(package.record(data_at, entry))
                    if len(rows) >= AT_ONCE:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)


def read_archives(packages: DataFrame) -> DataFrame:
    """page_id, url, payload (null for a revisit), payload_bytes,
    payload_digest, record_type, refers_to of every record."""
    spread = packages.select("path", "bytes").repartition(
        max(1, packages.sparkSession.sparkContext.defaultParallelism * 2))
    return spread.mapInArrow(_reading, "page_id long, url string, payload binary, payload_bytes long, "
                                       "payload_digest string, record_type string, refers_to long")


def read_bytes(data: bytes) -> Iterator[dict]:
    """All records of one package in memory."""
    package = Package(io.BytesIO(data), len(data))
    data_at, _ = package.locate(DATA)
    return (package.record(data_at, e) for e in package.index())
