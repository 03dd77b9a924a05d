import hashlib
import io
import struct
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from ioclake.llm import warc

PAGES = "page_id long, url string, html string, refers_to string, record_type int"


def packages(pages, folder=None):
    return warc.write_archives(pages, folder=folder)


def expected(rows):
    first = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= warc.REVISIT_FROM and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, u, h in rows:
        h = (h or "").encode()
        to = first.get(h)
        to = None if to == i else to
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip_of_edge_pages(spark):
    long, accents = "x" * 200, "é" * 60
    rows = [(5, "u5", long), (3, "u3", long), (9, None, long), (3, "again", long), (1, "u", None), (2, "u", ""),
            (4, "u", "y" * 99), (6, "u", "y" * 99), (7, "a b\r\nX: y", accents), (8, "u", accents), (10, "u", "\r\n\r\n" * 40),
            (11, "u", "z" * 3_000_000), (None, "n", long), (None, "n", "w" * 150), (6, "v", long)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)
    back = warc.read_archives(packages(df))
    got = sorted((tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                  .collect()), key=str)
    assert got == expected(rows)
    payloads = {r.page_id: bytes(r.payload) for r in back.filter("record_type = 'response' and page_id is not null").collect()}
    assert payloads[11] == b"z" * 3_000_000 and payloads[1] == b"" and payloads[7] == accents.encode()
    assert warc.read_archives(packages(df.limit(0))).count() == 0


def test_packages_are_zip_files_and_split(spark, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_BYTES", 2000)
    rows = spark.range(60).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                  F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2(F.col("id").cast("string"), 256))
                                  .alias("html")).coalesce(1)
    made = packages(rows, "file://" + tempfile.mkdtemp(prefix="ioclake-warc-")).collect()
    assert len(made) > 3 and sum(m.records for m in made) == 60
    for m in made:
        data = open(m.path.removeprefix("file://"), "rb").read()
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            assert z.testzip() is None and z.namelist() == [warc.DATA, warc.INDEX]
        assert len(list(warc.read_bytes(data))) == m.records


def test_classic_directories_and_other_members():
    raw = warc._gzip(warc.record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
        z.writestr("notes.txt", "x" * 500, zipfile.ZIP_DEFLATED)
        z.writestr(warc.DATA, b"pad" + raw)
        z.writestr(warc.INDEX, '{"page": 1, "offset": 3, "length": %d}\n' % len(raw))
        z.comment = b"a comment PK"
    got = list(warc.read_bytes(buf.getvalue()))
    assert [(r["page_id"], r["payload"], r["payload_bytes"]) for r in got] == [(1, b"hello", 5)]
    assert "notes.txt" not in warc.Package(buf, len(buf.getvalue())).members


def test_members_beyond_32_bits():
    """Directory entries of a member at 5 GB are read from the ZIP64 fields."""
    class Sparse:
        def __init__(self, parts):
            self.parts, self.at = parts, 0

        def seek(self, at):
            self.at = at

        def read(self, n):
            out = bytearray(n)
            for start, data in self.parts:
                for k in range(max(start, self.at), min(start + len(data), self.at + n)):
                    out[k - self.at] = data[k - start]
            return bytes(out)

    w = warc.PackageWriter(io.BytesIO())
    w.begin(warc.DATA)
    w.write(b"abc")
    w.end()
    head = w.out.getvalue()
    shift = 5 << 30
    w.members = [(n, c, s, at + shift) for n, c, s, at in w.members]
    w.at += shift
    w.close()
    tail = w.out.getvalue()[len(head):]
    file = Sparse([(shift, head), (shift + len(head), tail)])
    p = warc.Package(file, shift + len(head) + len(tail))
    at, size = p.locate(warc.DATA)
    assert (p.range(at, size), at > shift) == (b"abc", True)


def test_damage_is_noticed():
    good = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    with pytest.raises(ValueError):
        warc.parse_record(good.replace(b"payload", b"paylaod"))
    with pytest.raises(ValueError):
        warc.Package(io.BytesIO(b"no zip" * 10), 60)
    assert struct.calcsize("<HHHHIIH") == 18
