import io
import struct
import zipfile
from collections import defaultdict

import pyarrow as pa
import pytest

from footfall.llm import warczip

PAGES = "page_id long, url string, html string"
ROWS = [
    (1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u v\r\nEvil: 1", ""), (5, "http://e", "é\r\n\r\n<p>" * 9),
    (6, "http://f", "long " * 200_000), (7, "http://g", "long " * 200_000), (None, "http://n", "x"), (8, "z", "z"), (8, "z", "z"),
    (None, "q", "only"),
]


def brute(rows, min_bytes=0):
    groups = defaultdict(list)
    for i, _, h in rows:
        groups[h or ""].append(i)
    out = []
    for i, _, h in rows:
        ids = [x for x in groups[h or ""] if x is not None]
        last = max(ids) if ids else None
        body = (h or "").encode()
        revisit = i != last and len(body) >= min_bytes
        out.append((i, len(body), warczip.payload_digest(body), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 2])
def test_round_trip(ready, min_bytes):
    pages = ready.createDataFrame(ROWS, PAGES).selectExpr("*", "1 AS page", "2 AS first", "3 AS payload").repartition(3)
    packages = warczip.write_packages(pages, min_bytes=min_bytes)
    rows = warczip.read_packages(packages, payloads=True).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert sorted(got, key=repr) == brute(ROWS, min_bytes)
    bodies = {(h or "").encode() for *_, h in ROWS}
    assert {bytes(r["payload"]) for r in rows if r["record_type"] == "response"} == bodies
    assert sum(r["records"] for r in packages.collect()) == len(ROWS)


def test_records_by_place(tmp_path):
    uri = f"file://{tmp_path}/p.wacz"
    p = warczip.Package(uri)
    for i in range(5):
        p.add((i, f"http://{i}", b"body %d" % i, None, False))
    assert p.close() == 5
    with warczip.opened(uri) as source:
        archive = warczip.Archive(source)
        lines = list(archive.index())
        assert [archive.read(x["offset"], x["length"])["page_id"] for x in reversed(lines)] == [4, 3, 2, 1, 0]
        assert [r["payload"] for r in archive.records()] == [b"body %d" % i for i in range(5)]


def test_empty(ready):
    assert warczip.read_packages(warczip.write_packages(ready.createDataFrame([], PAGES))).count() == 0


def zip64_of(raw: bytes) -> bytes:
    """The same archive with its directory only in the 64-bit records."""
    end = raw.rfind(b"PK\x05\x06")
    entries, size, place = struct.unpack("<HII", raw[end + 10 : end + 20])
    directory, out = raw[place : place + size], b""
    while directory:
        n, extra, note = struct.unpack("<HHH", directory[28:34])
        packed, full = struct.unpack("<II", directory[20:28])
        local, = struct.unpack("<I", directory[42:46])
        more = struct.pack("<HHQQQ", 1, 24, full, packed, local)
        more = struct.pack("<HHI", 0x7075, 4, 0) + more  # another field first
        out += directory[:20] + struct.pack("<IIHH", 0xFFFFFFFF, 0xFFFFFFFF, n, len(more)) + directory[32:42]
        out += struct.pack("<I", 0xFFFFFFFF) + directory[46 : 46 + n] + more + directory[46 + n + extra : 46 + n + extra + note]
        directory = directory[46 + n + extra + note :]
    record = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, entries, entries, len(out), place)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, place + len(out), 1)
    tail = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 5) + b"hello"
    return raw[:place] + out + record + locator + tail


def test_zip64_directory():
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", "first")
        z.writestr(warczip.INDEX, "")
        z.writestr("packed", "x" * 100, compress_type=zipfile.ZIP_DEFLATED)
    for raw in (plain.getvalue(), zip64_of(plain.getvalue())):
        archive = warczip.Archive(pa.BufferReader(raw))
        assert set(archive.members) == {"a.txt", warczip.INDEX}
        place, size = archive.members["a.txt"]
        assert raw[place : place + size] == b"first"


@pytest.mark.parametrize("raw", [b"", b"no archive at all", b"PK\x05\x06" + b"\xff" * 18])
def test_damage_is_reported(raw):
    with pytest.raises(ValueError):
        warczip.Archive(pa.BufferReader(raw))
