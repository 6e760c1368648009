"""Web archives packaged as ZIP files, written and read in ranges.

A package holds stored members: ``archive/data.warc.gz`` with one gzip member
per record, and ``indexes/index.cdxj`` with a line of place, length and digest
per record.  The reader looks at the end of the file for the central directory
(also in its ZIP64 form), finds the members there and reads records by place
and length; nothing is unpacked to disk.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with
the largest id is a response; the others are revisits that refer to it.  Null
payloads are empty ones, a null id is smaller than any other, and rows that
repeat the largest id are all responses.  An empty table makes no package.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import quoted
from footfall.llm.files import new_file, opened
from footfall.session import workspace

PACKAGE_BYTES = 256 << 20
RANGE_BYTES = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> tuple[bytes, str]:
    """A WARC record and its payload digest."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        "WARC-Target-URI: " + " ".join((url or "").split()),
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", digest


def parsed(raw: bytes) -> dict:
    """What a record says; a response's digest is computed from its payload and must agree."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda urn: int(n) if (n := urn[len("<urn:page:") : -1]) else None
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(fields["WARC-Refers-To"]) if kind == "revisit" else None,
    }


class Package:
    """Writes one package; records stream, the index is kept until the end."""

    def __init__(self, uri: str):
        self.context = new_file(uri)
        self.zip = zipfile.ZipFile(self.context.__enter__(), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, row: tuple) -> None:
        raw, digest = record(*row)
        packed = gzip.compress(raw, 6, mtime=0)
        self.data.write(packed)
        self.index.append(json.dumps({"page": row[0], "offset": self.size, "length": len(packed), "digest": digest}))
        self.size += len(packed)

    def close(self) -> int:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as out:
            for line in self.index:
                out.write(line.encode() + b"\n")
        self.zip.close()
        self.context.__exit__(None, None, None)
        return len(self.index)

    def abandon(self, error: BaseException) -> None:
        self.context.__exit__(type(error), error, error.__traceback__)


class Archive:
    """The directory of a package; members are (place, size) in the file."""

    def __init__(self, source):
        self.source = source
        self.members = {
            name: (self._data_place(place), size) for name, method, size, place in self._directory() if method == 0
        }

    def _directory(self) -> Iterator[tuple[str, int, int, int]]:
        end = self.source.size()
        tail_at = max(0, end - 65557)
        tail = self.source.read_at(end - tail_at, tail_at)
        spot = tail.rfind(b"PK\x05\x06")
        if spot < 0:
            raise ValueError("not a ZIP file")
        entries, size, place = struct.unpack("<HII", tail[spot + 10 : spot + 20])
        if entries == 0xFFFF or size == 0xFFFFFFFF or place == 0xFFFFFFFF:  # ZIP64
            locator = self.source.read_at(20, tail_at + spot - 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("the ZIP64 locator is missing")
            record64 = self.source.read_at(56, struct.unpack("<Q", locator[8:16])[0])
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 directory is missing")
            entries, size, place = struct.unpack("<QQQ", record64[32:56])
        raw, at = self.source.read_at(size, place), 0
        for _ in range(entries):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            method, = struct.unpack("<H", raw[at + 10 : at + 12])
            packed, full, n, extra, note = struct.unpack("<IIHHH", raw[at + 20 : at + 34])
            local, = struct.unpack("<I", raw[at + 42 : at + 46])
            name = raw[at + 46 : at + 46 + n].decode()
            more = raw[at + 46 + n : at + 46 + n + extra]
            wide = [k for k, v in (("full", full), ("packed", packed), ("local", local)) if v == 0xFFFFFFFF]
            while wide and len(more) >= 4:
                tag, length = struct.unpack("<HH", more[:4])
                if tag == 1:
                    got = dict(zip(wide, struct.unpack(f"<{len(wide)}Q", more[4 : 4 + 8 * len(wide)])))
                    packed, local = got.get("packed", packed), got.get("local", local)
                    break
                more = more[4 + length :]
            yield name, method, packed, local
            at += 46 + n + extra + note

    def _data_place(self, local: int) -> int:
        head = self.source.read_at(30, local)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("damaged member")
        n, extra = struct.unpack("<HH", head[26:30])
        return local + 30 + n + extra

    def index(self) -> Iterator[dict]:
        place, size = self.members[INDEX]
        rest = b""
        for at in range(0, size, RANGE_BYTES):
            lines = (rest + self.source.read_at(min(RANGE_BYTES, size - at), place + at)).split(b"\n")
            rest = lines.pop()
            yield from map(json.loads, lines)

    def read(self, offset: int, length: int) -> dict:
        """One record."""
        return parsed(gzip.decompress(self.source.read_at(length, self.members[DATA][0] + offset)))

    def records(self) -> Iterator[dict]:
        """All records in the order of the index, a range of them at a time."""
        start = self.members[DATA][0]
        lines: list[dict] = []
        for line in self.index():
            if lines and line["offset"] + line["length"] - lines[0]["offset"] > RANGE_BYTES:
                yield from self._range(start, lines)
                lines = []
            lines.append(line)
        if lines:
            yield from self._range(start, lines)

    def _range(self, start: int, lines: list[dict]) -> Iterator[dict]:
        a = lines[0]["offset"]
        raw = memoryview(self.source.read_at(lines[-1]["offset"] + lines[-1]["length"] - a, start + a))
        for line in lines:
            at = line["offset"] - a
            yield parsed(gzip.decompress(raw[at : at + line["length"]]))


def write_packages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write all pages to packages in the shared folder; a row per package: path, records."""
    spark = pages.sparkSession
    folder = workspace(spark, "packages")
    rows = pages.select(
        quoted(id_col).cast("long").alias("page"),
        quoted(url_col).cast("string").alias("url"),
        F.coalesce(quoted(payload_col), F.lit("")).cast("binary").alias("payload"),
    )
    # Two hashes of the bytes and their length stand for the payload.
    same = F.struct(F.sha2("payload", 256), F.md5("payload"), F.length("payload"))
    rows = rows.withColumn("same", same)
    groups = rows.groupBy("same").agg(F.max("page").alias("first"))
    keyed = rows.join(groups, "same")
    revisit = ~F.col("page").eqNullSafe(F.col("first")) & (F.length("payload") >= min_bytes)
    final = keyed.select("page", "url", "payload", "first", revisit.alias("revisit"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, made, package = TaskContext.get().partitionId(), 0, None
        path = ""
        try:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if package is None:
                        path = f"{folder}/part-{number:06d}-{made:04d}.wacz"
                        package, made = Package(path), made + 1
                    package.add(row)
                    if package.size >= PACKAGE_BYTES:
                        yield _row(path, package.close())
                        package = None
            if package is not None:
                yield _row(path, package.close())
        except Exception as error:
            if package is not None:
                package.abandon(error)
            raise

    final.mapInArrow(write, "path string, records long").write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _row(path: str, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": np.array([records])})


def read_packages(packages: DataFrame, payloads: bool = False) -> DataFrame:
    """All records: page_id, url, payload_bytes, payload_digest, record_type, refers_to (payload on demand)."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if payloads:
        schema, types = f"{schema}, payload binary", [*types, pa.binary()]
    names = [f.split()[0] for f in schema.split(", ")]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, types)], names)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths in batches:
            for path in paths.column(0).to_pylist():
                with opened(path) as source:
                    held: list[dict] = []
                    for r in Archive(source).records():
                        held.append(r if payloads else {**r, "payload": None})
                        if len(held) >= 256:
                            yield batch(held)
                            held = []
                    if held:
                        yield batch(held)

    return packages.select("path").repartition(max(1, packages.count())).mapInArrow(read, schema)
