"""Web archives in ZIP packages: written by tasks, read back by range without extraction.

A package holds two stored (not deflated) members: `archive/data.warc.gz`, WARC records each
gzipped on its own, and `indexes/index.cdx`, a line per record with its place in the first. Sizes
and offsets are in ZIP64 fields. The reader parses the end records and the central directory,
finds where the members' bytes begin, and fetches ranges of records that the index names.

Packages of other writers are read too: any number of archives `archive/*.warc` or `.warc.gz`, index members
below `indexes/` with an object of `filename`, `offset` and `length` at the end of each line, plain or
gzipped, and records of any type without the headers of this writer.

Files go through pyarrow's file systems, so a folder may be on any store that these can open.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Mapping
from datetime import UTC, datetime
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.session import scratch_dir, stored

# Smaller payloads are never stored as revisits.
LEAST_REVISIT = 1000
# A package is closed, and a range of records ends, at about so many bytes.
PACKAGE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

# Fixed values of WARC: the profile of a revisit of an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format: signatures, and the marks of fields that stand in ZIP64 records.
LOCAL, CENTRAL, DESCRIPTOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x07\x08"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF

_PACKAGES = "path string, bytes long, records long"
_RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class PackageWriter:
    """A ZIP package written front to back; sizes follow the members in data descriptors."""

    def __init__(self, out: BinaryIO) -> None:
        self.out, self.at, self.members = out, 0, []

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def open(self, name: str) -> None:
        encoded = name.encode()
        self.name, self.began, self.size, self.crc = encoded, self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self.write(struct.pack("<4s5H3I2H", LOCAL, 45, 0x0808, 0, 0, 0x21, 0, FULL32, FULL32, len(encoded), len(extra)) + encoded + extra)

    def add(self, data: bytes) -> int:
        """Append to the open member; returns where in it the data begin."""
        start = self.size
        self.write(data)
        self.size, self.crc = start + len(data), zlib.crc32(data, self.crc)
        return start

    def close_member(self) -> None:
        self.write(struct.pack("<4sIQQ", DESCRIPTOR, self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.began))

    def close(self) -> None:
        began = self.at
        for name, crc, size, place in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, place)
            self.write(struct.pack("<4s6H3I5H2I", CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, FULL32, FULL32,
                                   len(name), len(extra), 0, 0, 0, 0, FULL32) + name + extra)
        ended, count = self.at, len(self.members)
        self.write(struct.pack("<4sQ2H2I4Q", END64, 44, 45, 45, 0, 0, count, count, ended - began, began))
        self.write(struct.pack("<4sIQI", LOCATOR64, 0, ended, 1))
        self.write(struct.pack("<4s4H2IH", END, FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0))


def read_range(source: BinaryIO, start: int, length: int) -> bytes:
    source.seek(start)
    data = source.read(length)
    if len(data) != length:
        raise ValueError(f"{length} bytes wanted at {start}, {len(data)} found")
    return data


def members_of(source: BinaryIO, size: int) -> dict[str, tuple[int, int]]:
    """First byte and length of every stored member, from the central directory, with or without ZIP64."""
    tail_at = max(0, size - 22 - FULL16)
    tail = read_range(source, tail_at, size - tail_at)
    end = tail.rfind(END)
    while end >= 0 and (len(tail) - end < 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(END, 0, end)  # the signature may also be in the comment
    if end < 0:
        raise ValueError("no end of a central directory: not a ZIP package")
    count, length, began = struct.unpack_from("<HII", tail, end + 10)
    if FULL16 in (count,) or FULL32 in (length, began):
        signature, _, place, _ = struct.unpack("<4sIQI", read_range(source, tail_at + end - 20, 20))
        if signature != LOCATOR64:
            raise ValueError("no ZIP64 locator before the end record")
        signature, *_, count, length, began = struct.unpack("<4sQ2H2I4Q", read_range(source, place, 56))
        if signature != END64:
            raise ValueError("no ZIP64 end record where its locator points")
    directory, at, found = read_range(source, began, length), 0, {}
    for _ in range(count):
        signature, _, _, _, method, _, _, _, packed, plain, n_name, n_extra, n_comment, _, _, _, place = struct.unpack_from("<4s6H3I5H2I", directory, at)
        if signature != CENTRAL:
            raise ValueError("broken central directory")
        name = directory[at + 46:at + 46 + n_name].decode()
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        at += 46 + n_name + n_extra + n_comment
        while len(extra) >= 4:
            tag, n = struct.unpack_from("<HH", extra)
            if tag == 1:  # the ZIP64 values of just those fields that are marked, in this order
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = next(values) if plain == FULL32 else plain
                packed = next(values) if packed == FULL32 else packed
                place = next(values) if place == FULL32 else place
            extra = extra[4 + n:]
        if method == 0:
            head = read_range(source, place, 30)
            if head[:4] != LOCAL:
                raise ValueError(f"no local header of {name} where the directory points")
            found[name] = (place + 30 + sum(struct.unpack_from("<HH", head, 26)), packed)
    return found


def header_value(text: object) -> str:
    """A header value of one line: other characters than printable ones are percent-encoded."""
    return "".join(c if c.isprintable() and c != "%" else "".join(f"%{b:02X}" for b in c.encode()) for c in str(text))


def plain_value(text: str) -> str:
    data, at, out = text.encode(), 0, bytearray()
    while at < len(data):
        if data[at] == 0x25:
            out.append(int(data[at + 1:at + 3], 16))
            at += 3
        else:
            out.append(data[at])
            at += 1
    return out.decode()


def target_uri(url: str) -> str:
    """The url with everything but visible ASCII percent-encoded; what is encoded already stays."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None,
                 date: str | None = None) -> bytes:
    """A gzipped WARC record of its own id; a revisit names the page whose response holds its payload.

    A url that is no URI as it stands is also kept whole in a header of its own.
    """
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
    uri = None if url is None else target_uri(url)
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", date or now()),
               ("WARC-Page-ID", page_id), ("WARC-Target-URI", uri), ("WARC-Page-URL", None if uri == url else header_value(url)),
               ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"), ("WARC-Payload-Length", len(payload)),
               ("WARC-Profile", SAME_PAYLOAD if kind == "revisit" else None), ("WARC-Refers-To-Page-ID", refers_to),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def hex_digest(value: str | None) -> str | None:
    """A SHA-1 digest of a header in lower-case hexadecimal, from there or from base32; None for other algorithms."""
    algorithm, _, digest = (value or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    return digest.lower() if len(digest) == 40 else base64.b32decode(digest.upper()).hex()


def parse_record(data: bytes) -> tuple:
    """The row of a record, gzipped or plain; the payload of a response or resource is checked against its digest.

    The payload of a record of HTTP is what follows its head, that of another the whole block. Revisits and records
    about the crawl have none. A page id and the size of a revisit's payload are known from this writer only.
    """
    plain = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    head, _, rest = plain.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    values: dict[str, str] = {}
    for line in lines:
        if line[:1] in (" ", "\t") and values:  # goes on with the header before
            values[name] += " " + line.strip()
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            values[name] = value.strip()
    block = rest[:int(values["content-length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its length says")
    kind, digest = values["warc-type"], hex_digest(values.get("warc-payload-digest"))
    payload, size = None, _number(values, "warc-payload-length")
    if kind in ("response", "resource"):
        http = values.get("content-type", "").lower().startswith("application/http")
        payload = block.partition(b"\r\n\r\n")[2] if http else block
        size, found = len(payload), hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError("a payload does not match its digest")
        digest = found
    url = values.get("warc-target-uri")
    if url is not None:
        url = plain_value(values["warc-page-url"]) if "warc-page-url" in values else url.removeprefix("<").removesuffix(">")
    return _number(values, "warc-page-id"), url, size, digest, kind, _number(values, "warc-refers-to-page-id"), payload


def _number(values: Mapping[str, str], name: str) -> int | None:
    return int(values[name]) if name in values else None


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, digest, record_type and refers_to of every page.

    Of equal payloads of at least `least` bytes the rows of the largest page_id are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("large", F.octet_length("html") >= least)
    copies = (rows.filter("large").groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("digest", "kept"))
    rows = rows.join(copies, "digest", "left")
    revisit = F.col("large") & F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id"))
    return rows.select("page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("kept")).alias("refers_to"))


def write_packages(records: DataFrame, folder: str) -> DataFrame:
    """Write records of `with_revisits` into packages below `folder`; path, bytes and records of each.

    The returned list is stored, and only packages in it count: what a lost or repeated task
    attempt left behind is in no list. All records have the date at which writing began.
    """
    date = now()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        system.create_dir(root, recursive=True)
        package, lines, done = None, [], []

        def finish() -> None:
            package.close_member()
            package.open(INDEX)
            package.add("".join(lines).encode())
            package.close_member()
            package.close()
            package.out.close()
            done.append((f"{folder}/{name}", package.at, len(lines)))

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "html", "digest", "record_type", "refers_to")), strict=True):
                if package is None:
                    name, lines = f"part-{TaskContext.get().partitionId()}-{uuid.uuid4().hex}.zip", []
                    package = PackageWriter(system.open_output_stream(f"{root}/{name}"))
                    package.open(DATA)
                page_id, url, html, digest, kind, refers_to = row
                record = record_bytes(page_id, url, html.encode(), digest, kind, refers_to, date)
                start = package.add(record)
                lines.append(json.dumps({"page_id": page_id, "filename": DATA.removeprefix("archive/"), "offset": start, "length": len(record)}) + "\n")
                if package.at >= PACKAGE_BYTES:
                    finish()
                    package = None
        if package is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "bytes", "records"])

    return stored(records.mapInArrow(write, _PACKAGES), "warc-packages")


def _opened(path: str) -> tuple[BinaryIO, int]:
    system, place = pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system.open_input_file(place), system.get_file_info(place).size


def located_records(source: BinaryIO, size: int) -> list[tuple[int, int]]:
    """Place and length of every record that the indexes of a package name, each once, in the order of their places."""
    members = members_of(source, size)
    archives = {name.removeprefix("archive/"): place for name, place in members.items()
                if name.startswith("archive/") and name.endswith((".warc", ".warc.gz"))}
    found, indexes = set(), 0
    for name, place in members.items():
        if not name.startswith("indexes/") or not name.removesuffix(".gz").endswith((".cdx", ".cdxj")):
            continue
        indexes += 1
        data = read_range(source, *place)
        lines = (gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data).decode().splitlines()
        for line in lines:
            if "{" not in line:
                continue  # the head of an index
            entry = json.loads(line[line.index("{"):])
            named = entry.get("filename")
            if named is None and len(archives) == 1:
                named = next(iter(archives))
            if (named or "").removeprefix("archive/") not in archives:
                raise ValueError(f"an index names no stored archive: {named}")
            first, length = archives[named.removeprefix("archive/")]
            offset, taken = int(entry["offset"]), int(entry["length"])
            if offset + taken > length:
                raise ValueError("an index names a place beyond its archive")
            found.add((first + offset, taken))
    if archives and not indexes:
        raise ValueError("no stored index in the package")
    return sorted(found)


def package_ranges(packages: DataFrame) -> DataFrame:
    """path, start, length and the lengths of the records of each range, from directories and indexes alone."""
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source, size = _opened(path)
                with source:
                    records = located_records(source, size)
                out, end, taken = [], None, 0
                for place, length in records:
                    if place != end or taken >= RANGE_BYTES:  # a gap, or enough for a read
                        out.append((path, place, []))
                        taken = 0
                    out[-1][2].append(length)
                    end, taken = place + length, taken + length
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.int64()),
                                                      pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    count = packages.agg(F.count(F.lit(1))).first()[0]  # the list is small, what it names is not
    return packages.select("path").repartition(max(count, 1), "path").mapInArrow(ranges, "path string, start long, lengths array<long>")


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of stored packages: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Each range is one read. payload is null for revisits, and for all with `payloads` false.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RECORDS.split(", ")]
        types = [pa.string() if x.endswith(" string") else pa.binary() if x.endswith(" binary") else pa.int64() for x in _RECORDS.split(", ")]
        for batch in batches:
            for path, start, lengths in zip(*(batch.column(n).to_pylist() for n in ("path", "start", "lengths")), strict=True):
                source, _ = _opened(path)
                with source:
                    data = read_range(source, start, sum(lengths))
                rows, at = [], 0
                for length in lengths:
                    row = parse_record(data[at:at + length])
                    rows.append(row if payloads else (*row[:-1], None))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    # A number of tasks by what is to be read: the rows that are dealt are tiny and would be coalesced by their own size.
    tasks = -(-(packages.agg(F.sum("bytes")).first()[0] or 0) // RANGE_BYTES)
    return package_ranges(packages).repartition(max(tasks, 1), "path", "start").mapInArrow(read, _RECORDS)


def archive_digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages as archives and read them back: a row per page.

    page_id, payload_bytes, payload_digest (hexadecimal SHA-1), record_type, refers_to, and the url
    that was read. Null html is an empty payload, a null url has no header and comes back null, a
    null page_id is below all others. Repeated rows of the largest page_id are all responses. Other
    columns are ignored; an empty table gives no rows.
    """
    packages = write_packages(with_revisits(pages), scratch_dir(spark, "warc"))
    return read_packages(packages, payloads=False).drop("payload")


ORACLE = f"""
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS kept FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {LEAST_REVISIT} AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to, url
FROM m
"""
