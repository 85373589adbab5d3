"""ZIP-packaged archives: round trips, and packages of the standard library."""

import base64
import gzip
import hashlib
import io
import json
import random
import re
import zipfile

import pytest

from velolake.llm import warc
from velolake.session import scratch_dir

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    best = {}
    for page, _, html in rows:
        if page is not None:
            best[html or ""] = max(page, best.get(html or "", page))
    out = []
    for page, url, html in rows:
        payload, kept = (html or "").encode(), best.get(html or "")
        revisit = len(payload) >= 1000 and kept is not None and page != kept
        out.append((page, url, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    return sorted(out, key=str)


def found(spark, rows, schema=SCHEMA):
    out = warc.archive_digest(spark, spark.createDataFrame(rows, schema))
    return sorted((tuple(r) for r in out.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip(spark, monkeypatch):
    pick = random.Random(9)
    htmls = ["é" * 600, "a" * 999, "a" * 1000, "<p>\r\n\r\nWARC/1.1</p>" * 100, "x", "", None]
    rows = [(i, f"http://h/{i}?q=%41 é\r\n", pick.choice(htmls)) for i in range(120)]
    rows += [(None, None, "a" * 1000), (5000, None, "é" * 600), (5000, "again", "é" * 600)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, "u", "h", 2, "x")], SCHEMA + ", digest int, kept string") == brute([(1, "u", "h")])


def test_payloads_come_back(spark):
    rows = [(i, f"u{i}", "text " * i) for i in range(400)]
    packages = warc.write_packages(warc.with_revisits(spark.createDataFrame(rows, SCHEMA)), scratch_dir(spark, "warc-test"))
    back = {r.page_id: bytes(r.payload).decode() for r in warc.read_packages(packages).collect()}
    assert back == {i: h for i, _, h in rows}


def test_packages_are_zip_files():
    out = io.BytesIO()
    package = warc.PackageWriter(out)
    for name, parts in (("a", [b"one", b"two"]), ("dir/b", [b""])):
        package.open(name)
        for part in parts:
            package.add(part)
        package.close_member()
    package.close()
    with zipfile.ZipFile(out) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == {"a": b"onetwo", "dir/b": b""}


@pytest.mark.parametrize("zip64", [False, True])
def test_reads_other_packages(zip64):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        with z.open("plain.warc", "w", force_zip64=zip64) as member:
            member.write(b"records")
        z.writestr("packed", b"x" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it"
    members = warc.members_of(out, len(out.getvalue()))
    assert list(members) == ["plain.warc"]
    assert warc.read_range(out, *members["plain.warc"]) == b"records"


def test_broken_packages():
    with pytest.raises(ValueError, match="ZIP"):
        warc.members_of(io.BytesIO(b"no zip at all"), 13)
    record = warc.record_bytes(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), "response", None)
    assert warc.parse_record(record)[2:5] == (7, hashlib.sha1(b"payload").hexdigest(), "response")
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(gzip.compress(gzip.decompress(record).replace(b"\r\n\r\npayload", b"\r\n\r\npayl0ad")))


def headers_of(record):
    lines = gzip.decompress(record).partition(b"\r\n\r\n")[0].decode().split("\r\n")
    return lines[0], dict(line.split(": ", 1) for line in lines[1:])


def test_records_have_the_headers_of_the_format():
    digest = hashlib.sha1(b"payload").hexdigest()
    records = [warc.record_bytes(1, "http://a/x%20y", b"payload", digest, kind, page) for kind, page in (("response", None), ("revisit", 7), ("response", None))]
    heads = [headers_of(r) for r in records]
    assert {version for version, _ in heads} == {"WARC/1.1"} and len({h["WARC-Record-ID"] for _, h in heads}) == 3
    for _, head in heads:
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", head["WARC-Date"]) and head["WARC-Target-URI"] == "http://a/x%20y"
        assert head["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"payload").digest()).decode() and "WARC-Page-URL" not in head
    assert [h.get("WARC-Profile") for _, h in heads] == [None, warc.SAME_PAYLOAD, None]
    assert [warc.parse_record(r)[:6] for r in records[:2]] == [(1, "http://a/x%20y", 7, digest, "response", None), (1, "http://a/x%20y", 7, digest, "revisit", 7)]
    odd = warc.record_bytes(1, "http://h/\u00e9 %41\r\n", b"", hashlib.sha1(b"").hexdigest(), "response", None)
    assert headers_of(odd)[1]["WARC-Target-URI"] == "http://h/%C3%A9%20%41%0D%0A" and warc.parse_record(odd)[1] == "http://h/\u00e9 %41\r\n"


def foreign(kind, block, *lines, packed=True):
    head = [f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:11111111-2222-3333-4444-555555555555>", "WARC-Date: 2020-01-02T03:04:05Z", *lines]
    data = "\r\n".join(["WARC/1.0", *head, f"content-length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"
    return gzip.compress(data) if packed else data


def test_packages_of_other_writers(spark, tmp_path):
    """Two archives, plain and gzipped indexes, records that no index names, and headers of other spellings."""
    http, page = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n", b"<p>one</p>\r\n\r\n<p>two</p>"
    digest = base64.b32encode(hashlib.sha1(page).digest()).decode()
    uri = "WARC-Target-URI: http://a/"
    one = [foreign("warcinfo", b"software: x\r\n"),
           foreign("response", http + page, uri, f"warc-payload-digest:sha1:{digest}", "Content-Type: application/http;", " msgtype=response"),
           foreign("request", b"GET / HTTP/1.1\r\n\r\n", uri, "Content-Type: application/http; msgtype=request"),
           foreign("revisit", http, uri, f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response")]
    two = [foreign("resource", b"text \r\n\r\n", "WARC-Target-URI: <http://b/>", "Content-Type: text/plain", packed=False)]

    def lines(name, records, *kept):
        starts = [sum(map(len, records[:i])) for i in range(len(records))]
        return "".join(f'com,a)/ 2020 {json.dumps({"filename": name, "offset": str(starts[i]), "length": str(len(records[i]))})}\n' for i in kept)

    path = tmp_path / "other.wacz"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("datapackage.json", "{}")
        z.writestr("archive/one.warc.gz", b"".join(one))
        z.writestr("archive/two.warc", b"".join(two))
        z.writestr("indexes/a.cdx.gz", gzip.compress(lines("one.warc.gz", one, 1, 3).encode()))
        z.writestr("indexes/b.cdxj", "!meta 0\n" + lines("archive/two.warc", two, 0))
        z.writestr("indexes/a.idx", "no index of records")
    packages = spark.createDataFrame([(str(path), path.stat().st_size, 3)], "path string, bytes long, records long")
    back = sorted((tuple(r) for r in warc.read_packages(packages).collect()), key=str)
    sha = hashlib.sha1(page).hexdigest()
    assert back == sorted([(None, "http://a/", len(page), sha, "response", None, page), (None, "http://a/", None, sha, "revisit", None, None),
                           (None, "http://b/", 9, hashlib.sha1(b"text \r\n\r\n").hexdigest(), "resource", None, b"text \r\n\r\n")], key=str)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("archive/one.warc.gz", b"".join(one))
    with open(path, "rb") as source, pytest.raises(ValueError, match="no stored index"):
        warc.located_records(source, path.stat().st_size)
