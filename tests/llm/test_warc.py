"""WARC derivatives: linked records, digests, and files that read back."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib

from retail_strata.llm import warc

PAGES = "page_id bigint, url string, html string, key string, id string, block string"
PAGE = '<html lang="DE"><title>A &amp; B</title><p>Ünï</p><a href="/x?a=1&amp;b=2">l</a><p>two</p>'


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def build(spark, rows):
    pages = spark.createDataFrame([(*r, "k", "i", "b") for r in rows], PAGES)
    responses = warc.responses_of_pages(pages, "2025-01-01T00:00:00Z")
    columns = ("page_id", "record_id", "target_uri", "warc_date", "http_head", "payload")
    return responses, warc.build_derivatives(responses, *columns)


def read_records(data: bytes):
    """Records of a WARC file, by their own lengths."""
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        assert lines[0] == "WARC/1.1" and rest[size : size + 4] == b"\r\n\r\n"
        yield fields, rest[:size]
        data = rest[size + 4 :]


def test_records_of_responses(spark, tmp_path):
    rows = [(1, "http://a.example/", PAGE), (2, None, None), (3, "http://b.example/", "")]
    rows += [(None, "http://c.example/", "<p>" + "x " * 50_000), (1, "http://a.example/", PAGE)]
    responses, records = build(spark, rows)
    by_id = {r.record_id: r for r in responses.collect()}
    found = records.collect()
    assert len(found) == 2 * len(rows)
    for r in found:
        source = by_id[r.refers_to]
        payload = (source.payload or "").encode()
        assert r.source_payload_digest == sha1(payload)
        assert r.source_block_digest == sha1(source.http_head.encode() + payload)
        assert r.target_uri == source.target_uri and r.warc_date == source.warc_date
        assert r.block_digest == sha1(r.block.encode())
        assert r.content_length == len(r.block.encode())
    assert len({(r.record_id, r.type) for r in found}) == 2 * (len(rows) - 1)
    meta, text = sorted((r for r in found if r.page_id == 1), key=lambda r: r.type)[::2][::-1]
    assert text.block == "Ünï l\ntwo" or text.block == "Ünï\nl\ntwo"
    assert "title: A & B\r\n" in meta.block and "language: de\r\n" in meta.block
    assert "outlink: /x?a=1&b=2\r\n" in meta.block
    assert "source-content-type: text/html; charset=utf-8\r\n" in meta.block
    warc.write_warc(records, str(tmp_path / "w"))
    files = [gzip.open(f).read() for f in glob.glob(str(tmp_path / "w" / "*.gz"))]
    read = [x for data in files for x in read_records(data)]
    assert sorted((f["WARC-Record-ID"], f["WARC-Block-Digest"], b) for f, b in read) == sorted(
        (r.record_id, r.block_digest, r.block.encode()) for r in found
    )
    assert all(f["WARC-Refers-To"] in by_id and sha1(b) == f["WARC-Block-Digest"] for f, b in read)


def test_null_id_and_head():
    meta, text = warc.derive(None, None, None, None, None)
    assert meta["refers_to"] is None and "WARC-Refers-To" not in meta["head"] and text["block"] == ""
    assert meta["record_id"] != text["record_id"]


def test_same_records_again(spark):
    rows = [(k, f"http://a.example/{k}", PAGE) for k in range(5)]
    first, second = (sorted(map(tuple, build(spark, rows)[1].collect())) for _ in range(2))
    assert first == second


def test_empty_table(spark):
    assert build(spark, [])[1].collect() == []


def test_addresses_and_all_headers_stay_as_they_are(spark, tmp_path):
    url = "https://x/a?id=5&copy=2&section=3&para=1"
    http = "HTTP/1.1 200 OK\r\nX-B: 1\r\nSet-Cookie: a=1&copy=2\r\nSet-Cookie: b\r\n\tc\r\nX-A: 2\r\n\r\n"
    meta, _ = warc.derive("<urn:uuid:1>", url, "2025-01-01T00:00:00Z", http, PAGE)
    assert f"WARC-Target-URI: {url}\r\n" in meta["head"]
    assert f"WARC-Refers-To-Target-URI: {url}\r\n" in meta["head"]
    lines = ["x-b: 1", "set-cookie: a=1&copy=2", "set-cookie: b c", "x-a: 2", "payload-length: "]
    assert meta["block"].startswith("\r\n".join(f"source-{x}" for x in lines))


def test_lengths_and_digests_come_from_the_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 2)
    rows = [(1, "http://a.example/", PAGE), (2, None, None), (3, "http://b.example/?a&copy=1", "")]
    rows += [(1, "http://a.example/", PAGE), (1, "http://a.example/", "<p>other")]
    _, records = build(spark, rows)
    got = warc.written_and_read(records, str(tmp_path / "w"))
    expected = records.selectExpr("*", "md5(head) as head_md5").drop("head", "block")
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 2 * len(rows)
    assert len(glob.glob(str(tmp_path / "w" / "*.gz"))) >= len(rows)
    assert warc.written_and_read(build(spark, [])[1], str(tmp_path / "e")).collect() == []
