"""WARC derivatives: a metadata and a plain-text conversion record for every response.

Both refer to the response by ``WARC-Refers-To`` and repeat its target, date, identifying headers
and digests, and both have identifiers made from the response's, so that a task that runs again
makes the same records. The metadata block (``application/warc-fields``) lists what the response's
headers and markup say; the conversion block holds the visible text, one block of the page a line.

A null payload counts as empty; both records are still made. A null target or date leaves its
header out, a null header text is empty, and a null id refers to nothing and is numbered by the
response's content. Repeated responses give repeated records. An empty table gives no rows. Only
the named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.llm.html_text import blocks_of

_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public name space for URLs
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
_LANG = re.compile(r"<html[^>]*\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
#: Most records of a file, which is read back whole.
FILE_RECORDS = 4_096

DERIVED = (
    "type string, record_id string, refers_to string, target_uri string, warc_date string,"
    " content_type string, content_length bigint, block_digest string, source_payload_digest string,"
    " source_block_digest string, head string, block string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_fields(text: str) -> list[tuple[str, str]]:
    """Lower-case name and value of every field of an HTTP head, in order and with repeats."""
    found: list[tuple[str, str]] = []
    for line in re.split(r"\r?\n", text)[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and found:  # goes on with the field before
            found[-1] = (found[-1][0], one_line(f"{found[-1][1]} {line}"))
        elif colon:
            found.append((one_line(name).lower(), one_line(value)))
    return found


def one_line(text: str) -> str:
    return " ".join(text.split())


def record(kind: str, source: dict, content_type: str, block: str) -> dict:
    """A record of one kind derived from a response."""
    base = source["id"] or f"sha1:{source['block_digest']}"
    data = block.encode()
    row = {
        "type": kind,
        "record_id": f"<urn:uuid:{uuid.uuid5(_NAMES, f'{kind}:{base}')}>",
        "refers_to": source["id"],
        "target_uri": source["target"],
        "warc_date": source["date"],
        "content_type": content_type,
        "content_length": len(data),
        "block_digest": digest(data),
        "source_payload_digest": source["payload_digest"],
        "source_block_digest": source["block_digest"],
        "block": block,
    }
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", row["warc_date"]),
        ("WARC-Target-URI", row["target_uri"]),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Refers-To-Target-URI", row["target_uri"] if row["refers_to"] else None),
        ("WARC-Refers-To-Date", row["warc_date"] if row["refers_to"] else None),
        ("WARC-Block-Digest", row["block_digest"]),
        ("Content-Type", content_type),
        ("Content-Length", str(len(data))),
    ]
    lines = [f"{name}: {one_line(value)}" for name, value in fields if value is not None]
    return row | {"head": "\r\n".join(["WARC/1.1", *lines])}


def derive(identifier: str | None, target, date, head: str | None, payload: str | None) -> list[dict]:
    """The metadata and the conversion record of one response."""
    head, payload = head or "", payload or ""
    body = payload.encode()
    source = {
        "id": identifier,
        "target": target,
        "date": date,
        "payload_digest": digest(body),
        "block_digest": digest(head.encode() + body),
    }
    title, lang = _TITLE.search(payload), _LANG.search(payload)
    fields = [(f"source-{name}", value) for name, value in header_fields(head)]
    fields += [
        ("source-payload-length", str(len(body))),
        ("source-payload-digest", source["payload_digest"]),
        ("source-block-digest", source["block_digest"]),
    ]
    fields += [("title", one_line(html.unescape(title.group(1))))] if title else []
    fields += [("language", lang.group(1).lower())] if lang else []
    links: list[str] = []
    text = "\n".join(t for t, _ in blocks_of(payload, links))
    fields += [("outlink", one_line(link)) for link in links]
    block = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return [
        record("metadata", source, "application/warc-fields", block),
        record("conversion", source, "text/plain; charset=utf-8", text),
    ]


def build_derivatives(
    responses: DataFrame, key: str, identifier: str, target: str, date: str, head: str, payload: str
) -> DataFrame:
    """``key`` and the ``DERIVED`` columns of the two records of every response."""
    rows = responses.select(
        F.col(key).alias("key"),
        *[
            F.col(c).cast("string").alias(name)
            for c, name in zip(
                (identifier, target, date, head, payload),
                ("id", "target", "date", "http", "payload"),
                strict=True,
            )
        ],
    )
    kind = rows.schema["key"].dataType.simpleString()

    def derived(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                columns = [part[c].to_pylist() for c in ("id", "target", "date", "http", "payload")]
                records, at = [], []
                for k, values in enumerate(zip(*columns, strict=True)):
                    two = derive(*values)
                    records += two
                    at += [k] * len(two)
                names = [x.split()[0] for x in DERIVED.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [part["key"].take(pa.array(at, pa.int64()))]
                    + [
                        pa.array(
                            [r[n] for r in records],
                            pa.int64() if n == "content_length" else pa.string(),
                        )
                        for n in names
                    ],
                    ["key", *names],
                )

    return rows.mapInArrow(derived, f"key {kind}, {DERIVED}").withColumnRenamed("key", key)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as WARC/1.1 files: head, empty line, block, and two line ends after each."""
    (
        records.select(F.concat("head", F.lit("\r\n\r\n"), "block"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(path)
    )


def records_of(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Head and block of every record of a WARC file, by the records' own lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        size = re.search(rb"\r\nContent-Length: (\d+)", data[at:end]) if end >= 0 else None
        stop = end + 4 + int(size.group(1)) if size else 0
        if not data.startswith(b"WARC/1.1\r\n", at) or not size or data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"no WARC record at byte {at}")
        yield data[at:end], data[end + 4 : stop]
        at = stop + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(head_md5, content_length, block_digest)`` of the records in WARC files, from their bytes."""

    def read(batches):
        for batch in batches:
            for content in batch["content"]:
                found = list(records_of(gzip.decompress(content.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.md5(head).hexdigest() for head, _ in found], pa.string()),
                        pa.array([len(block) for _, block in found], pa.int64()),
                        pa.array([digest(block) for _, block in found], pa.string()),
                    ],
                    ["head_md5", "content_length", "block_digest"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(
        read, "head_md5 string, content_length bigint, block_digest string"
    )


def written_and_read(records: DataFrame, path: str) -> DataFrame:
    """Records without head and block, and with lengths and digests as they are in files at ``path``.

    A record that the files do not hold has none.
    """
    write_warc(records, path)
    found = read_warc(records.sparkSession, path).distinct()
    own = records.withColumn("head_md5", F.md5("head")).drop("head", "block")
    columns = [found[c] if c in ("content_length", "block_digest") else own[c] for c in own.columns]
    return own.join(found, own["head_md5"] == found["head_md5"], "left").select(*columns)


def responses_of_pages(pages: DataFrame, fetched: str) -> DataFrame:
    """Response records of a table of pages: an identifier, the HTTP head and the page itself."""
    length = F.octet_length(F.coalesce("html", F.lit("")))
    name = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), "url"))
    dashed = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return pages.select(
        "page_id",
        F.format_string("<urn:uuid:%s>", dashed).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(fetched).alias("warc_date"),
        F.format_string(
            "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n",
            length,
        ).alias("http_head"),
        F.col("html").alias("payload"),
    )
