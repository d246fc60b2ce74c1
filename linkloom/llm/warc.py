"""Derived WARC records: from each response record a metadata record and a plain-text conversion record.

Both name the response in ``WARC-Refers-To``, and the metadata the conversion in ``WARC-Concurrent-To``, which a conversion may not have; their own identifiers follow from the
response's identifier and their type, so a task that runs again gives the same ones. The conversion
keeps the target, the date and the payload digest of its source; the metadata
record lists every header of the source unchanged, its digests, title, language and outlinks. Each record carries the
digest and length of its own block. Every response is converted in the task that reads it; nothing is shuffled.

Defined results: a null payload counts as empty and gives two records, the conversion with an
empty block. Null identifiers are derived from target and payload digest, so that equal responses without
identifier get equal records. Null targets, dates and headers are left out of the record. Repeated
responses give repeated records. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import ship_package, table
from linkloom.llm.html import ATTRIBUTES, BLOCK_TAGS
from linkloom.llm.words import batches_by_bytes

_HEADER = pa.struct([("name", pa.string()), ("value", pa.string())])
HEADERS = "array<struct<name: string, value: string>>"
RECORD = (
    f"record_id string, warc_type string, refers_to string, source_key bigint, target_uri string, content_type string, "
    f"content_length bigint, block_digest string, source_digest string, headers {HEADERS}, block string"
)

_MARKUP = re.compile(rf"<(?:(!--)|/?([A-Za-z][^\s/>]*){ATTRIBUTES}(?:>|\Z)|[!?/][^>]*+(?:>|\Z))")
_BREAKS = BLOCK_TAGS | {"br", "title"}
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in ("script", "style", "noscript", "template", "svg", "title")}
_TITLE = re.compile(r"<title\b[^>]*>([^<]*)", re.IGNORECASE)
# Tags of which attributes are read; each is gone through once, to its end.
_TAG = re.compile(rf"<(html|a)(?=[\s/>])({ATTRIBUTES})>", re.IGNORECASE)
_LANGUAGE = re.compile(r"\blang\s*+=\s*+[\"']?([A-Za-z0-9-]+)", re.IGNORECASE)
_LINK = re.compile(r"\bhref\s*+=\s*+[\"']?([^\s\"'>]+)", re.IGNORECASE)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def plain_text(html: str) -> str:
    """All readable text of a page, a block a line; time is linear in its length."""
    parts, pos = [], 0
    last = html.rfind(">") + 1  # there is no tag after this, and each one before it ends
    while found := _MARKUP.search(html, pos, last):
        parts.append(html[pos : found.start()])
        pos = found.end()
        if found[1]:
            end = html.find("-->", pos)
            pos = end + 3 if end >= 0 else len(html)
            parts.append(" ")
        elif found[2]:
            name = found[2].lower()
            if name in _BREAKS:
                parts.append("\n")
            if name in _CLOSE and html[found.start() + 1] != "/" and not (name == "svg" and html[pos - 2] == "/"):
                close = _CLOSE[name].search(html, pos)
                if close:
                    pos = close.end()
                elif name == "title":
                    after = html.find("<", pos)
                    pos = after if after >= 0 else len(html)
                else:
                    pos = len(html)
                parts.append(" ")
    parts.append(html[pos:])
    lines = (" ".join(line.split()) for line in unescape("".join(parts)).split("\n"))
    return "\n".join(line for line in lines if line)


def derived_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>"


def derive(source: dict) -> Iterator[dict]:
    """The metadata and the conversion record of a response."""
    payload = source["payload"] or ""
    own = digest(payload.encode())
    response = source["record_id"] or derived_id(f"{source['target_uri']} {own}", "response")
    ids = {kind: derived_id(response, kind) for kind in ("metadata", "conversion")}
    page = payload[: payload.rfind(">") + 1]
    fields = [("payload-digest", own), ("content-length", str(len(payload.encode())))]
    fields += [(f"source-{h['name']}", h["value"]) for h in source["headers"] or [] if h and h["name"] and h["value"] is not None]
    language, links = None, []
    for tag in _TAG.finditer(page):
        if tag[1] in "aA":
            links += [found[1] for found in [_LINK.search(tag[2])] if found]
        elif language is None:
            language = _LANGUAGE.search(tag[2])
    for name, found in (("title", _TITLE.search(page)), ("language", language)):
        if found:
            fields.append((name, " ".join(unescape(found[1]).split())))
    fields += [("outlink", unescape(link)) for link in links]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{n}: {' '.join(v.split())}\r\n" for n, v in fields)),
        "conversion": ("text/plain; charset=utf-8", plain_text(payload)),
    }
    for kind, (content_type, block) in blocks.items():
        data = block.encode()
        other = ids["conversion" if kind == "metadata" else "metadata"]
        headers = [
            ("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Refers-To", response),
            # Not allowed on a conversion.
            ("WARC-Concurrent-To", other if kind == "metadata" else None),
            ("WARC-Target-URI", source["target_uri"]), ("WARC-Date", source["date"]), ("WARC-Block-Digest", digest(data)),
            ("WARC-Source-Payload-Digest", own), ("Content-Type", content_type), ("Content-Length", str(len(data))),
        ]
        yield {
            "record_id": ids[kind], "warc_type": kind, "refers_to": response, "source_key": source["source_key"],
            "target_uri": source["target_uri"], "content_type": content_type, "content_length": len(data),
            "block_digest": digest(data), "source_digest": own,
            "headers": [{"name": n, "value": v} for n, v in headers if v is not None], "block": block,
        }


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per row of ``responses(source_key, record_id, target_uri, date, headers, payload)``."""
    ship_package(responses.sparkSession)
    text = ("record_id", "warc_type", "refers_to", "target_uri", "content_type", "block_digest", "source_digest", "block")
    numbers = ("source_key", "content_length")
    names = [part.split()[0] for part in re.sub(r"<.*>>", "", RECORD).split(", ")]
    kinds = [pa.string() if n in text else pa.int64() if n in numbers else pa.list_(_HEADER) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "payload"):
                records = [record for source in batch.to_pylist() for record in derive(source)]
                yield pa.RecordBatch.from_pylist(records, pa.schema(list(zip(names, kinds, strict=True))))

    columns = ("source_key", "record_id", "target_uri", "date", "headers", "payload")
    return responses.select(*columns).mapInArrow(run, RECORD)


def serialise(record: dict) -> bytes:
    """A record in the exchange format, one gzip member."""
    head = "WARC/1.0\r\n" + "".join(f"{h['name']}: {h['value']}\r\n" for h in record["headers"])
    return gzip.compress(head.encode() + b"\r\n" + record["block"].encode() + b"\r\n\r\n", mtime=0)


def serialised(records: DataFrame) -> DataFrame:
    """``record_id, content`` with the bytes of each record; the contents one after the other are a WARC file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in batches_by_bytes(whole, "block"):
                contents = pa.array([serialise(r) for r in batch.to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("record_id"), contents], ["record_id", "content"])

    ship_package(records.sparkSession)
    return records.select("record_id", "headers", "block").mapInArrow(run, "record_id string, content binary")


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a WARC file, gzipped by record or as a whole."""
    stream = gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip()] = value.strip()
        yield headers, stream.read(int(headers.get("Content-Length", 0)))


def page_responses(pages: DataFrame) -> DataFrame:
    """Pages as response records: the identifier follows from page id and url, the headers say what the table knows."""
    key = F.md5(F.concat_ws(" ", F.col("page_id").cast("string"), "url").cast("binary"))
    parts = [F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    length = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    pairs = (("WARC-Target-URI", F.col("url")), ("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", length))
    headers = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs])
    return pages.select(
        F.col("page_id").cast("bigint").alias("source_key"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(None).cast("string").alias("date"), headers.alias("headers"), F.col("html").alias("payload"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(page_responses(table(spark, sf_dir, "pages"))).withColumnRenamed("source_key", "page_id")
