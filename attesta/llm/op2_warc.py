"""WARC derivatives: from each response record a metadata record and a plain-text conversion record.

Both refer to the response by WARC-Refers-To and to each other by WARC-Concurrent-To, keep its target URI and date,
and carry digests of their own block. The metadata record repeats the source's HTTP headers and payload digest. Record
ids are name-based, from the response's id and the kind, so that reruns and retried tasks give the same records.

The work is per record, without an exchange; a table of any size streams through.

Defined cases: a null payload is empty; a null URI leaves the header out; a null page_id counts as the empty name;
repeated rows give equal records; unknown character references stay as they are; extra columns are not read; texts of
any length; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SPACE_URL = uuid.uuid5(uuid.NAMESPACE_URL, "urn:attesta:warc")
HIDDEN = re.compile(r"<!--|<(script|style|head|noscript|template)\b[^>]*>", re.I)
BREAK = re.compile(r"<(?:/?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|nav|footer|header|blockquote|pre|hr)|!doctype)\b[^>]*>", re.I)
TAG = re.compile(r"<[^<>]*>")
BLANKS = re.compile(r"[ \t\r\f\v]+")
LINES = re.compile(r" ?\n[ \n]*")
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)", re.I)
_OUT = pa.schema([("page_id", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("concurrent_to", pa.string()), ("target_uri", pa.string()), ("block_digest", pa.string()), ("source_digest", pa.string()), ("content_length", pa.int64()), ("block", pa.string())])
OUT = "page_id long, kind string, record_id string, refers_to string, concurrent_to string, target_uri string, block_digest string, source_digest string, content_length long, block string"


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_URL, chr(31).join(name))}>"


def response(page_id: int | None, url: str | None, html: str | None) -> tuple[str, list[tuple[str, str]], bytes]:
    """Id, HTTP headers and payload of the response record that a stored page stands for."""
    payload = (html or "").encode()
    name = record_id("response", "" if page_id is None else str(page_id), url or "", hashlib.sha256(payload).hexdigest())
    return name, [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], payload


def visible(html: str) -> str:
    """html with a space for each comment and hidden element; one that never ends hides nothing. Each kind's end is
    looked for in vain once, so the work is linear."""
    out, at, look, endless = [], 0, 0, set()
    while m := HIDDEN.search(html, look):
        name = (m[1] or "").lower()
        end = None if name in endless else re.compile(rf"</{name}\s*>" if name else "-->", re.I).search(html, m.end())
        if end is None:
            endless.add(name)
            look = m.start() + 1
            continue
        out += [html[at : m.start()], " "]
        at = look = end.end()
    return "".join([*out, html[at:]])


def plain_text(html: str) -> str:
    """Visible text: hidden elements, comments and tags go, block elements end lines, references are resolved."""
    text = visible(html)
    text = TAG.sub("", BREAK.sub("\n", text.replace("\n", " ")))
    text = entities.unescape(text) if "&" in text else text
    return LINES.sub("\n", BLANKS.sub(" ", text)).strip()


def derive(name: str, url: str | None, headers: list[tuple[str, str]], payload: bytes) -> list[tuple]:
    """Kind, id, sibling's id, block and payload digest of the two records derived from a response."""
    page = payload.decode("utf-8", "replace")
    source = digest(payload)
    ids = {kind: record_id(kind, name) for kind in ("metadata", "conversion")}
    title = TITLE.search(page)
    fields = [("source-payload-digest", source), *((f"source-header-{k.lower()}", v) for k, v in headers)]
    if title:
        fields.append(("title", " ".join(entities.unescape(title[1]).split())))
    fields += [("outlink", x) for x in LINK.findall(page)]
    metadata = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return [("metadata", ids["metadata"], ids["conversion"], metadata, source), ("conversion", ids["conversion"], ids["metadata"], plain_text(page), source)]


def derivatives(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> two records each."""

    def run(batches):
        for b in batches:
            for low in range(0, b.num_rows, 500):
                rows = []
                part = b.slice(low, 500)
                for page_id, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    name, headers, payload = response(page_id, url, html)
                    for kind, own, other, block, source in derive(name, url, headers, payload):
                        raw = block.encode()
                        rows.append((page_id, kind, own, name, other, url, digest(raw), source, len(raw), block))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)

    return pages.select(pages["page_id"].cast("long").alias("page_id"), "url", "html").mapInArrow(run, OUT)


def serialised(row: dict, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A derived record as WARC/1.1 bytes. date: of the response, for stored pages have none."""
    block = row["block"].encode()
    kind = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}[row["kind"]]
    head = [("WARC-Type", row["kind"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", date), ("WARC-Refers-To", row["refers_to"]), ("WARC-Concurrent-To", row["concurrent_to"])]
    # a URL with blanks or line breaks would end its header
    head += [("WARC-Target-URI", re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", row["target_uri"]))] if row["target_uri"] else []
    head += [("WARC-Block-Digest", row["block_digest"]), ("Content-Type", kind), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def members(records: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Derived records -> (record_id, member): a gzip member each, so that joined members are a .warc.gz file."""

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([r["record_id"] for r in rows], pa.string()), pa.array([gzip.compress(serialised(r, date), mtime=0) for r in rows], pa.binary())], names=["record_id", "member"])

    return records.mapInArrow(run, "record_id string, member binary")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in WARC bytes, gzipped or plain."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines)
        size = int(head["Content-Length"])
        yield head, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


def from_records(files: DataFrame) -> DataFrame:
    """files (path, content: WARC bytes, gzipped or plain) -> the two derivatives of each response record in them, which
    keep its id and date as they are; its HTTP headers become fields of the metadata. Other records have none."""

    def run(batches):
        for b in batches:
            for content in b.column("content").to_pylist():
                rows = []
                for head, block in parse(content or b""):
                    if head.get("WARC-Type") != "response":
                        continue
                    top, _, payload = block.partition(b"\r\n\r\n")
                    status, *lines = top.decode("latin-1").split("\r\n")
                    fields = [("status", status), *(line.split(":", 1) for line in lines if ":" in line)]
                    fields = [(k.strip(), v.strip()) for k, v in fields]
                    url, name = head.get("WARC-Target-URI"), head["WARC-Record-ID"]
                    for kind, own, other, text, source in derive(name, url, fields, payload):
                        raw = text.encode()
                        rows.append((None, kind, own, name, other, url, digest(raw), source, len(raw), text))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [()] * len(_OUT), _OUT, strict=True)], schema=_OUT)

    return files.select("content").mapInArrow(run, OUT)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    return derivatives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
