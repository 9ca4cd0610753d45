"""WARC derivatives: metadata and plain-text conversion records of responses.

A response record yields two records that refer to it: ``metadata`` (JSON with
the response's WARC and HTTP headers, status, charset, title and links) and
``conversion`` (the page as plain text). Both carry the response's identifier as
``WARC-Refers-To``, with its URI and date, the response's payload digest, and
their own block digest. Their identifiers follow from the response's, so that a
repeated task makes the same records.

A record is a row ``(record_id, type, uri, date, headers, block)``: ``headers``
are all its named fields as written, one a line. Records come from files
(``read``), or are made from a table of pages (``responses``); ``write`` puts any
records into WARC files through Spark's text writer, the bytes untouched.

Defined cases: a null block is empty; records other than responses, and
responses without an HTTP head, keep an empty HTTP part and their block is read
as the page; bytes that don't fit the charset become U+FFFD; an unknown charset
is read as UTF-8; a truncated chunked or compressed body is read as far as it
goes, a body of several gzip members to the end of the last. A body of an encoding
that can't be undone (``br``, say) isn't converted: its text is empty, and the
metadata names the encoding as ``undecoded``. Pages with a null url have an empty URI. Repeated rows give repeated
records; an empty table gives an empty table; only the columns named above are
read.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import map_arrow, slices, table

VERSION = "WARC/1.1"
FIELDS = "record_id string, type string, uri string, date string, headers string, block binary"
BATCH = 1 << 20
GZIP, FED = b"\x1f\x8b", 1 << 16          # how members begin; bytes fed to the decoder at once
DECODED = ("gzip", "x-gzip", "deflate")
PAGE_DATE = "2024-01-01T00:00:00Z"
BREAKS = frozenset("""address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td
tfoot th thead title tr ul""".split())
SILENT = frozenset(("script", "style", "noscript", "template"))
# elements whose content is no markup, up to their own end tag: left out, or text
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in ("script", "style", "title", "textarea")}
MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S)
HREF = re.compile(r"""(?:^|\s)(?:href|src)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
META_CHARSET = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?\s*([a-zA-Z0-9_\-:.]+)""", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def derived_id(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {kind}')}>"


def fields_of(headers: str) -> dict[str, str | list[str]]:
    """Named fields, repeated ones as lists in their order, under the first
    spelling of the name; lines that go on are joined."""
    every: dict[str, tuple[str, list[str]]] = {}
    for line in re.sub(r"\r?\n[ \t]+", " ", headers or "").splitlines():
        name, colon, value = line.partition(":")
        if colon:
            every.setdefault(name.strip().lower(), (name.strip(), []))[1].append(value.strip())
    return {name: values[0] if len(values) == 1 else values for name, values in every.values()}


def field_values(fields: dict[str, str | list[str]], name: str) -> list[str]:
    found = next((v for k, v in fields.items() if k.lower() == name.lower()), [])
    return [found] if isinstance(found, str) else found


def field(fields: dict[str, str | list[str]], name: str) -> str:
    """The first value of a field, empty if there is none."""
    return next(iter(field_values(fields, name)), "")


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            break
        if size == 0:
            break
        out.append(body[end + 2:end + 2 + size])
        at = end + 4 + size
    return b"".join(out)


def members(data: bytes) -> Iterator[bytes]:
    """The plain bytes of each gzip member, one after the other, and of what
    follows the last. The data is fed in pieces, never copied as a whole; a
    member that breaks off is read as far as it goes."""
    view, at = memoryview(data), 0
    while data[at:at + 2] == GZIP:
        member, out = zlib.decompressobj(31), []
        try:
            while at < len(view) and not member.eof:
                piece = view[at:at + FED]
                out.append(member.decompress(piece))
                at += len(piece)
        except zlib.error:
            at = len(view)
        yield b"".join(out)
        at -= len(member.unused_data)
    if at < len(view):
        yield data[at:]


def _inflated(body: bytes, kind: str) -> bytes:
    """A body of one encoding, all its members."""
    if kind.endswith("gzip"):
        return b"".join(members(body)) if body[:2] == GZIP else body
    for bits in (15, -15):
        try:
            return zlib.decompressobj(bits).decompress(body)
        except zlib.error:
            continue
    return body


def encodings(fields: dict[str, str | list[str]]) -> list[str]:
    """The body's encodings in the order they were applied."""
    named = ",".join(field_values(fields, "Content-Encoding")).lower().split(",")
    return [x for x in map(str.strip, named) if x and x != "identity"]


def undecoded(fields: dict[str, str | list[str]]) -> str:
    """The encodings that can't be undone here, if any: then the body isn't text."""
    return ", ".join(x for x in encodings(fields) if x not in DECODED)


def http_parts(block: bytes) -> tuple[str, dict[str, str | list[str]], bytes, bytes]:
    """Status line, header fields, payload as sent, and the body decoded (empty
    if it has an encoding that can't be undone)."""
    if not block.startswith(b"HTTP/"):
        return "", {}, block, block
    head, _, payload = block.partition(b"\r\n\r\n")
    status, _, rest = head.decode("latin-1").partition("\r\n")
    fields = fields_of(rest)
    body = payload
    if "chunked" in ", ".join(field_values(fields, "Transfer-Encoding")).lower():
        body = _unchunked(body)
    if undecoded(fields):
        return status, fields, payload, b""
    for kind in reversed(encodings(fields)):
        body = _inflated(body, kind)
    return status, fields, payload, body


def charset_of(fields: dict[str, str | list[str]], body: bytes) -> str:
    named = re.search(r"charset\s*=\s*[\"']?([^\s;\"']+)", field(fields, "Content-Type"), re.I)
    meta = None if named else META_CHARSET.search(body[:4096])
    name = named[1] if named else meta[1].decode() if meta else "utf-8"
    try:
        return codecs.lookup(name).name
    except LookupError:
        return "utf-8"


def page_parts(page: str, uri: str) -> tuple[str, str, list[str]]:
    """Plain text (a line a block), title, and links in page order."""
    lines, run, links, title = [], [], [], ""
    at, silent = 0, ""

    def flush() -> str:
        line = " ".join("".join(run).split())
        run.clear()
        if line:
            lines.append(line)
        return line

    pos = 0
    while m := MARKUP.search(page, pos):
        tag, pos = (m[2] or "").lower(), m.end()
        raw = RAW[tag].search(page, pos) if tag in RAW and not m[1] else None
        if raw:
            pos = raw.end()
        if silent:                       # inside a template only its end counts
            if m[1] and tag == silent:
                silent, at = "", m.end()
            continue
        if m.start() > at:
            run.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if not tag:
            continue
        if tag in BREAKS:
            line = flush()
            if tag == "title" and m[1] and line and not title:
                title = line
        if m[1]:
            continue
        if raw:
            if tag not in SILENT:
                run.append(html.unescape(page[m.end():raw.start()]))
            if tag in BREAKS:
                line = flush()
                title = title or line
            at = pos
        elif tag in SILENT:
            silent = tag
        elif m[3] and tag in ("a", "area", "link", "img", "iframe"):
            for raw in HREF.findall(m[3]):
                try:
                    links.append(urljoin(uri, html.unescape(raw.strip("\"'")).strip()))
                except ValueError:
                    links.append(raw.strip("\"'"))
    if at < len(page) and not silent:
        run.append(html.unescape(page[at:]))
    flush()
    return "\n".join(lines), title, links


def _headers(named: list[tuple[str, str]]) -> str:
    return "\n".join(f"{k}: {v}" for k, v in named if v)


def derivatives(record_id: str, uri: str, date: str, headers: str, block: bytes) -> list[tuple]:
    """The metadata and the conversion record of one response."""
    own = fields_of(headers)
    status, fields, payload, body = http_parts(block)
    charset = charset_of(fields, body)
    text, title, links = page_parts(body.decode(charset, "replace"), uri)
    source_digest = field(own, "WARC-Payload-Digest") or digest(payload)
    about = {"refers_to": record_id, "uri": uri, "date": date, "warc_headers": own, "http_status": status,
             "http_headers": fields, "payload_digest": source_digest, "payload_length": len(payload),
             "charset": charset, "title": title, "links": links}
    if left := undecoded(fields):
        about["undecoded"] = left
    out = []
    for kind, media, made in (("metadata", "application/json", json.dumps(about, ensure_ascii=False).encode()),
                              ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"))):
        new_id = derived_id(record_id, kind)
        named = [("WARC-Type", kind), ("WARC-Record-ID", new_id), ("WARC-Target-URI", uri), ("WARC-Date", date),
                 ("WARC-Refers-To", record_id), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date),
                 ("WARC-Source-Payload-Digest", source_digest), ("WARC-Block-Digest", digest(made)),
                 ("Content-Type", media), ("Content-Length", str(len(made)))]
        out.append((new_id, kind, uri, date, _headers(named), made))
    return out


def response_of(url: str, page: bytes, ident: str, date: str = PAGE_DATE) -> tuple:
    """A response record of a page (made up of what a server would send)."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page)}\r\n\r\n").encode() + page
    record_id = derived_id(f"{url} {ident}", "response")
    named = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), ("WARC-Target-URI", url), ("WARC-Date", date),
             ("WARC-Payload-Digest", digest(page)), ("WARC-Block-Digest", digest(block)),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return record_id, "response", url, date, _headers(named), block


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


NAMES = ["record_id", "type", "uri", "date", "headers", "block"]
TYPES = [pa.string()] * 5 + [pa.binary()]


def responses(pages: DataFrame, ident: str = "page_id") -> DataFrame:
    """``(ident, record...)``: a response record of each page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(2).cast(pa.binary())
            for a, b in slices(source, BATCH):
                ids = batch.column(0).slice(a, b - a)
                rows = [response_of(u or "", s or b"", str(i)) for i, u, s in
                        zip(ids.to_pylist(), batch.column(1).slice(a, b - a).to_pylist(), source.slice(a, b - a).to_pylist())]
                made = _batch(rows, NAMES, TYPES)
                yield pa.RecordBatch.from_arrays([ids, *made.columns], names=[ident, *NAMES])

    kind = pages.schema[ident].dataType.simpleString()
    return map_arrow(pages.select(ident, "url", "html"), run, f"{ident} {kind}, {FIELDS}")


def derive(records: DataFrame, ident: str | None = None) -> DataFrame:
    """The derivatives of the response records, with column ``ident`` if given,
    and the identifier of the response as ``refers_to``."""
    first = [ident] if ident else []
    names = [*first, *NAMES, "refers_to", "source_digest", "http_status"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            blocks = get("block").cast(pa.binary())
            for a, b in slices(blocks, BATCH):
                part = [get(c).slice(a, b - a).to_pylist() for c in ("record_id", "uri", "date", "headers")]
                rows, at = [], []
                for i, (r, u, d, h, block) in enumerate(zip(*part, blocks.slice(a, b - a).to_pylist())):
                    for new in derivatives(r or "", u or "", d or "", h or "", block or b""):
                        source = fields_of(new[4])
                        rows.append((*new, r, source.get("WARC-Source-Payload-Digest"), http_parts(block or b"")[0]))
                        at.append(i)
                made = _batch(rows, names[len(first):], [*TYPES, pa.string(), pa.string(), pa.string()])
                ids = [get(ident).slice(a, b - a).take(pa.array(at, pa.int64()))] if ident else []
                yield pa.RecordBatch.from_arrays([*ids, *made.columns], names=names)

    kind = f"{ident} {records.schema[ident].dataType.simpleString()}, " if ident else ""
    return map_arrow(records.where(F.col("type") == "response").select(*first, *NAMES), run,
                     f"{kind}{FIELDS}, refers_to string, source_digest string, http_status string")


def wire(records: DataFrame) -> DataFrame:
    """Each record as it stands in a file, without the last line feed."""
    head = F.concat(F.lit(VERSION + "\r\n"), F.regexp_replace("headers", "\n", "\r\n"), F.lit("\r\n\r\n"))
    block = F.coalesce(F.col("block"), F.lit(b"")).cast("string")
    return records.select(F.concat(head, block, F.lit("\r\n\r")).alias("value"))


def write(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files under ``path``, one a partition."""
    wire(records).write.option("lineSep", "\n").option("compression", compression).text(path)


def parsed(data: bytes) -> Iterator[tuple]:
    """Records of a file's bytes, by their content lengths; files may consist of
    compressed members, each of whole records."""
    if data[:2] == GZIP:
        for plain in members(data):
            yield from parsed(plain)
        return
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers = "\n".join(data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        fields = fields_of(headers)
        try:
            size = int(field(fields, "Content-Length"))
        except ValueError:
            at = end
            continue
        yield (field(fields, "WARC-Record-ID"), field(fields, "WARC-Type"), field(fields, "WARC-Target-URI"),
               field(fields, "WARC-Date"), headers, data[end + 4:end + 4 + size])
        at = end + 4 + size


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files under a path. Spark hands a task one file at a
    time, so a file (about a gigabyte by custom) must fit in a worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for row in parsed(data.as_py() or b""):
                    rows.append(row)
                    held += len(row[5])
                    if held >= BATCH:
                        yield _batch(rows, NAMES, TYPES)
                        rows, held = [], 0
                yield _batch(rows, NAMES, TYPES)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return map_arrow(files, run, FIELDS)


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two derivative records of each page's response: identifiers, what they
    refer to, headers, sizes and digests."""
    made = derive(responses(table(spark, sf_dir, "pages")), "page_id")
    return made.select("page_id", "type", "record_id", "refers_to", F.col("uri").alias("target_uri"), "http_status",
                       F.octet_length("block").cast("long").alias("content_length"),
                       F.sha2("block", 256).alias("block_sha256"), "source_digest", "headers")
