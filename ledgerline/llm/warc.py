"""WARC derivatives: response records become linked metadata and plain-text
conversion records.

A response row has record_id, target_uri, date, block (the HTTP message) and
headers (its other WARC headers, such as digests). Each gives a ``metadata``
record (application/warc-fields: HTTP status and headers, title, charset,
out-links, digests of source and text) and, if its payload is HTML or other text,
a ``conversion`` record (text/plain, UTF-8). Both refer to the response
(WARC-Refers-To, target URI, date) and carry the source's WARC headers and digests
on; ids are derived from the response's id and the kind, so a rerun or a retried
task gives the same records.

One narrow pass: no shuffle, each page is handled alone in its Arrow batch.

Defined cases: a NULL or empty block gives a metadata record only, without HTTP
fields; a NULL target URI or date leaves that header out; a body that was cut off
or damaged is decoded as far as it goes and its metadata say payload-truncated; one
that isn't of its named coding at all counts as no text; bytes that are not valid in the charset become
U+FFFD; repeated rows give repeated records; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
import zlib
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# fixed values: zlib's names for gzip, deflate as named and deflate without header; bytes decompressed at once
GZIP, ZLIB, RAW = 31, 15, -15
PIECE = 4096

CRAWL_DATE = "2024-01-01T00:00:00Z"

SCHEMA = (
    "record_id string, warc_type string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, source_headers map<string,string>, block binary"
)

# fixed values: HTML elements that start a new line of text
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # a whole name (not <svg-icon>); <svg .../> has no content and is an ordinary tag
    r"""|<(?!svg(?=[\s/>])(?:[^>"'=/]|/(?!>)|"[^"]*"|'[^']*'|=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)?)*+/>)"""
    r"(?P<hidden>script|style|noscript|template|textarea|svg)(?=[\s/>])[^>]*>.*?(?:</(?P=hidden)(?=[\s/>])[^>]*>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TITLE = re.compile(r"<title(?=[\s/>])[^>]*>(.*?)</title\s*>", re.S | re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
_TEXTUAL = ("text/", "application/xhtml", "application/xml", "application/json")


def digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def derived_id(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {kind}')}>"


def split_message(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP message."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        head, gap, body = block.partition(b"\n\n")
    lines = head.decode("latin-1").splitlines()
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in " \t" and headers:  # a folded line continues the one before
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            headers.append((name.strip(), value.strip()))
    return (lines[0] if lines else ""), headers, body


def _unchunk(body: bytes) -> tuple[bytes, bool]:
    """Joined chunks, and whether the last one is there."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else 0
        except ValueError:
            return body, True  # not chunked after all
        if not size:
            return b"".join(out), end >= 0
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _inflate(body: bytes, wbits: int) -> tuple[bytes | None, bool]:
    """What a compressed body yields, and whether it is whole; None if it isn't of that kind."""
    out: list[bytes] = []
    while body:
        stream, at, step = zlib.decompressobj(wbits), 0, PIECE
        while at < len(body) and not stream.eof:
            before = stream.copy()
            try:
                out.append(stream.decompress(body[at : at + step]))
                at += step
            except zlib.error:
                if step == 1:  # all up to the damaged byte is decoded
                    text = b"".join(out)
                    return (text if text and wbits != RAW else None), False
                stream, step = before, 1
        if not stream.eof:
            return b"".join([*out, stream.flush()]), False
        body = (stream.unused_data + body[at:]).lstrip(b"\0")
        if wbits != GZIP or not body.startswith(b"\x1f\x8b"):  # no further member
            break
    return b"".join(out), True


def decoded(headers: list[tuple[str, str]], body: bytes) -> tuple[bytes | None, bool]:
    """Body without transfer and content coding (None if it can't be undone), and whether it is whole."""
    low = {k.lower(): v.lower() for k, v in headers}
    whole = True
    if "chunked" in low.get("transfer-encoding", ""):
        body, whole = _unchunk(body)
    coding = low.get("content-encoding", "")
    if coding in ("", "identity"):
        return body, whole
    plain, ended = None, True
    if coding in ("gzip", "x-gzip"):
        plain, ended = _inflate(body, GZIP)
    elif coding == "deflate":
        plain, ended = _inflate(body, ZLIB)
        if plain is None:  # sent by many servers
            plain, ended = _inflate(body, RAW)
    return plain, whole and ended


def decoded_body(headers: list[tuple[str, str]], body: bytes) -> bytes | None:
    """Body without transfer and content coding; None if it can't be undone."""
    return decoded(headers, body)[0]


def html_parts(source: str) -> tuple[str, list[str]]:
    """Visible text, one line for each block of text with blanks folded, and the
    targets of <a href> as written, in one pass over the markup."""
    targets: list[str] = []

    def out(m: re.Match) -> str:
        tag = m["tag"]
        if not tag:
            return ""
        tag = tag.lower()
        if tag == "a" and not m["close"]:
            href = _HREF.search(m["attributes"])
            if href:
                targets.append(next(g for g in href.groups() if g is not None))
        return "\n" if tag in BLOCK_TAGS else ""

    lines = html.unescape(_MARKUP.sub(out, " ".join(source.split()))).split("\n")
    return "\n".join(t for t in (" ".join(line.split()) for line in lines) if t), targets


def html_text(source: str) -> str:
    return html_parts(source)[0]


def outlinks(targets: list[str], base: str | None) -> list[str]:
    """Absolute targets, in order, each once."""
    found: dict[str, None] = {}
    for target in targets:
        link = html.unescape(target).strip()
        try:
            found[urljoin(base or "", link)] = None
        except ValueError:
            found[link] = None
    return list(found)


def derive(record_id: str, uri: str | None, block: bytes | None, headers: dict[str, str]) -> list[tuple[str, str, bytes]]:
    """(kind, content type, block) of the records derived from one response."""
    fields: list[tuple[str, str]] = []
    text = None
    if block:
        status, http, body = split_message(block)
        fields.append(("http-status", status))
        fields += [(f"http-header-{name.lower()}", value) for name, value in http]
        kind = next((v for k, v in http if k.lower() == "content-type"), "text/html")
        plain, whole = decoded(http, body)
        if plain is not None and not whole:
            fields.append(("payload-truncated", "true"))
        if plain is not None and kind.lower().startswith(_TEXTUAL):
            named = _CHARSET.search(kind) or _CHARSET.search(plain[:1024].decode("latin-1"))
            charset = named[1].lower() if named else "utf-8"
            try:
                source = plain.decode(charset, "replace")
            except LookupError:
                charset, source = "utf-8", plain.decode("utf-8", "replace")
            fields.append(("charset", charset))
            if "html" in kind.lower():
                title = _TITLE.search(source)
                if title:
                    fields.append(("title", " ".join(html.unescape(title[1]).split())))
                text, targets = html_parts(source)
                fields += [("outlink", link) for link in outlinks(targets, uri)]
            else:
                text = source
        fields.append(("source-payload-digest", headers.get("WARC-Payload-Digest") or digest(body)))
    if block is not None:
        fields.append(("source-block-digest", headers.get("WARC-Block-Digest") or digest(block)))
    out = []
    if text is not None:
        data = text.encode("utf-8", "replace")
        fields.append(("conversion-record", derived_id(record_id, "conversion")))
        fields.append(("conversion-digest", digest(data)))
        out.append(("conversion", "text/plain; charset=utf-8", data))
    clean = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields)
    return [("metadata", "application/warc-fields", clean.encode("utf-8", "replace")), *out]


def derivatives(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records (columns of SCHEMA) of all response rows."""
    small_batches(responses.sparkSession)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                source = dict(r["headers"] or [])
                for kind, content, data in derive(r["record_id"] or "", r["target_uri"], r["block"], source):
                    rows.append((derived_id(r["record_id"] or "", kind), kind, r["record_id"], r["target_uri"], r["date"], content, len(data), digest(data), list(source.items()), data))
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return responses.select("record_id", "target_uri", "date", "headers", F.col("block").cast("binary").alias("block")).mapInArrow(run, SCHEMA)


def warc_bytes(record: dict) -> bytes:
    """A derived record as it stands in a WARC file."""
    head = [("WARC-Type", record["warc_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Refers-To", record["refers_to"]), ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["date"])]
    head += [(f"X-Source-{k}", v) for k, v in sorted((record["source_headers"] or {}).items())]
    head += [("WARC-Block-Digest", record["block_digest"]), ("Content-Type", record["content_type"]), ("Content-Length", str(record["content_length"]))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None).encode() + b"\r\n" + record["block"] + b"\r\n\r\n"


def responses_of_pages(pages: DataFrame, date: str = CRAWL_DATE) -> DataFrame:
    """Response records of raw pages (page_id, url, html), with the headers a crawler would write."""
    body = F.encode("html", "utf-8")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.length(body).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(F.encode(head, "utf-8"), body)
    key = F.sha2(F.concat_ws("|", F.col("page_id").cast("string"), "url"), 256)
    record = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.substring(key, 1, 32), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))
    digests = F.create_map(
        F.lit("WARC-Block-Digest"), F.concat(F.lit("sha256:"), F.sha2(block, 256)), F.lit("WARC-Payload-Digest"), F.concat(F.lit("sha256:"), F.sha2(body, 256)), F.lit("Content-Type"), F.lit("application/http; msgtype=response")
    )
    return pages.select(record.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.when(F.col("html").isNotNull(), digests).alias("headers"), block.alias("block"))
