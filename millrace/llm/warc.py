"""WARC derivatives: metadata and plain-text conversion records linked to the response they were made from.

A response is a row with ``record_id``, ``target_uri``, ``date``, further WARC headers and its HTTP block. Each gives
two records in WARC 1.1: ``metadata`` (application/warc-fields: title, language, character set, outlinks) and
``conversion`` (the text of the page). Both name the response in WARC-Refers-To, keep its target, its date as
WARC-Refers-To-Date and the digest of its payload, and carry digests of their own. Record ids are derived from the
source record and the kind, so that a task that runs again writes the same records. A page is scanned forward, in time
linear in its length whatever tags stay open in it. There is no shuffle.

Defined cases: null or empty html is an empty payload with an empty conversion; a null url gives records without a
target; rows that repeat a page give equal records; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat

VERSION = "WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of urls, as RFC 4122 has it

_HIDDEN = re.compile(r"<(script|style|template|noscript|head)\b|<!--|<!doctype", re.I)
_CLOSED = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "template", "noscript", "head")}
_BREAK = re.compile(r"<(?:/?(?:p|div|article|section|header|footer|nav|main|aside|ul|ol|li|table|tr|h[1-6]|pre|blockquote|title)|br|hr)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_TITLED = re.compile(r"</title", re.I)
_HTML = re.compile(r"<html\b[^>]*", re.I)
_META = re.compile(r"<meta\b[^>]*", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([\w-]+)", re.I)
_CHARSET = re.compile(r"\bcharset\s*=\s*[\"']?([\w-]+)", re.I)
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_VALUE = re.compile(r"\"([^\"]*)\"|'([^']*)'|([^\s>]+)")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(31).join(parts))}>"


def _line(text: str) -> str:
    return " ".join(text.split())


def visible(page: str) -> str:
    """The page with a space in place of comments, declarations and elements that are not shown.

    One scan forward: what never closes stays, and is not looked for again.
    """
    out, at, begin = [], 0, 0
    endless: set[str] = set()
    while found := _HIDDEN.search(page, at):
        name = (found[1] or found[0]).lower()
        end = -1
        if name not in endless:
            if name in _CLOSED:
                closed = _CLOSED[name].search(page, found.end())
                end = closed.end() if closed else -1
            else:
                mark = "-->" if name == "<!--" else ">"
                end = page.find(mark, found.end())
                end += len(mark) if end >= 0 else 0
        if end < 0:
            endless.add(name)
            at = found.end()
            continue
        out += [page[begin : found.start()], " "]
        begin = at = end
    return "".join([*out, page[begin:]])


def plain_text(page: str) -> str:
    """The text of a page: a line for each block, without scripts, styles and markup."""
    shown = visible(page)
    tagged = shown.rfind(">") + 1  # behind the last one no tag ends
    text = _TAG.sub("", _BREAK.sub("\n", shown[:tagged])) + shown[tagged:]
    lines = (_line(line) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def _attribute(page: str, tag: re.Pattern, attribute: re.Pattern) -> str | None:
    """The attribute of the first tag that has it."""
    values = (attribute.search(page, found.start(), found.end()) for found in tag.finditer(page))
    return next((value[1] for value in values if value), None)


def _links(page: str) -> Iterator[str]:
    at = end = 0
    while found := _ANCHOR.search(page, at):
        at = found.end()
        if at > end:
            end = page.find(">", at)
            end = len(page) if end < 0 else end
        named = _HREF.search(page, at, end)
        while named:
            value = _VALUE.match(page, named.end())
            if value:
                yield next(filter(None, value.groups()), "")
                break
            named = _HREF.search(page, named.end(), end)
        at = value.end() if named else end  # without a link in this tag there is none up to its end


def page_fields(page: str) -> list[tuple[str, str]]:
    """Named facts of a page, in the order in which they stand in a metadata record."""
    fields = []
    opened = _TITLE.search(page[: page.rfind(">") + 1])
    closed = opened and _TITLED.search(page, opened.end())
    if closed:
        fields.append(("title", _line(html.unescape(page[opened.end() : closed.start()]))))
    named = (("language", _attribute(page, _HTML, _LANG)), ("charset", _attribute(page, _META, _CHARSET)))
    fields += [(name, value) for name, value in named if value]
    return fields + [("outlink", _line(html.unescape(link))) for link in _links(page) if link.strip()]


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    named = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"{VERSION}\r\n{named}\r\n".encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; the inverse of ``serialise``."""
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


RESPONSES = "page_id long, record_id string, target_uri string, date string, headers map<string,string>, http binary"


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response rows of ``pages``; ``date`` is the time of capture, as the table has none."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    url = F.regexp_replace("url", r"[\r\n]", "")
    headers = F.create_map(F.lit("WARC-Identified-Payload-Type"), F.lit("text/html"))
    return pages.select(
        F.col("page_id").cast("long"),
        F.concat(
            F.lit("<urn:uuid:"),
            F.regexp_replace(
                F.md5(F.concat_ws("\x1f", F.lit(date), F.col("page_id").cast("string"), url, "html")),
                r"^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-3$3-8$4-$5",
            ),
            F.lit(">"),
        ).alias("record_id"),
        url.alias("target_uri"),
        F.lit(date).alias("date"),
        headers.alias("headers"),
        F.concat(F.encode(head, "UTF-8"), body).alias("http"),
    )


DERIVED = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, content_type string, "
    "content_length long, block_digest string, source_payload_digest string, record binary"
)
_NAMES = [part.split()[0] for part in DERIVED.split(", ")]
_KINDS = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.string(), pa.binary()]


def _derive(page_id, source, target, date, headers, http) -> Iterator[tuple]:
    _, _, payload = (http or b"").partition(b"\r\n\r\n")
    page = payload.decode("utf-8", "replace")
    of_payload = digest(payload)
    fields = "".join(f"{name}: {value}\r\n" for name, value in page_fields(page))
    made = (
        ("metadata", "application/warc-fields", fields.encode()),
        ("conversion", "text/plain; charset=utf-8", plain_text(page).encode()),
    )
    for kind, content_type, block in made:
        own = record_id(kind, source)
        named = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", own),
            ("WARC-Refers-To", source),
            *([("WARC-Target-URI", target), ("WARC-Refers-To-Target-URI", target)] if target else []),
            ("WARC-Date", date),
            ("WARC-Refers-To-Date", date),
            *((f"WARC-Source-{name.removeprefix('WARC-')}", value) for name, value in sorted(headers or [])),
            ("WARC-Source-Payload-Digest", of_payload),
            ("WARC-Block-Digest", digest(block)),
            ("Content-Type", content_type),
            ("Content-Length", str(len(block))),
        ]
        record = serialise(named, block)
        yield page_id, kind, own, source, target, content_type, len(block), digest(block), of_payload, record


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in flat.pieces(batch, "http", 4 << 20):
            rows = [out for row in zip(*(c.to_pylist() for c in part.columns)) for out in _derive(*row)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)


def derivatives(answers: DataFrame) -> DataFrame:
    """Two rows per response, each with the whole record and the fields that link it."""
    wanted = answers.select("page_id", "record_id", "target_uri", "date", "headers", "http")
    return wanted.mapInArrow(_derived, DERIVED)
