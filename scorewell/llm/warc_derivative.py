"""WARC derivatives: metadata and plain-text conversion records of responses.

Each response gives a ``metadata`` record (source status, headers, digests,
title and outlinks) and, if its payload is text, a ``conversion`` record with
the plain text.  Both name the response in ``WARC-Refers-To``, keep its target
URI and date, and carry their own block digest; the metadata record also holds
the digest of the source payload, and the two name each other.  Record ids are
name-based on the source id, so a task that runs again makes the same records.

One row in, up to two rows out, no shuffle; memory is bounded by the longest
page.

Defined results: a null HTTP block is an empty one; a block without a blank
line is all payload, without status or headers; a payload of another type than
text gives the metadata record alone; a null record id is replaced by one named
after URI, date and block; null URI or date leaves that header out; repeated
rows give repeated records (same ids); an empty table gives an empty result;
only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import unused

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_TAG = r"(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+>"
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|"
                    r"header|hr|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b" + _TAG, re.I)
_ANY = re.compile(r"<[a-zA-Z/!?]" + _TAG + r"|<[a-zA-Z/!?][^>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")
_LINK = re.compile(r"<a\b[^>]*?\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)

COLUMNS = ["record_id", "target_uri", "warc_date", "http"]
OUT = ("warc_type string, derived_id string, refers_to string, target_uri string, warc_date string, "
       "payload_digest string, block_digest string, content_length bigint, headers string, block string")


def plain_text(page: str) -> str:
    """Visible text of a page: one line per block element, blanks collapsed."""
    t = _ANY.sub("", _BREAK.sub("\n", _HIDDEN.sub(" ", page)))
    return _LINES.sub("\n", _BLANKS.sub(" ", html.unescape(t))).strip()


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def split_http(http: bytes) -> tuple[str | None, list[tuple[str, str]], bytes]:
    """(status line, headers in order, payload) of an HTTP response block."""
    head, blank, payload = http.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return None, [], http
    status, *lines = head.decode(errors="replace").split("\r\n")
    fields: list[tuple[str, str]] = []
    for x in lines:
        if x[:1] in " \t" and fields:  # folded header
            fields[-1] = (fields[-1][0], fields[-1][1] + " " + x.strip())
        elif ":" in x:
            k, v = x.split(":", 1)
            fields.append((k.strip(), v.strip()))
    return status, fields, payload


def _decoded(payload: bytes, kind: str) -> str:
    """A payload by the charset of its content type (UTF-8 without one)."""
    charset = next((p.split("=", 1)[1].strip().strip('"') for p in kind.split(";")[1:] if p.strip().lower().startswith("charset=")), "utf-8")
    try:
        return payload.decode(charset, errors="replace")
    except LookupError:
        return payload.decode(errors="replace")


def _one_line(s: str) -> str:
    return " ".join(s.split())


def _head(fields: list[tuple[str, str | None]]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields if v is not None)


def derive(record_id: str | None, uri: str | None, date: str | None, http: str | bytes | None,
           given: list[tuple[str, str | None]] | None = None) -> list[tuple]:
    """The derivative records of one response, as rows of ``OUT``.  ``given`` are the
    source record's own WARC headers; its digests are kept as they are."""
    raw = http.encode() if isinstance(http, str) else http or b""
    if record_id is None:
        record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri}|{date}|{digest(raw)}')}>"
    status, fields, payload = split_http(raw)
    given = [(k, v) for k, v in given or [] if v is not None]
    of = {k.lower(): v for k, v in given}
    source_digest = of.get("warc-payload-digest") or digest(payload)
    kind = next((v for k, v in fields if k.lower() == "content-type"), "text/html")
    base = kind.split(";")[0].strip().lower()
    is_html = base in ("text/html", "application/xhtml+xml")
    ids = {k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id}#{k}')}>" for k in ("metadata", "conversion")}
    if is_html or base.startswith("text/"):
        page = payload.decode(errors="replace") if isinstance(http, str) else _decoded(payload, kind)
    text = plain_text(page) if is_html else page if base.startswith("text/") else None

    lines = [("source-record", record_id), ("source-status", status), ("source-payload-digest", source_digest)]
    if "warc-block-digest" in of:
        lines.append(("source-block-digest", of["warc-block-digest"]))
    lines += [("source-warc-header", f"{k}: {v}") for k, v in given]
    lines += [("source-header", f"{k}: {v}") for k, v in fields]
    if is_html:
        title = _TITLE.search(page)
        if title:
            lines.append(("title", html.unescape(title[1])))
        links = {}
        for m in _LINK.findall(_HIDDEN.sub(" ", page)):
            link = html.unescape(m[0] or m[1] or m[2])
            try:
                links[urljoin(uri or "", link)] = None
            except ValueError:
                links[link] = None
        lines += [("outlink", x) for x in links]
    if text is not None:
        lines.append(("conversion-record", ids["conversion"]))
    block = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in lines if v is not None)

    def record(warc_type: str, body: str, content_type: str) -> tuple:
        raw = body.encode()
        d = digest(raw)
        head = _head([("WARC-Type", warc_type), ("WARC-Record-ID", ids[warc_type]), ("WARC-Refers-To", record_id),
                      ("WARC-Concurrent-To", ids["metadata"] if warc_type == "conversion" else None),
                      ("WARC-Target-URI", uri), ("WARC-Date", date), ("Content-Type", content_type),
                      ("WARC-Block-Digest", d), ("Content-Length", str(len(raw)))])
        return (warc_type, ids[warc_type], record_id, uri, date, source_digest, d, len(raw), head, body)

    out = [record("metadata", block, "application/warc-fields")]
    if text is not None:
        out.append(record("conversion", text, "text/plain; charset=utf-8"))
    return out


def _slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of a column each."""
    end = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = end[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(end, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def derivatives(responses: DataFrame, keep: list[str] | None = None, headers: str | None = None) -> DataFrame:
    """Derivative records of response rows (record_id, target_uri, warc_date, http);
    ``keep`` columns are carried to every record (any names but those of the output).

    ``http`` may be text or the record's bytes; bytes are read by the charset they
    name, and digests are taken over them as they are.  ``headers`` names a
    map<string,string> of the source records' own WARC headers: they are listed in
    the metadata record, and a payload digest among them is carried through."""
    keep = keep or []
    binary = dict(responses.dtypes)["http"] == "binary"
    own = unused("_", [c for c in keep])
    src = responses.select(*[F.col(f"`{c}`") for c in keep], *[F.col(c).cast("string").alias(f"{own}{c}") for c in COLUMNS[:3]],
                           F.col("http").cast("binary" if binary else "string").alias(f"{own}http"),
                           (F.map_entries(headers) if headers else F.lit(None).cast("array<struct<key:string,value:string>>")).alias(f"{own}given"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scorewell.llm.textbytes import PIECE_BYTES
        types = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.string()]
        names = [x.split()[0] for x in OUT.split(", ")]
        for batch in batches:
            for b in _slices(batch, len(keep) + 3, PIECE_BYTES):
                rows, at = [], []
                for i, (*x, given) in enumerate(zip(*(b.column(len(keep) + k).to_pylist() for k in range(5)))):
                    got = derive(*x, given and [(h["key"], h["value"]) for h in given])
                    rows += got
                    at += [i] * len(got)
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).take(pa.array(at)) for k in range(len(keep))] + [pa.array(c, t) for c, t in zip(cols, types)],
                    names=[*keep, *names])

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:len(keep)])
    return src.mapInArrow(run, head + OUT)


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as gzipped WARC files, one per partition, by Spark's text
    writer: the line separator is the blank lines that end a record."""
    records.select(F.concat("headers", F.lit("\r\n"), "block").alias("value")) \
        .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
