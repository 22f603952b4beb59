"""WARC derivatives: metadata and plain-text conversion records of response records.

Every response gives two records that refer to it by its identifier, target and date. The metadata record keeps
the response's status line, HTTP headers and digests as warc-fields and names the conversion record; the conversion
record holds the page's text. Identifiers derive from the response's, so reruns agree. A record is one row and one
gzip member; members may be joined into files in any order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotkeeper.llm.html_blocks import read_blocks

VERSION = "WARC/1.1"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: The capture date of tables that carry none.
DATE = "2024-01-01T00:00:00Z"
_HEAD_END = re.compile(rb"</head|<body", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(31).join(parts))}>"


def header_value(value: str) -> str:
    """On one line: control characters would end a header."""
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {header_value(v)}\r\n" for k, v in headers)
    return f"{VERSION}\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """Records of a file, gzip members or plain."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no record at this place")
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        found.append((headers, data[end + 4:end + 4 + size]))
        at = end + 4 + size + 4
    return found


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of an HTTP response; all of it is body where there is no HTTP head."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("latin-1").split("\r\n")
    return status, [(k.strip(), v.strip()) for k, c, v in (line.partition(":") for line in lines) if c], body


def unchunked(body: bytes) -> bytes:
    """The content of chunks, as far as they go."""
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            break
        if not size:
            break
        parts.append(body[end + 2:end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(parts)


def content(body: bytes, headers: list[tuple[str, str]]) -> bytes | None:
    """A payload without its transfer and content encodings; None where one of them is unknown or broken."""
    for name in ("transfer-encoding", "content-encoding"):
        named = ",".join(v for k, v in headers if k.lower() == name).lower()
        for encoding in reversed([x.strip() for x in named.split(",") if x.strip()]):
            try:
                if encoding == "chunked":
                    body = unchunked(body)
                elif encoding in ("gzip", "x-gzip"):
                    body = gzip.decompress(body)
                elif encoding == "deflate":
                    body = zlib.decompress(body, zlib.MAX_WBITS if body[:1] == b"\x78" else -zlib.MAX_WBITS)
                elif encoding != "identity":
                    return None
            except (OSError, EOFError, zlib.error):
                return None
    return body


def is_text(headers: list[tuple[str, str]]) -> bool:
    """Whether a response is text by its type; one without a type counts as a page."""
    kind = next((v.split(";")[0].strip().lower() for k, v in headers if k.lower() == "content-type"), "")
    return not kind or kind.startswith("text/") or kind.endswith(("html", "xml", "json", "javascript"))


def decoded(body: bytes, headers: list[tuple[str, str]]) -> str:
    named = next((m[1] for k, v in headers if k.lower() == "content-type" and (m := _CHARSET.search(v))), None)
    if named is None:
        head = _HEAD_END.search(body)
        m = _CHARSET.search(body[:head.start() if head else len(body)].decode("latin-1"))
        named = m and m[1]
    try:
        return body.decode(named or "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: Column | str = DATE) -> DataFrame:
    """Response records of fetched pages: id, record_id, target_uri, date, block. Null pages have an empty body."""
    body = F.coalesce(F.encode(html_col, "UTF-8"), F.lit(b""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    seed = F.md5(F.concat_ws("\x1f", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(url_col, F.lit("")),
                             F.sha1(body)))
    name = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(seed, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    return pages.select(F.col(id_col).alias("id"), name.alias("record_id"), F.col(url_col).alias("target_uri"),
                        (F.lit(date) if isinstance(date, str) else date).alias("date"),
                        F.concat(F.encode(head, "UTF-8"), body).alias("block"))


FIELDS = ("warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
          "content_length long, block_digest string, source_digest string, headers string, block binary, member binary")


def derivatives(records: DataFrame, member: bool = True) -> DataFrame:
    """Two rows for every response of (id, record_id, target_uri, date, block): id and the record's fields; only metadata
    where the response is no text by its type, or in an encoding that is unknown or broken.

    ``source_digest`` is the digest of the response's payload. Null targets and dates leave their headers out, a null
    block is empty, a null record_id gets one from the block. Repeated rows give repeated records; other columns are
    ignored; an empty table gives none. ``member`` adds the gzip member; else it is null.
    """
    kind = records.schema["id"].dataType.simpleString()

    def build(source: str | None, target: str | None, date: str | None, block: bytes) -> Iterator[tuple]:
        status, http, body = split_http(block)
        payload = digest(body)
        source = source or record_id("response", target or "", date or "", payload)
        plain = content(body, http) if is_text(http) else None
        blocks = read_blocks(decoded(plain, http)) if plain is not None else []
        text = "\n".join(b.text for b in blocks).encode("utf-8", "replace")
        conversion, metadata = record_id("conversion", source), record_id("metadata", source)
        fields = [("source-record", source), ("source-block-digest", digest(block)), ("source-payload-digest", payload),
                  ("source-payload-length", str(len(body)))]
        if plain is not None:
            fields += [("conversion-record", conversion), ("conversion-block-digest", digest(text)), ("text-blocks", str(len(blocks)))]
        fields += [("source-status", status)] * bool(status) + [(f"source-header-{k.lower()}", v) for k, v in http]
        described = "".join(f"{k}: {header_value(v)}\r\n" for k, v in fields).encode("utf-8", "replace")
        made = [("metadata", metadata, "application/warc-fields", described)]
        if plain is not None:
            made.append(("conversion", conversion, "text/plain; charset=utf-8", text))
        for name, own, kind_of, data in made:
            headers = [("WARC-Type", name), ("WARC-Record-ID", own)]
            headers += [("WARC-Date", date)] * bool(date) + [("WARC-Target-URI", target)] * bool(target)
            headers += [("WARC-Refers-To", source)]
            headers += [("WARC-Refers-To-Target-URI", target)] * bool(target) + [("WARC-Refers-To-Date", date)] * bool(date)
            headers += [("WARC-Block-Digest", digest(data)), ("Content-Type", kind_of)]
            whole = serialise(headers, data)
            yield (name, own, source, target, date, kind_of, len(data), digest(data), payload,
                   whole[:whole.index(b"\r\n\r\n")].decode(), data, gzip.compress(whole, 6, mtime=0) if member else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                values = zip(*[batch.column(c).to_pylist() for c in ("record_id", "target_uri", "date", "block")])
                made = [(i, r) for i, v in enumerate(values) for r in build(*v[:3], v[3] or b"")]
                columns = list(zip(*[r for _, r in made])) or [()] * 12
                origin = pa.array([i for i, _ in made], pa.int64())
                types = [pa.int64() if i == 6 else pa.binary() if i >= 10 else pa.string() for i in range(12)]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(origin), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                                 ["id", *[f.split()[0] for f in FIELDS.split(", ")]])

    chosen = records.select("id", "record_id", "target_uri", F.col("date").cast("string").alias("date"), "block")
    return chosen.mapInArrow(run, f"id {kind}, {FIELDS}")
