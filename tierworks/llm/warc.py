"""WARC files, and derivatives of their responses.

:func:`derive` turns each response record into two linked records: ``metadata`` (``application/warc-fields``: what the
response was, its title, its outlinks) and ``conversion`` (the plain text of the page). Both name the response in
``WARC-Refers-To`` and its address and date, the conversion is named by the metadata in ``WARC-Concurrent-To``, and the
source's HTTP headers and payload digest are carried on. Record ids follow from the response's id and the kind, so a
repeated run gives the same ones.

:func:`write_warc` lays records out as WARC/1.1 through Spark's text writer, which commits whole files on any store;
the two line ends that close a record are its line separator. :func:`read_warc` reads such files, plain or gzipped
(one member or one for each record), by the records' lengths.

Behaviour: null html is an empty payload, a null address leaves its header out; repeated rows give records of their
own with equal ids; an empty table gives an empty result; extra columns are not read. Line ends in addresses are
percent-encoded. Names of headers count in any case. Chunked and gzip, deflate or zstd bodies are decoded; responses that
are not text, or in another coding, have a metadata record only. Records of other types than response have no derivatives; a file cut off in the middle of a record
gives the records before it.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierworks.llm.html_text import all_blocks, attributes

END = "\r\n\r\n"
RECORD = "headers map<string,string>, block binary"
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tierworks:warc")
_TITLE = re.compile(r"<title(?=[\s/>])[^<>]*>", re.I)
_TITLE_END = re.compile(r"</title", re.I)
_HOST = re.compile(r"https?://[^/?#\s]+", re.I)
_HTML = re.compile(r"<html\s([^<>]*)>", re.I)
# Media types whose payload is text.
_TEXT_TYPES = re.compile(r"text/|application/(?:xhtml\+xml|xml|json|javascript)\b", re.I)


def responses(
    pages: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Response records (``headers``, ``block``) of stored pages; the row's id goes into ``X-Source-Row``."""
    url = F.regexp_replace(F.regexp_replace(F.col(url_col), "\r", "%0D"), "\n", "%0A")
    html = F.coalesce(F.col(html_col), F.lit(""))
    key = F.md5(F.concat_ws("\n", F.lit("response"), F.col(id_col).cast("string"), url, F.sha1(html)))
    name = F.concat_ws("-", *(F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(html).cast("string"), F.lit(END),
    )
    block = F.concat(head, html)
    headers = F.create_map(
        *(x for k, v in {
            "WARC-Type": F.lit("response"), "WARC-Record-ID": F.concat(F.lit("<urn:uuid:"), name, F.lit(">")),
            "WARC-Date": F.lit(date), "WARC-Target-URI": url, "X-Source-Row": F.col(id_col).cast("string"),
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.sha1(html)),
            "WARC-Block-Digest": F.concat(F.lit("sha1:"), F.sha1(block)),
            "Content-Type": F.lit("application/http; msgtype=response"),
            "Content-Length": F.octet_length(block).cast("string"),
        }.items() for x in (F.lit(k), v))
    )
    return pages.select(F.map_filter(headers, lambda _, v: v.isNotNull()).alias("headers"), block.cast("binary").alias("block"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip", records_per_file: int = 2000) -> None:
    """Writes records whose blocks are UTF-8 text."""
    lines = F.array_join(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\r\n")
    value = F.concat(F.lit("WARC/1.1\r\n"), lines, F.lit(END), F.col("block").cast("string"))
    fast = {"zlib.compress.level": "BEST_SPEED"}  # of Hadoop's gzip
    records.select(value.alias("value")).write.options(**fast).option("lineSep", END).option("maxRecordsPerFile", records_per_file).option(
        "compression", compression
    ).text(path)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each whole record."""
    if data[:2] == b"\x1f\x8b":
        try:
            data = gzip.decompress(data)
        except (EOFError, zlib.error):
            data = _as_far(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            return
        headers: dict[str, str] = {}
        last = None
        for line in data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in " \t" and last:
                headers[last] += " " + line.strip()
                continue
            last, _, value = line.partition(":")
            headers[last] = value.strip()
        size = next((int(v) for k, v in headers.items() if k.lower() == "content-length" and v.isdigit()), 0)
        if stop + 4 + size > len(data):
            return
        yield headers, data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size


def _as_far(data: bytes) -> bytes:
    """What can be unpacked of gzip members the last of which is cut off."""
    out = []
    while data[:2] == b"\x1f\x8b":
        tool = zlib.decompressobj(31)
        try:
            out.append(tool.decompress(data))
        except zlib.error:
            break
        data = tool.unused_data
    return b"".join(out)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records (``headers``, ``block``) of all WARC files in ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in parse_warc(content.as_py() or b""):
                    rows.append((list(headers.items()), block))
                    size += len(block)
                    if size > 1 << 22:
                        yield _record_batch(rows, kind)
                        rows, size = [], 0
                if rows:
                    yield _record_batch(rows, kind)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def _record_batch(rows, kind):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.binary())], names=["headers", "block"]
    )


def _unchunked(data: bytes) -> bytes:
    """The chunks of a chunked body, as far as they are whole."""
    out, at = [], 0
    while (stop := data.find(b"\r\n", at)) >= 0:
        size = data[at:stop].partition(b";")[0].strip()
        try:
            n = int(size, 16)
        except ValueError:
            break
        if n <= 0:
            break
        out.append(data[stop + 2 : stop + 2 + n])
        at = stop + 4 + n
    return b"".join(out)


def _unpacked(data: bytes, coding: str) -> bytes | None:
    """A body without its content coding; None for codings that are not known."""
    if coding in ("", "identity"):
        return data
    if coding in ("gzip", "x-gzip"):
        return _as_far(data)
    if coding == "deflate":
        for bits in (15, -15):  # with a header, or bare
            try:
                return zlib.decompressobj(bits).decompress(data)
            except zlib.error:
                pass
        return b""
    if coding == "zstd":
        try:
            return zstandard.ZstdDecompressor().stream_reader(data).read()
        except zstandard.ZstdError:
            return b""
    return None


def _text_of(http: dict[str, str], payload: bytes) -> str | None:
    """The text that a response carries, without chunks and content codings; None if it carries none."""
    kind = http.get("content-type", "")
    if kind and not _TEXT_TYPES.match(kind):
        return None
    if "chunked" in http.get("transfer-encoding", "").lower():
        payload = _unchunked(payload)
    for coding in reversed(http.get("content-encoding", "").lower().split(",")):
        payload = _unpacked(payload, coding.strip())
        if payload is None:
            return None
    charset = re.search(r"charset=\"?([\w-]+)", kind, re.I)
    try:
        return payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def _title(html: str) -> str | None:
    start = _TITLE.search(html)
    end = start and _TITLE_END.search(html, start.end())
    return " ".join(unescape(html[start.end() : end.start()]).split()) if end else None


def _derived(headers: dict[str, str], block: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The metadata and the conversion record of one response; a response without text has no conversion."""
    held = {k.lower(): v for k, v in headers.items()}
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    html = _text_of(http, payload)
    plain = html is not None and http.get("content-type", "").lower().startswith("text/plain")
    source, url, date = (held.get(k, "") for k in ("warc-record-id", "warc-target-uri", "warc-date"))
    digest = held.get("warc-payload-digest") or "sha1:" + hashlib.sha1(payload).hexdigest()
    name = {k: f"<urn:uuid:{uuid.uuid5(SPACE, f'{k} {source}')}>" for k in ("metadata", "conversion")}
    fields = [("source-record", source), ("source-payload-digest", digest), ("http-status", status)]
    fields += [(f"http-{k}", v) for k, v in http.items()]
    links: list[str] = []
    blocks = [html or ""] if plain or html is None else all_blocks(html, links)
    if html and not plain:
        title, tag = _title(html), _HTML.search(html)
        if title is not None:
            fields.append(("title", title))
        lang = attributes(tag[1]).get("lang") if tag else None
        if lang:
            fields.append(("language", lang))
    host = _HOST.match(url)
    for found in links:
        link = " ".join(found.split())
        if host and link[:1] == "/" and link[1:2] != "/" and "/." not in link:
            fields.append(("outlink", host[0] + link))
            continue
        try:
            fields.append(("outlink", urljoin(url, link)))
        except ValueError:
            fields.append(("outlink", link))
    text = "\n".join(blocks).encode("utf-8", "replace")
    about = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "replace")
    for kind, content, body in (
        ("metadata", "application/warc-fields", about), ("conversion", "text/plain; charset=utf-8", text),
    ):
        if kind == "conversion" and html is None:
            continue
        own = {"WARC-Type": kind, "WARC-Record-ID": name[kind], "WARC-Refers-To": source}
        for k, v in (("WARC-Target-URI", url), ("WARC-Date", date)):
            if v:
                own[k] = v
        if url:
            own["WARC-Refers-To-Target-URI"] = url
        if date:
            own["WARC-Refers-To-Date"] = date
        if html is not None:
            own["WARC-Concurrent-To"] = name["conversion" if kind == "metadata" else "metadata"]
        own["X-Source-Payload-Digest"] = digest
        own["X-Source-Content-Type"] = http.get("content-type", "")
        if "x-source-row" in held:
            own["X-Source-Row"] = held["x-source-row"]
        own["WARC-Block-Digest"] = "sha1:" + hashlib.sha1(body).hexdigest()
        own |= {"Content-Type": content, "Content-Length": str(len(body))}
        yield own, body


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records (``headers``, ``block``) of the responses among ``records``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = [
                    (list(own.items()), body)
                    for headers, block in zip(part.column(0), part.column(1))
                    for own, body in _derived(dict(headers.as_py()), block.as_py())
                ]
                yield _record_batch(rows, kind)

    response = "exists(map_entries(headers), e -> lower(e.key) = 'warc-type' and lower(e.value) = 'response')"
    wanted = records.where(f"headers is not null and block is not null and {response}")
    return wanted.select("headers", "block").mapInArrow(run, RECORD)
