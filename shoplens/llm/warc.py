"""Derived records for web archives: metadata and plain text of responses.

Responses are WARC records of HTTP responses. From each, one ``metadata`` record
(links, title, language, and the source's headers and digests as warc-fields) and
one ``conversion`` record (its plain text) are made; both name the response in
WARC-Refers-To and keep its target and date. Record ids are derived from what the
record says, so a lost task makes the same records again. One pass, no shuffle.

Defined results: a page without html has an empty payload; a null url leaves the
target header out; records of types other than response derive nothing; malformed
markup is read as far as it goes (unclosed scripts and comments run to the end);
bytes that are no UTF-8 are replaced; repeated rows give records of equal ids; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns

DATE = "1970-01-01T00:00:00Z"
RECORD = ("record_id string, record_type string, refers_to string, target_uri string, date string, "
          "content_type string, block binary, block_digest string, payload_digest string")
DERIVED = f"source_key string, {RECORD}, outlinks int"

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|head|noscript|template)\b[^>]*+>.*?(?:</\1\s*+>|\Z)", re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*+>?""")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\Z)", re.S | re.I)
_TITLE = re.compile(r"<title\b[^>]*+>(.*?)(?:</title\s*+>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""")
_SPACE = re.compile(r"[ \t\r\f\v\xa0]+")
BLOCK_TAGS = frozenset("address article aside blockquote br body dd div dl dt fieldset figcaption figure footer form "
                       "h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section table tbody td tfoot th "
                       "thead tr ul".split())


def sha1_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def plain_text(markup: str) -> str:
    """Visible text: block elements end lines, white space runs are one space, empty
    lines go."""
    out, at = [], 0
    markup = _HIDDEN.sub(" ", markup)
    for m in _TAG.finditer(markup):
        out.append(markup[at:m.start()].replace("\n", " "))
        at = m.end()
        if m[2] and m[2].lower() in BLOCK_TAGS:
            out.append("\n")
    out.append(markup[at:].replace("\n", " "))
    lines = html.unescape("".join(out)).split("\n")
    return "\n".join(x for x in (_SPACE.sub(" ", x).strip() for x in lines) if x)


def page_fields(markup: str, base: str) -> tuple[str, str, list[str]]:
    """Title, language and outlinks (absolute, in order, repeats kept once)."""
    shown = _COMMENT.sub(" ", markup)
    title = _TITLE.search(shown)
    lang, links = "", {}
    for m in _TAG.finditer(shown):
        tag = (m[2] or "").lower()
        if m[1] or tag not in ("html", "a", "area", "link"):
            continue
        attributes = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(m[3])}
        if tag == "html":
            lang = lang or attributes.get("lang", "")
        elif attributes.get("href"):
            try:
                links[urljoin(base, attributes["href"].strip())] = None
            except ValueError:
                links[attributes["href"].strip()] = None
    text = _SPACE.sub(" ", html.unescape(title[1]).replace("\n", " ")).strip() if title else ""
    return text, lang, [re.sub(r"[\r\n]+", " ", x) for x in links]


def _headers(lines: list[str]) -> list[tuple[str, str]]:
    """Names and values, in order; a folded line goes on the one before."""
    out: list[tuple[str, str]] = []
    for x in lines:
        name, colon, value = x.partition(":")
        if x[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {x.strip()}".strip())
        elif colon and name.strip():
            out.append((name.strip(), value.strip()))
    return out


def _http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    return lines[0], _headers(lines[1:]), payload


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_RESPONSE_SCHEMA = pa.schema([(x.split()[0], {"binary": pa.binary(), "int": pa.int32()}.get(x.split()[1], pa.string()))
                              for x in f"source_key string, {RECORD}".split(", ")])
_DERIVED_SCHEMA = _RESPONSE_SCHEMA.append(pa.field("outlinks", pa.int32()))


def responses(pages: DataFrame, key: str = "page_id", date: str = DATE) -> DataFrame:
    """Response records of a table of fetched pages (key, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, url, payload in zip(*[c.to_pylist() for c in b.columns]):
                payload = payload or b""
                block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
                         "\r\n\r\n").encode() + payload
                digest, whole = sha1_digest(payload), sha1_digest(block)
                rows.append((k, record_id("response", k or "", url or "", date, whole), "response", None, url, date,
                             "application/http; msgtype=response", block, whole, digest))
            yield _batch(rows, _RESPONSE_SCHEMA)

    d = doc_columns(pages, {"k": key, "url": "url", "html": "html"})
    return d.select(F.col("k").cast("string"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary")) \
        .mapInArrow(run, f"source_key string, {RECORD}")


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of every response in ``records``; the metadata hold
    all HTTP headers, empty ones too, and the WARC fields of ``other_fields``, if there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                status, headers, payload = _http(r["block"] or b"")
                markup = payload.decode("utf-8", "replace")
                url, rid, date = r["target_uri"], r["record_id"], r["date"]
                title, lang, links = page_fields(markup, url or "")
                others = _headers((r.get("other_fields") or "").split("\r\n"))
                source = "".join(f"source-{k.lower()}: {v}\r\n" for k, v in headers + others)
                fields = [("source-block-digest", r["block_digest"]), ("source-payload-digest", r["payload_digest"]),
                          ("title", title), ("lang", lang), *[("outlink", x) for x in links]]
                meta = (f"source-status: {status}\r\n" if status else "") + source
                meta = (meta + "".join(f"{k}: {v}\r\n" for k, v in fields if v)).encode("utf-8", "replace")
                text = plain_text(markup).encode("utf-8", "replace")
                for kind, mime, block, n in (("metadata", "application/warc-fields", meta, len(links)),
                                             ("conversion", "text/plain; charset=utf-8", text, None)):
                    digest = sha1_digest(block)
                    rows.append((r["source_key"], record_id(kind, rid, digest), kind, rid, url, date, mime, block, digest,
                                 r["payload_digest"], n))
            yield _batch(rows, _DERIVED_SCHEMA)

    return records.filter("record_type = 'response'").mapInArrow(run, DERIVED)


def serialised(records: DataFrame) -> DataFrame:
    """One row a record: its header and block as WARC/1.1 text (column ``value``).
    Blocks of derived records are UTF-8."""
    header = F.concat_ws("\r\n", F.lit("WARC/1.1"), *[
        F.concat(F.lit(f"{name}: "), F.col(c)) for name, c in (
            ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
            ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"),
            ("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"))],
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")))
    return records.select(F.concat(header, F.lit("\r\n\r\n"), F.col("block").cast("string")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of the records, one a task, below ``path`` (any store Spark writes)."""
    serialised(records).write.option("lineSep", "\r\n\r\n").text(path)


_FIELDS = {"warc-type": "record_type", "warc-record-id": "record_id", "warc-refers-to": "refers_to",
           "warc-target-uri": "target_uri", "warc-date": "date", "content-type": "content_type",
           "warc-block-digest": "block_digest", "warc-payload-digest": "payload_digest"}


_START = re.compile(rb"(?:\A|(?<=\n))WARC/\d\.\d\r?\n")
_MEMBER = re.compile(rb"\x1f\x8b\x08")
_TOKEN = 16  # bytes kept back at the end of what was read, so that no start is cut in two
PIECE, STRAY, BATCH_BYTES = 1 << 20, 16 << 20, 32 << 20
LONGEST = (1 << 31) - (1 << 20)  # a block is one binary value


def _member(content: memoryview, at: int, ends: list[int]) -> Iterator[bytes]:
    """What the gzip member at ``at`` holds, in pieces; its end goes to ``ends``, unless the
    file ends first. Damage raises ``zlib.error``."""
    inflate, size = zlib.decompressobj(31), 1 << 14
    while not inflate.eof and at < len(content):
        fed = content[at:at + size]
        yield inflate.decompress(fed, PIECE)
        while inflate.unconsumed_tail:
            yield inflate.decompress(inflate.unconsumed_tail, PIECE)
        at += len(fed)
        size = min(PIECE, 2 * size)  # a small member leaves little behind it to copy
    if inflate.eof:
        ends.append(at - len(inflate.unused_data))
    else:
        yield inflate.flush()


def _before_damage(content: memoryview, at: int) -> Iterator[bytes]:
    """What a damaged gzip member gives before its damage."""
    inflate = zlib.decompressobj(31)
    for lo in range(at, len(content), 4096):
        before = inflate.copy()
        try:
            yield inflate.decompress(content[lo:lo + 4096])
            continue
        except zlib.error:
            pass
        try:  # again, byte by byte
            for i in range(lo, lo + 4096):
                yield before.decompress(content[i:i + 1])
        except zlib.error:
            return


def _pieces(content: memoryview) -> Iterator[tuple[int, str | None, bytes]]:
    """(part, damage, piece) of a file that may be gzip."""
    if bytes(content[:2]) != b"\x1f\x8b":
        for lo in range(0, len(content), PIECE):
            yield 0, None, bytes(content[lo:lo + PIECE])
        return
    part, at = 0, 0
    while at < len(content):
        held, size, ends, whole = [], 0, [], True
        try:  # a member counts when its checksum is right; only a short one's bytes are kept till then
            for piece in _member(content, at, ends):
                size += len(piece)
                held = [*held, piece] if size <= STRAY else []
        except zlib.error:
            whole = False
        if whole:
            for piece in held if size <= STRAY else _member(content, at, []):
                yield part, None, piece
            end = ends[0] if ends else len(content)
        else:
            for piece in _before_damage(content, at):
                yield part + 1, "damaged gzip member", piece
            part, end = part + 2, at + 1
        following = _MEMBER.search(content, end)
        stop = following.start() if following else len(content)
        if whole and bytes(content[end:stop]).strip(b"\0\r\n"):
            for lo in range(end, stop, PIECE):
                yield part + 1, "stray bytes", bytes(content[lo:min(stop, lo + PIECE)])
            part += 2
        at = stop


def inflated(content: bytes | memoryview) -> Iterator[tuple[Iterator[bytes], str | None]]:
    """The parts of a file that may be gzip, each as pieces to be read before the next part. Gzip
    goes member by member (the usual form has one a record): whole members that follow one
    another are one part. What a damaged member gives before its damage is a part of its
    own, and so are bytes between members that are no padding."""
    for (_, damage), group in groupby(_pieces(memoryview(content)), key=lambda x: x[:2]):
        yield (piece for *_, piece in group), damage


class _Stream:
    """The part of a byte stream that is being read: ``data`` from place ``at`` on."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.data, self.at, self.ended = iter(pieces), bytearray(), 0, False

    def grow(self) -> bool:
        piece = next(self.pieces, None)
        self.ended = piece is None
        self.data += piece or b""
        return not self.ended

    def cut(self) -> None:
        """Forgets what was read, but for the byte before ``at``."""
        drop = max(0, self.at - 1)
        del self.data[:drop]
        self.at -= drop

    def start(self, lo: int, most: int) -> re.Match | None:
        """The next record's first line at or after ``lo``, read on for ``most`` bytes."""
        seek = lo
        while True:
            found = _START.search(self.data, seek)
            if found or len(self.data) - lo > most:
                return found
            seek = max(lo, len(self.data) - _TOKEN)
            if not self.grow():
                return None

    def rest(self) -> int:
        """Where a piece without a start after it ends, as far as is known."""
        return len(self.data) if self.ended else len(self.data) - _TOKEN


def parse_records(pieces: Iterable[bytes], most: int = STRAY) -> Iterator[tuple[list[tuple[str, str]], bytes, str | None]]:
    """(fields, block, damage) of everything in a WARC stream: damage is null for a whole record, else
    says what is wrong with a piece. Empty lines between records are no damage. A record is
    held while it is read; damaged stretches of more than ``most`` bytes come as several pieces."""
    s = _Stream(pieces)
    while True:
        s.cut()
        found = s.start(s.at, most)
        begin = found.start() if found else s.rest()
        stray = bytes(s.data[s.at:begin])
        if stray.strip(b"\r\n"):
            yield [], stray, "stray bytes"
        s.at = begin
        if not found:
            if s.ended:
                return
            continue
        head = found.end()
        seek = begin
        while (end := s.data.find(b"\r\n\r\n", seek)) < 0 and len(s.data) - begin <= most:
            seek = max(begin, len(s.data) - 3)
            if not s.grow():
                break
        following = _START.search(s.data, head, end + 2 if end >= 0 else len(s.data))
        if end < 0 or following:
            s.at = following.start() if following else s.rest()
            yield [], bytes(s.data[begin:s.at]), "header cut short"
            continue
        named = _headers(s.data[head:end].decode("utf-8", "replace").split("\r\n"))
        length = {k.lower(): v for k, v in named}.get("content-length", "")
        body, damage = end + 4, "no length"
        if re.fullmatch("[0-9]{1,18}", length):
            size, damage = int(length), "block cut short" if int(length) <= LONGEST else "block too long"
            if size <= LONGEST:
                while len(s.data) < body + size and s.grow():
                    pass
                if len(s.data) >= body + size:
                    s.at = body + size
                    yield named, bytes(s.data[body:s.at]), None
                    continue
        following = s.start(body, most)
        s.at = following.start() if following else s.rest()
        yield named, bytes(s.data[body:s.at]), damage


_READ_SCHEMA = pa.schema([*list(_RESPONSE_SCHEMA)[1:], pa.field("other_fields", pa.string()), pa.field("damage", pa.string())])


def record_batches(content: bytes | memoryview, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A file's records in batches of some ``size`` bytes."""
    rows, held = [], 0
    for part, bad in inflated(content):
        for named, block, damage in parse_records(part):
            damage = bad or damage
            found = {k.lower(): v for k, v in named}
            others = [f"{k}: {v}" for k, v in named if k.lower() not in _FIELDS and k.lower() != "content-length"]
            values = {v: found.get(k) for k, v in _FIELDS.items()} | {
                "block": block, "other_fields": "\r\n".join(others), "damage": damage}
            if damage:
                values["record_type"] = None
            rows.append(tuple(values[f.name] for f in _READ_SCHEMA))
            held += len(block) + 1024
            if held >= size:
                yield _batch(rows, _READ_SCHEMA)
                rows, held = [], 0
    if rows:
        yield _batch(rows, _READ_SCHEMA)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, plain or gzip. A task holds one file as it is stored (2 GB at
    most); it is inflated and read in pieces, and records leave in batches. Fields without a
    column of their own are lines of ``other_fields``. Pieces that are no whole record are rows
    too: ``damage`` says why, ``block`` holds what there is, and record_type is null, so that nothing is
    derived from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                yield from record_batches(memoryview(content.as_buffer()))

    return spark.read.format("binaryFile").load(path).select("content") \
        .mapInArrow(run, f"{RECORD}, other_fields string, damage string")
