"""WARC derivatives: from response records, a metadata and a plain-text conversion record each, linked to their source.

Responses come from a table of pages (``responses``) or from WARC files of any writer (``responses_of(read(...))``).
``derive`` gives for each response

* a ``metadata`` record (application/warc-fields): title, language, outlinks, the source's payload digest and its HTTP
  headers, and
* a ``conversion`` record (text/plain): the page's text,

both with ``WARC-Refers-To`` naming the response, its ``WARC-Target-URI`` and ``WARC-Date`` kept, and a
``WARC-Block-Digest`` of their own.  Two fields of our own, which other readers skip, hold the source's payload digest
and its id in the table.  ``write`` lays records out as ``.warc.gz`` files, each record a gzip member of its own, in
files of bounded bytes; ``read`` parses files a record at a time and checks the digests.

Identifiers are derived from content (SHA-1 based UUIDs), so a task that runs again writes the same records.  Pages are
scanned in time in proportion to their length.

Defined cases: null HTML counts as empty (the conversion's block is empty); null URLs give an empty target; null ids no
source id; repeated rows give records with the same identifiers; an empty table gives no files' records; other columns,
whatever their names, are ignored; whole pages are converted whatever their length; markup that is never closed is text.
Reading: field names in any case, folded lines and blank lines are taken; what is no record is skipped; a truncated file
gives the records before the cut; a record without a digest, or with one of an unknown kind, has a null ``intact``.
"""

from __future__ import annotations

import base64
import hashlib
import html
import io
import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailhead.llm import common

RESPONSE = "source_id string, record_id string, target_uri string, date string, http_headers string, payload binary"
RECORD = "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, source_id string, source_digest string, block_digest string, block binary"
FIELDS = {"WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Refers-To": "refers_to", "WARC-Target-URI": "target_uri", "WARC-Date": "date", "Content-Type": "content_type", "WARC-Source-ID": "source_id", "WARC-Source-Payload-Digest": "source_digest", "WARC-Block-Digest": "block_digest"}
NAMES = [f.split()[0] for f in RECORD.split(", ")]
MIXED_SPACE = re.compile(r"[ \t\r\f\v\xa0]+")
HIDING = re.compile(r"(?i)<!--|<(script|style|noscript|template|svg|head)\b")
CLOSING = {x: re.compile(rf"(?i)</{x}\s*>") for x in ("script", "style", "noscript", "template", "svg", "head")} | {"": re.compile("-->")}
BLOCKS = re.compile(r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>")
TAGS = re.compile(r"<[a-zA-Z/!?][^>]*>")
TITLE, TITLE_END = re.compile(r"(?i)<title\b[^>]*>"), re.compile(r"(?i)</title")
HTML_TAG, LANGUAGE = re.compile(r"(?i)<html\b[^>]*>"), re.compile(r"""(?i)\blang\s*=\s*["']?([\w-]+)""")
ANCHOR, HREF, VALUE = re.compile(r"(?i)<a\b[^>]*>"), re.compile(r"(?i)\bhref\s*=\s*"), re.compile(r""""([^"]*)"|'([^']*)'|([^\s>]+)""")
CHARSET = re.compile(rb"""(?i)charset\s*=\s*["']?([\w.:-]+)""")
NO_RECORDS = zlib.compressobj(9, zlib.DEFLATED, 31).flush()  # a gzip member of no bytes


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def agrees(block: bytes, said: str | None) -> bool | None:
    """Whether ``block`` has the digest ``said`` (sha1, sha256 or md5, in base 32 or 16); None where that can't be told."""
    kind, _, value = (said or "").partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5") or not value:
        return None
    raw = hashlib.new(kind.lower(), block, usedforsecurity=False).digest()
    return value.upper().rstrip("=") in (base64.b32encode(raw).decode().rstrip("="), raw.hex().upper())


def identifier(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def shown(page: str) -> str:
    """The page without comments, scripts, styles, templates, drawings and its head, each a space; a part that is never closed stays."""
    out, at, look, unclosed = [], 0, 0, set()
    while m := HIDING.search(page, look):
        kind = (m[1] or "").lower()
        end = None if kind in unclosed else CLOSING[kind].search(page, m.end())
        if end:
            out += [page[at : m.start()], " "]
            at = look = end.end()
        else:
            unclosed.add(kind)  # so it is searched for once only
            look = m.end()
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """Text of a page: a line for each block, entities resolved, scripts, styles, comments and the head left out."""
    body = shown(page)
    tagged = body.rfind(">") + 1  # no tag ends after this
    body = TAGS.sub("", BLOCKS.sub("\n", body[:tagged])) + body[tagged:]
    lines = (MIXED_SPACE.sub(" ", x).strip() for x in html.unescape(body).split("\n"))
    return "\n".join(x for x in lines if x)


def one_line(text: str) -> str:
    return " ".join(html.unescape(text).split())


def fields_of(page: str) -> list[tuple[str, str]]:
    """title, language and outlinks of a page."""
    tagged = page[: page.rfind(">") + 1]
    title = TITLE.search(tagged)
    title_end = TITLE_END.search(page, title.end()) if title else None
    found = [("title", one_line(page[title.end() : title_end.start()]) if title and title_end else "")]
    found += [("language", x[1]) for x in (LANGUAGE.search(t[0]) for t in HTML_TAG.finditer(tagged)) if x][:1]
    for tag in ANCHOR.finditer(tagged):
        if (h := HREF.search(tag[0])) and (v := VALUE.match(page, tag.start() + h.end())):
            found.append(("outlink", one_line(v[v.lastindex])))
    return found


def decoded(payload: bytes, headers: str) -> str:
    """The payload as text: by the charset of the HTTP headers, else of the page's first KB, else UTF-8; bad bytes are replaced."""
    m = CHARSET.search(headers.encode("utf-8", "replace")) or CHARSET.search(payload[:1024])
    try:
        return payload.decode(m[1].decode() if m else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Responses of a table with page_id, url, html."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    url, source = F.coalesce("url", F.lit("")), F.col("page_id").cast("string")
    key = F.sha2(F.concat_ws("\x00", F.coalesce(source, F.lit("")), url, F.sha2(payload, 256)).cast("binary"), 256)
    dashed = F.concat_ws("-", *[F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n"))
    return pages.select(source.alias("source_id"), F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"), headers.alias("http_headers"), payload.alias("payload"))


def rows_by(columns: list[str], schema: str, make, found: DataFrame, most: int = 256) -> DataFrame:
    """Rows that ``make`` gives for each row of ``found``'s columns, in Arrow batches of bounded rows."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(rows):
        import pyarrow as pa

        kinds = [{"binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}[f.split()[1]] for f in schema.split(", ")]
        for batch in rows:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                made = [r for row in zip(*[c.to_pylist() for c in part.columns], strict=True) for r in make(*row)]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=names)

    return found.select(*columns).mapInArrow(common.frugal("warc", run), schema)


def derivatives(source_id, record_id, target, date, headers, payload) -> list[tuple]:
    """The two records of one response."""
    record_id, target, date, headers, payload = record_id or "", target or "", date or "", headers or "", payload or b""
    source_digest, page = digest(payload), decoded(payload, headers)
    fields = [("source-digest", source_digest), *(("http-header", one_line(x)) for x in headers.split("\r\n") if x), *fields_of(page)]
    metadata = "".join(f"{k}: {v}\r\n" for k, v in fields if v)
    out = []
    for kind, content, text in (("metadata", "application/warc-fields", metadata), ("conversion", "text/plain; charset=utf-8", plain_text(page))):
        block = text.encode("utf-8", "replace")
        out.append((kind, identifier(kind, record_id), record_id, target, date, content, source_id, source_digest, digest(block), block))
    return out


def derive(found: DataFrame) -> DataFrame:
    """Metadata and conversion records of responses."""
    return rows_by([f.split()[0] for f in RESPONSE.split(", ")], RECORD, derivatives, found)


def response_records(found: DataFrame) -> DataFrame:
    """Responses as records of their own, to be written like any others."""

    def make(source_id, record_id, target, date, headers, payload):
        block = (headers or "").encode() + b"\r\n" + (payload or b"")
        yield "response", record_id, None, target, date, "application/http; msgtype=response", source_id, digest(payload or b""), digest(block), block

    return rows_by([f.split()[0] for f in RESPONSE.split(", ")], RECORD, make, found)


def http_parts(block: bytes) -> tuple[str, bytes]:
    """HTTP headers and payload of a response's block; chunks are joined and gzip or deflate is undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    headers = head.decode("utf-8", "replace") + "\r\n"
    said = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(":") for x in headers.split("\r\n")[1:])}
    if "chunked" in said.get("transfer-encoding", ""):
        parts, at = [], 0
        while (end := body.find(b"\r\n", at)) >= 0:
            size = body[at:end].split(b";")[0].strip()
            if not re.fullmatch(rb"[0-9a-fA-F]{1,8}", size) or int(size, 16) == 0:
                break
            parts.append(body[end + 2 : end + 2 + int(size, 16)])
            at = end + 4 + int(size, 16)
        body = b"".join(parts) or body
    if said.get("content-encoding") in ("gzip", "x-gzip", "deflate"):
        for window in (47, -15):
            try:
                return headers, zlib.decompressobj(window).decompress(body)
            except zlib.error:
                pass
    return headers, body


def responses_of(records: DataFrame) -> DataFrame:
    """Responses of read records: those of type ``response``."""

    def make(source_id, record_id, target, date, block):
        headers, payload = http_parts(block or b"")
        yield source_id, record_id, target, date, headers, payload

    return rows_by(["source_id", "record_id", "target_uri", "date", "block"], RESPONSE, make, records.where("warc_type = 'response'"))


def member(values: list, level: int) -> bytes:
    """One record (values in the order of RECORD) as a gzip member; header values lose their line breaks, empty ones are left out."""
    *said, block = values
    head = "".join(f"{k}: {' '.join(v.splitlines())}\r\n" for k, v in zip(FIELDS, said, strict=True) if v)
    block = block or b""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n") + z.flush()


def write(records: DataFrame, path: str, chunk_bytes: int = 1 << 22, chunks_per_file: int = 16, level: int = 5) -> None:
    """WARC/1.1 files ``*.warc.gz`` of at most ``chunks_per_file`` rows of members, a row being ``chunk_bytes`` or one record.

    Spark's text writer puts the rows out as they are.  Its separator is a zero byte: the last byte of a gzip member is the
    high byte of its length, which is zero for records under 16 MiB, so it is left to the separator; after a longer record
    an empty member is added.  Files are renamed by the driver in the end, for the writer names them ``.txt``."""
    spark = records.sparkSession

    def run(rows):
        import pyarrow as pa

        out, size = [], 0

        def row():
            data = b"".join(out if out[-1][-1:] == b"\0" else [*out, NO_RECORDS])
            return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], names=["value"])

        for batch in rows:
            for at in range(0, batch.num_rows, 256):
                for values in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True):
                    out.append(member(list(values), level))
                    size += len(values[-1] or b"") + 512
                    if size >= chunk_bytes:
                        yield row()
                        out, size = [], 0
        if out:
            yield row()

    made = records.select(*NAMES).mapInArrow(common.frugal("warc", run), "value binary")
    made.select(F.col("value").cast("string")).write.option("lineSep", "\x00").option("compression", "none").option("maxRecordsPerFile", chunks_per_file).text(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if name.startswith("part-") and name.endswith(".txt"):
            fs.rename(f.getPath(), hadoop.Path(folder, name[: -len(".txt")] + ".warc.gz"))


class Inflated(io.RawIOBase):
    """The bytes of gzip members one after the other, up to where the data are cut short or damaged."""

    def __init__(self, data: bytes, step: int = 1 << 14):
        self.data, self.at, self.step, self.z, self.out = memoryview(data), 0, step, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.out and self.at < len(self.data):
            part = self.data[self.at : self.at + self.step]
            self.at += len(part)
            try:
                self.out = self.z.decompress(part)
            except zlib.error:
                self.at = len(self.data)
            if self.z.eof:
                self.at -= len(self.z.unused_data)
                self.z = zlib.decompressobj(31)
        n = min(len(buffer), len(self.out))
        buffer[:n], self.out = self.out[:n], self.out[n:]
        return n


def parse(data: bytes):
    """(fields with lower-case names, block) of each whole record in a file's bytes, compressed or not, one at a time."""
    stream = io.BufferedReader(Inflated(data), 1 << 20) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        last = None
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[0] in " \t" and last:
                fields[last] += " " + text.strip()
            elif ":" in text:
                last, _, value = text.partition(":")
                last = last.strip().lower()
                fields[last] = value.strip()
        if not fields.get("content-length", "").isdecimal():
            continue
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            return  # cut short: what came before counts
        yield fields, block


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the files (``*.warc.gz``, ``*.warc``) under ``path``, with ``intact``: the block has the digest its header names.

    A task holds a file as it is stored and a few records; files that ``write`` makes are bounded, others should be."""

    def run(rows):
        import pyarrow as pa

        keys = [k.lower() for k in FIELDS]
        for batch in rows:
            for data in batch.column("content"):
                made, size = [], 0

                def table():
                    *columns, intact = zip(*made, strict=True)
                    arrays = [pa.array(c, pa.binary() if n == "block" else pa.string()) for c, n in zip(columns, NAMES, strict=True)]
                    return pa.RecordBatch.from_arrays([*arrays, pa.array(intact, pa.bool_())], names=[*NAMES, "intact"])

                for fields, block in parse(data.as_py()):
                    made.append((*[fields.get(k) for k in keys], block, agrees(block, fields.get("warc-block-digest"))))
                    size += len(block)
                    if len(made) == 512 or size >= 1 << 22:
                        yield table()
                        made, size = [], 0
                if made:
                    yield table()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc{.gz,}").load(path)
    return files.select("content").mapInArrow(common.frugal("warc", run), RECORD + ", intact boolean")
