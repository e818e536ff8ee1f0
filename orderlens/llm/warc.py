"""Legacy ARC archives and their conversion to WARC.

``write_arcs`` stores pages as ARC files, ``read_arcs`` parses the header lines of
either ARC version and the lengths they declare, ``to_warc`` gives every record
the identifier, timestamp, type and digests that a WARC record needs, and
``write_warcs`` and ``read_warcs`` store and read those. Files written here are sequences
of gzip members, one record each, of bounded size, written and read through Spark's own
file sources, so they live wherever ``spark.checkpoint.dir`` does. Files read may be
plain or gzip with any number of records per member: records are found by their
declared lengths alone.

An HTTP answer to an ``http`` or ``https`` request becomes a response (or a revisit); any other record, such as a
name lookup, becomes a resource of the declared media type, whose payload is its whole
block. Of a WARC file, responses, revisits and resources are read; other types
describe requests or the file and give no row.

Responses with equal payloads are stored once: the one of the largest page id stays a
response and the others are revisits that refer to it. Equal payloads share a
digest and a length; the join that tells the others spreads each digest
over several tasks.

Defined cases: null html is an empty payload; a null or blank url becomes
``urn:page:<id>``, white space in a url is escaped; a null page id ranks below all others; of
repeated page ids the record with the larger identifier is the response; an empty
table gives none. Line breaks around records and gzip members are passed over. A malformed header line, a
record shorter than declared, bytes that are no gzip member and a digest that does not fit raise
an error that names them. Header lines are UTF-8, or else Latin-1; HTTP fields are Latin-1, split at the first colon,
lines without one are passed over and the first of repeated fields counts. A page id that is no integer
is null. A revisit without a stated payload length has a null length. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows, rows_in
from orderlens.session import fresh_dir, keep

ARCHIVE_BYTES = 4_000_000
CRAWL_TIME = "20240101000000"  # pages carry no time of their own
HOST = "0.0.0.0"
SALTS = 16
CRLF = b"\r\n"
GZIP = b"\x1f\x8b"
BLANK_LINE = re.compile(rb"\r?\n\r?\n")
DIGITS = re.compile("[0-9]+")
ARC_DATE = re.compile("[0-9]{12}([0-9]{2})?")
WEB_URL = re.compile("https?:|urn:page:", re.IGNORECASE)  # pages without a url are written under urn:page:
PAGE_ID = re.compile("-?[0-9]{1,19}")

# Fixed values of the formats.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
ARC_HEADINGS = {
    1: b"URL IP-address Archive-date Content-type Archive-length\n",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n",
}
PAGE_FIELD = "X-Page-Id"
SIZE_FIELD = "X-Payload-Length"


def member(data: bytes) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def unpacked(blob: bytes, step: int = 65_536) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether a member ends with them) of a gzip file; a plain file is its own only piece."""
    if not blob.startswith(GZIP):
        yield blob, True
        return
    view, at = memoryview(blob), 0
    while True:
        while at < len(view) and view[at] in CRLF:
            at += 1
        if at == len(view):
            return
        if view[at : at + 2] != GZIP:
            raise ValueError(f"byte {at} of an archive starts no gzip member")
        reader = zlib.decompressobj(31)
        while not reader.eof:
            if at >= len(view):
                raise ValueError("an archive ends inside a gzip member")
            data = reader.decompress(view[at : at + step])
            at = min(at + step, len(view)) - len(reader.unused_data)
            yield data, reader.eof


def members(blob: bytes) -> Iterator[bytes]:
    """The whole unpacked gzip members of a file."""
    parts = []
    for data, ends in unpacked(blob):
        parts.append(data)
        if ends:
            yield b"".join(parts)
            parts = []


class Content:
    """The unpacked bytes of an archive, taken by line or by length; members need not end where records do."""

    def __init__(self, blob: bytes):
        self.pieces = unpacked(blob)
        self.held, self.at = b"", 0

    def _next(self) -> bool:
        self.held, self.at = next(self.pieces, (None, True))[0], 0
        if self.held is None:
            self.held = b""
            return False
        return True

    def line(self) -> bytes:
        """The next line with its end; empty at the end of the archive."""
        parts = []
        while True:
            end = self.held.find(b"\n", self.at) + 1
            parts.append(self.held[self.at : end or len(self.held)])
            self.at = end or len(self.held)
            if end or not self._next():
                return b"".join(parts)

    def record_line(self) -> bytes:
        """The next line that is not blank, without its end."""
        while line := self.line():
            if line.strip():
                return line.rstrip(CRLF)
        return b""

    def take(self, length: int) -> bytes:
        """The next ``length`` bytes, or fewer at the end of the archive."""
        parts, left = [], length
        while left:
            if self.at == len(self.held) and not self._next():
                break
            parts.append(self.held[self.at : self.at + left])
            self.at += len(parts[-1])
            left -= len(parts[-1])
        return b"".join(parts)


def write_files(archives: DataFrame, path: str) -> None:
    """Each row (content binary) as one file. The bytes pass Spark's text writer unchanged; it adds one line break."""
    archives.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe_url(url: str | None, page) -> str:
    url = re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", (url or "").strip())
    return url or f"urn:page:{'' if page is None else page}"


def http_block(page, payload: bytes) -> bytes:
    page_line = b"" if page is None else f"{PAGE_FIELD}: {page}\r\n".encode()
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n" + page_line
    return head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload


def arc_file(name: str, version: int, pages: Iterable[tuple], limit: int) -> Iterator[bytes]:
    """ARC files of about ``limit`` bytes; offsets and names in version 2 lines are those of the packed file."""
    pages, number = iter(pages), 0
    page = next(pages, None)
    while page is not None:
        file = f"{name}-{number:05d}.arc.gz"
        about = f"{version} 0 spark\n".encode() + ARC_HEADINGS[version] + b"\n"
        head = f"filedesc://{file} {HOST} {CRAWL_TIME} text/plain"
        first = f"{head} {len(about)}\n" if version == 1 else f"{head} 200 - - 0 {file} {len(about)}\n"
        packed = bytearray(member(first.encode() + about))
        while page is not None and len(packed) < limit:
            page_id, url, html = page
            block = http_block(page_id, (html or "").encode())
            line = f"{safe_url(url, page_id)} {HOST} {CRAWL_TIME} text/html"
            if version == 2:
                line += f" 200 {hashlib.md5(block).hexdigest()} - {len(packed)} {file}"
            packed += member(f"{line} {len(block)}\n".encode() + block + b"\n")
            page = next(pages, None)
        yield bytes(packed)
        number += 1


def write_arcs(pages: DataFrame, path: str, limit: int = ARCHIVE_BYTES) -> None:
    """ARC files of all rows (page_id, url, html); scan partitions take turns between the two versions."""
    numbered = pages.select(F.spark_partition_id().alias("part"), "page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]):
        rows = rows_in(batches)
        first = next(rows, None)
        if first is not None:
            part = first[0]
            stream = (row[1:] for whole in ((first,), rows) for row in whole)
            for content in arc_file(f"pages-{part:05d}", 1 + part % 2, stream, limit):
                yield (content,)

    write_files(map_rows(numbered, run, "content binary", batch_rows=1), path)


def line_text(line: bytes) -> str:
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("latin-1")


def arc_fields(line: bytes, version: int, file: str) -> dict[str, str]:
    """The fields of a header line; only the url, the first of them, may hold spaces."""
    names, values = ARC_FIELDS[version], line_text(line).rsplit(" ", len(ARC_FIELDS[version]) - 1)
    fields = dict(zip(names, values))
    sound = len(values) == len(names) and DIGITS.fullmatch(fields["length"]) and ARC_DATE.fullmatch(fields["date"])
    if not sound:
        raise ValueError(f"{file}: malformed ARC header line {line[:200]!r}")
    return fields


def parse_arc(blob: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields, content) of each record; the first record is the version block.

    The version stands in the block that the first line introduces, so that line is read by the number of its fields.
    """
    content = Content(blob)
    line = content.record_line()
    if not line.startswith(b"filedesc://"):
        raise ValueError(f"not an ARC version block: {line[:200]!r}")
    file = line_text(line).split(" ")[0].removeprefix("filedesc://")
    fields = arc_fields(line, 2 if line.count(b" ") >= len(ARC_FIELDS[2]) - 1 else 1, file)
    version, number = 0, 0
    while True:
        block = content.take(int(fields["length"]))
        if len(block) < int(fields["length"]):
            raise ValueError(f"{file}: record {fields['url']} is shorter than its declared {fields['length']} bytes")
        if not version:
            told = block.split(b" ", 1)[0]
            version = int(told) if told.isdigit() else 0
            if version not in ARC_FIELDS:
                raise ValueError(f"not an ARC version block: {block[:200]!r}")
        yield fields | {"file": file, "number": number}, block
        line, number = content.record_line(), number + 1
        if not line:
            return
        fields = arc_fields(line, version, file)


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(head with its blank line, header fields by lower-case name, payload) of an HTTP response."""
    end = BLANK_LINE.search(block)
    head, payload = (block, b"") if end is None else (block[: end.end()], block[end.end() :])
    fields = {}
    for line in head.decode("latin-1").splitlines()[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return head, fields, payload


def page_of(value: str | None) -> int | None:
    """A page id as it stands in a header field."""
    if not value or not PAGE_ID.fullmatch(value):
        return None
    number = int(value)
    return number if -(2**63) <= number < 2**63 else None


def is_http(url: str, block: bytes) -> bool:
    return block.startswith(b"HTTP/") and WEB_URL.match(url) is not None


def warc_time(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def read_arcs(spark: SparkSession, path: str, with_block: bool = True) -> DataFrame:
    """WARC-ready records (record_id, page_id, uri, time, ip, kind, mime, payload_bytes, payload_digest[, block]) of ARC files.

    The identifier follows from the archive's name and the record's number in it,
    so converting again gives the same one. Version blocks describe the
    file and give no record here. ``kind`` is response or resource.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for (blob,) in rows_in(batches, 1):
            for fields, block in parse_arc(blob):
                if fields["url"].startswith("filedesc://"):
                    continue
                web = is_http(fields["url"], block)
                _, http, payload = http_parts(block) if web else (b"", {}, block)
                record = uuid.uuid5(uuid.NAMESPACE_URL, f"{fields['file']}#{fields['number']}")
                row = (
                    f"urn:uuid:{record}", page_of(http.get(PAGE_FIELD.lower())), safe_url(fields["url"], None), warc_time(fields["date"]),
                    fields["ip"], "response" if web else "resource", fields["mime"], len(payload), sha1(payload),
                )
                yield (*row, block) if with_block else row

    ddl = (
        "record_id string, page_id long, uri string, time string, ip string, kind string, mime string, "
        "payload_bytes long, payload_digest string"
    )
    return map_rows(read_files(spark, path), run, ddl + ", block binary" * with_block, batch_rows=200)


def to_warc(spark: SparkSession, arc_path: str, min_bytes: int = 0) -> DataFrame:
    """The records of ARC files with (refers_id, refers_page): null unless a revisit, else what it refers to."""
    light = read_arcs(spark, arc_path, with_block=False)
    leader = F.max(F.struct("page_id", "record_id")).alias("leader")
    shared = (
        light.filter((F.col("kind") == "response") & (F.col("payload_bytes") >= min_bytes))
        .groupBy("payload_digest", "payload_bytes")
        .agg(leader, F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", "payload_bytes", "leader")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    shared = keep(shared, "shared-payloads")
    salted = read_arcs(spark, arc_path).withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    joined = salted.join(shared, ["payload_digest", "payload_bytes", "salt"], "left")
    revisit = (F.col("leader.record_id") != F.col("record_id")) & (F.col("kind") == "response")
    return joined.select(
        "record_id", "page_id", "uri", "time", "ip", "kind", "mime", "payload_bytes", "payload_digest", "block",
        F.when(revisit, F.col("leader.record_id")).alias("refers_id"),
        F.when(revisit, F.col("leader.page_id")).alias("refers_page"),
    )


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block + CRLF + CRLF


def write_warcs(records: DataFrame, path: str, limit: int = ARCHIVE_BYTES) -> None:
    """WARC files of ``to_warc`` records; a revisit keeps the HTTP head and leaves the payload out."""

    def run(batches: Iterator[pa.RecordBatch]):
        packed = bytearray()
        for record, page, uri, time, ip, kind, mime, size, digest, block, refers_id, refers_page in rows_in(batches, 16):
            if not packed:
                info = b"software: spark\r\nformat: WARC File Format 1.1\r\n"
                fields = [("WARC-Type", "warcinfo"), ("WARC-Date", time), ("Content-Type", "application/warc-fields")]
                packed += member(warc_record([*fields, ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record)}>")], info))
            kind = kind if refers_id is None else "revisit"
            fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record}>"), ("WARC-Target-URI", uri), ("WARC-Date", time)]
            if ip not in ("", "-", HOST):
                fields.append(("WARC-IP-Address", ip))
            if refers_id is not None:
                block = http_parts(block)[0]
                profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                fields += [("WARC-Refers-To", f"<{refers_id}>"), ("WARC-Profile", profile), (SIZE_FIELD, str(size))]
                if refers_page is not None:
                    fields.append(("X-Refers-To-Page-Id", str(refers_page)))
            fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}")]
            fields.append(("Content-Type", mime if kind == "resource" else "application/http; msgtype=response"))
            packed += member(warc_record(fields, block))
            if len(packed) >= limit:
                yield (bytes(packed),)
                packed = bytearray()
        if packed:
            yield (bytes(packed),)

    write_files(map_rows(records, run, "content binary", batch_rows=1), path)


def warc_fields(lines: list[str]) -> dict[str, str]:
    """Header fields by lower-case name; a line that starts with white space goes on with the field before it."""
    fields, name = {}, ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()
    return fields


def parse_warc(blob: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record, by its declared length; the block digest must agree."""
    content = Content(blob)
    while version := content.record_line():
        lines = []
        while (line := content.line()).strip():
            lines.append(line_text(line.rstrip(CRLF)))
        fields = warc_fields(lines)
        name, length = fields.get("warc-record-id"), fields.get("content-length", "")
        if not version.startswith(b"WARC/") or not DIGITS.fullmatch(length):
            raise ValueError(f"malformed WARC record {name}, which starts with {version[:200]!r}")
        block = content.take(int(length))
        if len(block) < int(length):
            raise ValueError(f"WARC record {name} is shorter than its declared {length} bytes")
        told = fields.get("warc-block-digest", "")
        if told.startswith("sha1:") and told != f"sha1:{sha1(block)}":
            raise ValueError(f"{name}: the block differs from its digest")
        yield fields, block


def warc_row(fields: dict[str, str], block: bytes) -> tuple | None:
    """A row of ``read_warcs`` with its payload, or None for a record of another type."""
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit", "resource"):
        return None
    name, http, payload = fields.get("warc-record-id", ""), {}, block
    if kind != "resource" and block.startswith(b"HTTP/"):
        _, http, payload = http_parts(block)
    told = fields.get("warc-payload-digest", "")
    digest = told.removeprefix("sha1:") if told.startswith("sha1:") else None
    if kind == "revisit":
        size = fields.get(SIZE_FIELD.lower(), http.get("content-length", ""))
        size, payload = int(size) if DIGITS.fullmatch(size) else None, None
    else:
        size, own = len(payload), sha1(payload)
        if digest is not None and digest != own:
            raise ValueError(f"{name}: the payload differs from its digest")
        digest = own
    page, refers = page_of(http.get(PAGE_FIELD.lower())), page_of(fields.get("x-refers-to-page-id"))
    return page, size, digest, kind, refers, name.strip("<>"), fields.get("warc-target-uri", "").strip("<>"), payload


def read_warcs(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, target_uri[, payload]) of WARC files.

    A revisit has the length and the digest of the full payload, as far as its header tells them, and a null payload.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for (blob,) in rows_in(batches, 1):
            for record in parse_warc(blob):
                row = warc_row(*record)
                if row is not None:
                    yield row if with_payload else row[:-1]

    ddl = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "record_id string, target_uri string"
    )
    return map_rows(read_files(spark, path), run, ddl + ", payload binary" * with_payload, batch_rows=200)


def archive(pages: DataFrame, min_bytes: int = 0) -> tuple[str, str]:
    """Pages through ARC to WARC; returns both folders."""
    spark = pages.sparkSession
    arc_path, warc_path = fresh_dir(spark, "arc"), fresh_dir(spark, "warc")
    write_arcs(pages, arc_path)
    write_warcs(to_warc(spark, arc_path, min_bytes), warc_path)
    return arc_path, warc_path
