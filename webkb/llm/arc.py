"""Legacy archives: ARC files converted to WARC, with revisits for equal payloads.

An ARC file opens with a version block that names the version and the fields
of its record lines: five fields in version 1, ten in version 2, the declared
length last in both. Each record is such a line and as many bytes as declared.
The conversion gives each record what WARC asks for and ARC lacks: an
identifier, an ISO timestamp, a record type and digests. Identifiers are made
from the record's content, so reruns and retried tasks give the same ones.

Records with equal payloads of some size are written once as ``response``;
the others become ``revisit`` records that refer to it. The choice is made on
narrow rows (digest, size, order); payloads move once, to meet their choice.
Spark's text writer writes the WARC files: a row is the records of one file,
and the two line breaks that end a record are the writer's line separator.
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

from webkb.llm.common import cut, slices, utf8
from webkb.session import scratch_path

#: The fields of a record line by ARC version.
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD = "archive string, url string, ip string, date string, type string, content binary"
#: What ends a WARC record.
END = "\r\n\r\n"
#: The header by which a fetched page carries its number through the archives.
ORDER_HEADER = b"x-page-id"


# ---- ARC

def arc_record(version: int, url: str, date: str, kind: str, content: bytes, archive: str, offset: int) -> bytes:
    values = {"url": url, "ip": "0.0.0.0", "date": date, "type": kind, "status": "200", "checksum": "-",
              "location": "-", "offset": str(offset), "filename": archive, "length": str(len(content))}
    return " ".join(values[f] for f in FIELDS[version]).encode() + b"\n" + content + b"\n"


def arc_head(version: int, archive: str, date: str) -> bytes:
    names = {1: "URL IP-address Archive-date Content-type Archive-length",
             2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
    block = f"{version} 0 crawl\n{names[version]}\n".encode()
    return arc_record(version, f"filedesc://{archive}", date, "text/plain", block, archive, 0)


class Pieces:
    """Bytes that come in pieces, of which little more than what is looked at is held."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.data, self.at, self.gone = iter(pieces), bytearray(), 0, 0

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        del self.data[:self.at]
        self.gone += self.at
        self.at = 0
        self.data.extend(piece)
        return True

    def has(self, size: int) -> bool:
        while len(self.data) - self.at < size:
            if not self.more():
                return False
        return True

    def skip_breaks(self) -> bool:
        """Past line breaks; False where nothing follows."""
        while self.has(1):
            if self.data[self.at] not in b"\r\n":
                return True
            self.at += 1
        return False

    def upto(self, mark: bytes) -> bytes | None:
        """What comes before the next ``mark``, which is passed; None where there is none."""
        seen = 0
        while (end := self.data.find(mark, self.at + seen)) < 0:
            seen = max(len(self.data) - self.at - len(mark) + 1, 0)
            if not self.more():
                return None
        out = bytes(self.data[self.at:end])
        self.at = end + len(mark)
        return out

    def take(self, size: int) -> bytes:
        out = bytes(self.data[self.at:self.at + size])
        self.at += size
        return out


def parse_arc(data: bytes | Iterable[bytes]) -> Iterator[dict]:
    """The records of one archive, whole or in pieces, the version block aside.
    A line or length that doesn't fit the archive's version raises ValueError."""
    data, version = Pieces([data] if isinstance(data, bytes) else data), None
    while data.skip_breaks():
        at = data.gone + data.at
        line = (data.upto(b"\n") or b"").rstrip(b"\r").decode("utf-8", "replace").split(" ")
        if version is None:
            if not line[0].startswith("filedesc:") or not line[-1].isdigit():
                raise ValueError("an ARC file starts with its version block")
            data.has(int(line[-1]))
            version = int(data.take(int(line[-1])).split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version}")
            continue
        fields = FIELDS[version]
        if len(line) != len(fields) or not line[-1].isdigit():
            raise ValueError(f"not a version {version} record line at byte {at}")
        record = dict(zip(fields, line))
        length = int(record["length"])
        if not data.has(length):
            raise ValueError(f"record at byte {at} declares {length} bytes, {len(data.data) - data.at} are left")
        record["content"] = data.take(length)
        yield record


def arc_files(spark: SparkSession, path: str) -> DataFrame:
    """ARC files, plain or gzipped, as rows ``archive, content``."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")


def records(archives: DataFrame) -> DataFrame:
    """Archives (archive, content) to one row per record: ``archive, url, ip,
    date, type, content``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "content"):
            for archive, data in zip(batch.column("archive").to_pylist(), batch.column("content").to_pylist()):
                rows, held = [], 0
                data = data or b""
                for r in parse_arc(_inflated(data) if data[:2] == b"\x1f\x8b" else data):
                    rows.append((archive, r["url"], r["ip"], r["date"], r["type"], r["content"]))
                    held += len(r["content"])
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return archives.select("archive", "content").mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["archive", "url", "ip", "date", "type", "content"])


def _inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Gzip members one after the other, in pieces."""
    at = 0
    while at < len(data):
        z, spent = zlib.decompressobj(31), at
        while not z.eof and spent < len(data):
            out = z.decompress(data[spent:spent + step])
            spent += step
            if out:
                yield out
        if not z.eof:
            raise ValueError("a gzip member ends early")
        at = min(spent, len(data)) - len(z.unused_data)
        while data[at:at + 1] == b"\0":
            at += 1


# ---- HTTP and WARC

def split_http(content: bytes) -> tuple[bytes, bytes]:
    """Header block (with its blank line) and payload; no header block where the content isn't HTTP."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    m = re.search(rb"\r?\n\r?\n", content)
    return (content[:m.end()], content[m.end():]) if m else (content, b"")


def http_header(head: bytes, name: bytes) -> bytes | None:
    for line in head.split(b"\n")[1:]:
        key, found, value = line.partition(b":")
        if found and key.strip().lower() == name:
            return value.strip()
    return None


def record_id(*parts: bytes) -> str:
    """A name-based identifier: equal parts, equal identifier."""
    return str(uuid.UUID(bytes=hashlib.sha1(b"\0".join(parts)).digest()[:16], version=5))


def iso_date(date: str) -> str:
    """ARC's 14 digits (or fewer: the rest is the earliest) to WARC's timestamp."""
    d = date + "00000101000000"[len(date):] if len(date) < 14 else date[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _described(found: DataFrame) -> DataFrame:
    """Records with what WARC needs: ``id, order, payload_bytes, digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "content"):
            out = []
            for url, date, content in zip(*(batch.column(c).to_pylist() for c in ("url", "date", "content"))):
                head, payload = split_http(content)
                order = http_header(head, ORDER_HEADER)
                digest = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
                out.append((record_id(url.encode(), date.encode(), head, digest.encode()),
                            int(order) if order else None, len(payload), digest))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("url", "date", "type", "content")), pa.array(columns[0], pa.string()),
                 pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                names=["url", "date", "type", "content", "id", "order", "payload_bytes", "digest"])

    return found.select("url", "date", "type", "content").mapInArrow(
        run, "url string, date string, type string, content binary, id string, order long, payload_bytes long, digest string")


def warc_record(url: str, date: str, kind: str, content: bytes, ident: str, digest: str, original: dict | None) -> bytes:
    """One WARC record, without the two line breaks that end it."""
    head, payload = split_http(content)
    sha1 = lambda b: base64.b32encode(b).decode()
    block = content
    lines = ["WARC/1.0"]
    if original:
        block = head
        lines += ["WARC-Type: revisit", f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{original['id']}>",
                  f"WARC-Refers-To-Target-URI: {original['url']}", f"WARC-Refers-To-Date: {iso_date(original['date'])}"]
    else:
        lines.append("WARC-Type: response" if head else "WARC-Type: resource")
    lines += [f"WARC-Record-ID: <urn:uuid:{ident}>", f"WARC-Date: {iso_date(date)}", f"WARC-Target-URI: {url}",
              f"WARC-Payload-Digest: sha1:{sha1(bytes.fromhex(digest))}",
              f"WARC-Block-Digest: sha1:{sha1(hashlib.sha1(block, usedforsecurity=False).digest())}",
              "Content-Type: " + ("application/http;msgtype=response" if head else kind), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def convert(archives: DataFrame, path: str, revisit_bytes: int = 1000, file_bytes: int = 16 << 20) -> None:
    """Write the records of ARC ``archives`` (archive, content) as gzipped WARC files under ``path``,
    each of about ``file_bytes`` bytes before compression, or of one larger record.

    Of the records with equal payloads of at least ``revisit_bytes`` bytes the
    one with the largest order number (the ``X-Page-Id`` header) is written in
    full, and every record of another number revisits it. Records without a
    number are written in full unless a numbered one has their payload.
    """
    found = _described(records(archives))
    originals = cut(found.filter(F.col("payload_bytes") >= revisit_bytes).groupBy("digest", "payload_bytes").agg(
        F.max(F.struct("order", "id", "url", "date")).alias("original"), F.count("*").alias("n"))
        .filter("n > 1 and original.order is not null").select(
            F.col("digest").alias("of"), F.col("payload_bytes").alias("of_bytes"), "original"), "arc-originals")
    joined = found.join(originals, (F.col("digest") == F.col("of")) & (F.col("payload_bytes") == F.col("of_bytes")), "left")
    original = F.when(~F.col("order").eqNullSafe(F.col("original.order")), F.col("original"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["url", "date", "type", "content", "id", "digest", "original"]
        file, size = [], 0
        for batch in slices(batches, "content"):
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                record = warc_record(*row)
                if file and size + len(record) > file_bytes:
                    yield _file(file)
                    file, size = [], 0
                file.append(record)
                size += len(record)
        if file:
            yield _file(file)

    warc = joined.select("url", "date", "type", "content", "id", "digest", original.alias("original")).mapInArrow(
        run, "records binary")
    (warc.select(F.col("records").cast("string").alias("value")).write.option("lineSep", END)
     .option("compression", "gzip").option("maxRecordsPerFile", 1).text(path))


def _file(file: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([END.encode().join(file)], pa.binary())], names=["records"])


def parse_warc(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record, by declared lengths,
    holding little more than one record and one piece at a time."""
    data = Pieces(pieces)
    while data.skip_breaks():
        head = data.upto(b"\r\n\r\n")
        if head is None:
            raise ValueError("a WARC record ends within its header")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(headers["content-length"])
        if not data.has(length):
            raise ValueError("a WARC record ends before its declared length")
        yield headers, data.take(length)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """The WARC files under ``path``, one row per record: ``id, type, page_id,
    payload_bytes, payload_digest, refers_to_id``. Digests of payloads that are
    there are checked against the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "type", "page_id", "payload_bytes", "payload_digest", "refers_to_id"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in slices(batches, "content"):
            rows = []
            for data in batch.column("content").to_pylist():
                for headers, block in parse_warc(_inflated(data)):
                    head, payload = split_http(block)
                    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    order, size = http_header(head, ORDER_HEADER), len(payload)
                    if headers["warc-type"] == "revisit":
                        size = int(http_header(head, b"content-length"))
                    elif hashlib.sha1(payload, usedforsecurity=False).hexdigest() != digest:
                        raise ValueError(f"{headers['warc-record-id']}: the payload isn't what its digest says")
                    rows.append((headers["warc-record-id"], headers["warc-type"], int(order) if order else None, size,
                                 digest, headers.get("warc-refers-to")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
            .filter(F.length("content") > 0).mapInArrow(run, "id string, type string, page_id long, payload_bytes long, "
                                                        "payload_digest string, refers_to_id string"))


# ---- pages through legacy archives

def pages_to_arc(pages: DataFrame, date: str = "20240101000000", archive_bytes: int = 4 << 20) -> DataFrame:
    """``pages`` (page_id, url, html) as ARC archives of about
    ``archive_bytes`` bytes, version 1 and 2 in turn: ``archive, content``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, batch in enumerate(slices(batches, "html", archive_bytes)):
            version, name = 1 + i % 2, f"part-{i}.arc"
            parts = [arc_head(version, name, date)]
            size = len(parts[0])
            for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = utf8(html)
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if page_id is not None:
                    head += b"X-Page-Id: %d\r\n" % page_id
                content = head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
                target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "about:blank"
                parts.append(arc_record(version, target, date, "text/html", content, name, size))
                size += len(parts[-1])
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(parts)], pa.binary())],
                                             names=["archive", "content"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "archive string, content binary")


def archive_pages(pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html), from WARC files that
    were converted from ARC archives of the pages, written and read back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A NULL html is an empty payload and a NULL url is ``about:blank``. Rows
    that repeat the largest page_id of a payload are all responses; rows
    without a page_id revisit a numbered row of the same payload, and are
    responses where there is none. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    convert(pages_to_arc(pages), path, revisit_bytes)
    rows = cut(read_back(spark, path), "warc-rows")
    targets = cut(rows.filter("type != 'revisit'").groupBy(F.col("id").alias("target")).agg(
        F.max("page_id").alias("refers_to")), "warc-targets")
    return rows.join(targets, rows.refers_to_id == targets.target, "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")
