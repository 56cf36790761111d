"""Legacy web archives: ARC files are read by their declared lengths and converted to equivalent WARC files.

ARC. A file begins with a version block (``filedesc://``) whose second line starts with the version: 1 has five fields in a record's header
line (URL, IP address, 14-digit date, content type, length), 2 has ten (result code, checksum, location, offset and file name
come before the length). Header lines are read around their date, so URLs and types may hold blanks; the payload is what the
declared length says, whatever it contains. A file without a version block is read by the number of fields of its header lines.

WARC. Each ARC record becomes one record of WARC/1.0; what ARC doesn't state is synthesised:

* identifier   a UUID made from the SHA-1 of the ARC file's name and the record's offset in it, so a task that runs again repeats it
* timestamp    the 14 digits as ISO 8601, unparsable ones as the epoch
* type         ``warcinfo`` for the version block, ``response`` for HTTP messages, ``resource`` for other content, and ``revisit``
               for a payload of at least ``LEAST`` bytes that another record has too
* digests      SHA-1 of the block and of the payload, which is what follows the HTTP header

Of the records with equal payloads the one with the largest page id (then the largest identifier) stays a response. A revisit keeps its HTTP header, names the
response and states the size of the payload it doesn't repeat. Equal payloads are found by a grouped maximum over thin rows; only
groups of several are joined back, by broadcast while they are few and by a shuffle beyond that.

Archives are written and read by Spark: records are strings of arbitrary bytes for the text sink, whose line separator
ends each record, gzip per file; reading takes a file a row and walks its decompressed stream record by record. A scan split gives
one file, so files follow ``spark.sql.files.maxPartitionBytes``; the reader needs memory for a compressed file and one record (2 GB at most).

Cases: NULL html is an empty payload and NULL and odd URLs are carried percent-encoded; a NULL page id counts as the smallest; rows that
repeat, ids included, are records of their own, one of them the response; very long payloads are bounded by the 2 GB of a row; an empty table writes archives
without records; extra columns are ignored.
"""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
import io
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.llm.common import broadcast_if_small, checkpointed, map_batches, remove, shared_folder

LEAST = 1000
CRLF = b"\r\n"
#: Header lines of the two versions, as their version blocks state them.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_START = r"(?P<url>.+) (?P<ip>\S+) (?P<date>\d{12,17}) (?P<mime>.+) "
LINES = {1: re.compile(_START + r"(?P<length>\d+)"), 2: re.compile(_START + r"(?:\S+ ){5}(?P<length>\d+)")}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ORIGIN, NO_URL = "Tariffloom", "urn:none"
FLUSH = 4 << 20


# ARC, written by Spark


def _length(block: Column) -> Column:
    return F.octet_length(block).cast("string")


def http_message(page_id: Column, html: Column) -> Column:
    """The response that a crawler would have stored; the page's id stands in a header of its own."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), _length(body), F.lit("\r\n\r\n"), body)


def arc_record(version: Column, url: Column, date: str, block: Column) -> Column:
    """Header line and block. Blanks and control characters of the URL become %20; NULL and empty ones a URN."""
    shown = F.coalesce(F.nullif(F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20"), F.lit("")), F.lit(NO_URL))
    head = F.concat(shown, F.lit(f" 0.0.0.0 {date} text/html "))
    second = F.concat(F.lit("200 - - 0 pages.arc.gz "), _length(block))
    return F.concat(head, F.when(version == 1, _length(block)).otherwise(second), F.lit("\n"), block)


def version_block(version: int, date: str) -> str:
    body = f"{version} 0 {ORIGIN}\n{FIELDS[version]}\n"
    extra = "" if version == 1 else "200 - - 0 pages.arc.gz "
    return f"filedesc://pages.arc.gz 0.0.0.0 {date} text/plain {extra}{len(body)}\n{body}"


def write_arc(pages: DataFrame, folder: str, date: str = "20180801000000", page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """ARC files of ``pages``, a file a partition, of version 1 and 2 by turns."""
    at = F.monotonically_increasing_id()
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"), at.alias("at"))
    version = F.when(F.shiftright("at", 33) % 2 == 0, F.lit(1)).otherwise(F.lit(2))
    record = arc_record(version, F.col("url"), date, http_message(F.col("page_id"), F.col("html")))
    first = F.col("at").bitwiseAND((1 << 33) - 1) == 0
    opening = F.when(version == 1, F.lit(version_block(1, date) + "\n")).otherwise(F.lit(version_block(2, date) + "\n"))
    rows.select(F.when(first, F.concat(opening, record)).otherwise(record).alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\n").option("maxRecordsPerFile", 0).text(folder)


# Reading both formats


class ArcRecord(NamedTuple):
    offset: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes

    @property
    def opens(self) -> bool:
        """Whether it is the version block, which only stands at a file's beginning."""
        return self.offset == 0 and self.url.startswith("filedesc://")


def opened(content: bytes | memoryview) -> BinaryIO:
    """A decompressed stream; gzip members may follow one another."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if bytes(content[:2]) == b"\x1f\x8b" else raw


def _exactly(stream: BinaryIO, n: int, offset: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise ValueError(f"a record at byte {offset} declares {n} bytes, the file ends after {len(data)}")
    return data


def arc_records(stream: BinaryIO) -> Iterator[ArcRecord]:
    """Records of an ARC file, its version block among them, by declared lengths. Blank lines between records are skipped."""
    version, offset = None, 0  # until a version block states it, the shape of the line decides
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        text = line.strip(b"\r\n").decode("utf-8", "surrogateescape")
        if not text:
            continue
        parts = LINES[version].fullmatch(text) if version else LINES[2].fullmatch(text) or LINES[1].fullmatch(text)
        if not parts:
            raise ValueError(f"no header line of ARC version {version or '1 or 2'} at byte {start}: {text[:100]!r}")
        block = _exactly(stream, int(parts["length"]), start)
        offset += len(block)
        if start == 0 and text.startswith("filedesc://") and block[:1] in (b"1", b"2"):
            version = int(block[:1])
        yield ArcRecord(start, parts["url"], parts["ip"], parts["date"], parts["mime"], block)


def warc_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower case) and block of each record of a WARC file, by Content-Length."""
    offset = 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if not line.strip(b"\r\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {start}: {line[:100]!r}")
        fields = {}
        while (line := stream.readline()).strip(b"\r\n"):
            offset += len(line)
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = _exactly(stream, int(fields["content-length"]), start)
        offset += len(line) + len(block)
        yield fields, block


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header, with its blank line, and body of an HTTP message; all body if it is none."""
    end = block.find(b"\r\n\r\n")
    return (block[:end + 4], block[end + 4:]) if block.startswith(b"HTTP/") and end >= 0 else (b"", block)


def http_field(head: bytes, name: bytes) -> str | None:
    for line in head.split(CRLF)[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def page_of(head: bytes) -> int | None:
    value = http_field(head, b"x-page-id")
    return int(value) if value and re.fullmatch(r"-?\d{1,18}", value) else None


# Synthesis


def timestamp(digits: str) -> str:
    try:
        return dt.datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def identifier(name: str, offset: int) -> str:
    return str(uuid.UUID(bytes=hashlib.sha1(f"{name}:{offset}".encode()).digest()[:16], version=5))


def target_uri(url: str) -> str:
    """Characters that no URI holds are percent-encoded; what is encoded already stays."""
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]", errors="surrogateescape")


def warc_record(kind: str, record_id: str, date: str, fields: list[tuple[str, str]], mime: str, block: bytes) -> bytes:
    """Without the CRLF that ends the record's last line: the text sink writes it."""
    digest = hashlib.sha1(block).hexdigest()
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", date), *fields,
            ("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Type", mime), ("Content-Length", str(len(block)))]
    lines = "".join(f"{n}: {v}\r\n" for n, v in head).encode("utf-8", "surrogateescape")
    return b"WARC/1.0\r\n" + lines + CRLF + block + CRLF


def converted(record: ArcRecord, name: str, info: str, refers_to: str | None) -> bytes:
    """The WARC record of an ARC record; a revisit if ``refers_to`` names another one."""
    head, payload = split_http(record.block)
    if record.opens:
        body = f"software: {ORIGIN}\r\nformat: WARC File Format 1.0\r\nconformsTo: ARC {record.block[:1].decode()}\r\n".encode()
        return warc_record("warcinfo", info, timestamp(record.date), [("WARC-Filename", name)], "application/warc-fields", body)
    fields = [("WARC-Target-URI", target_uri(record.url)), ("WARC-IP-Address", record.ip), ("WARC-Warcinfo-ID", f"<urn:uuid:{info}>"),
              ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}")]
    kind, mime, block = ("response", "application/http; msgtype=response", record.block) if head else ("resource", record.mime, record.block)
    if refers_to:
        kind, block = "revisit", head
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{refers_to}>"), ("WARC-Payload-Length", str(len(payload)))]
    return warc_record(kind, identifier(name, record.offset), timestamp(record.date), fields, mime, block)


# Jobs


def archive_rows(spark: SparkSession, folder: str) -> DataFrame:
    """name, content: a row a file."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def each_file(files: DataFrame, rows_of: Callable[[str, bytes], Iterator[tuple]], schema: str, weight: Callable[[tuple], int]) -> DataFrame:
    """The rows that ``rows_of`` makes of each file, in batches of a few megabytes."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(files.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind, strict=True)], schema=kind)

        held, size = [], 0
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                for row in rows_of(name.as_py(), memoryview(content.as_buffer())):
                    held.append(row)
                    size += weight(row)
                    if size > FLUSH:
                        yield batch_of(held)
                        held, size = [], 0
        if held:
            yield batch_of(held)

    return map_batches(files, run, schema)


def arc_index(spark: SparkSession, folder: str) -> DataFrame:
    """Thin rows of all ARC records but version blocks: record_id, page_id, payload_bytes, payload_digest."""
    def rows_of(name: str, content: bytes) -> Iterator[tuple]:
        for record in arc_records(opened(content)):
            if not record.opens:
                head, payload = split_http(record.block)
                yield identifier(name, record.offset), page_of(head), len(payload), hashlib.sha1(payload).hexdigest()

    return each_file(archive_rows(spark, folder), rows_of, "record_id string, page_id long, payload_bytes long, payload_digest string", lambda _: 200)


def revisits(index: DataFrame, least: int = LEAST) -> DataFrame:
    """record_id, refers_to (a record id): payloads of at least ``least`` bytes that the kept record of their group has too. A hot payload
    is a row a task in the maximum, and one row on the other side of a join that may be split."""
    large = index.filter(F.col("payload_bytes") >= least)
    groups = large.groupBy("payload_digest", "payload_bytes").agg(
        F.max(F.struct("page_id", "record_id")).alias("kept"), F.count("*").alias("n")).filter("n > 1")
    groups = groups.select("payload_digest", "payload_bytes", F.col("kept.record_id").alias("refers_to"))
    return large.join(groups, ["payload_digest", "payload_bytes"]).filter("record_id <> refers_to").select("record_id", "refers_to")


def write_warc(spark: SparkSession, arc_folder: str, folder: str, index: DataFrame, least: int = LEAST) -> None:
    """WARC files of all records of ``arc_folder``."""
    again = checkpointed(revisits(index, least))
    repeated, few = broadcast_if_small(again, F.lit(72))
    known = dict(again.collect()) if few else None

    def finished(name: str, content: bytes) -> Iterator[tuple]:
        """The records as they will be written, where the revisits are known."""
        info = identifier(name, 0)
        for record in arc_records(opened(content)):
            yield (converted(record, name, info, known.get(identifier(name, record.offset))),)

    def both(name: str, content: bytes) -> Iterator[tuple]:
        """Where they are too many to be known everywhere: each record as it is and, if its payload is long, as a revisit in two parts,
        between which the response's identifier belongs."""
        info = identifier(name, 0)
        for record in arc_records(opened(content)):
            parts = (None, None)
            if len(split_http(record.block)[1]) >= least:
                before, name_of, after = converted(record, name, info, ">").partition(b"WARC-Refers-To: <urn:uuid:")
                parts = (before + name_of, after.removeprefix(b">"))
            yield (identifier(name, record.offset), converted(record, name, info, None), *parts)

    files = archive_rows(spark, arc_folder)
    if few:
        rows = each_file(files, finished, "value binary", lambda row: len(row[0])).select(F.col("value").cast("string").alias("value"))
    else:
        made = each_file(files, both, "record_id string, whole binary, before binary, after binary", lambda row: len(row[1]))
        joined = made.join(repeated, "record_id", "left")
        rows = joined.select(F.when(F.col("refers_to").isNull(), F.col("whole").cast("string")).otherwise(
            F.concat(F.col("before").cast("string"), "refers_to", F.col("after").cast("string"))).alias("value"))
    rows.write.option("compression", "gzip").option("lineSep", "\r\n").option("maxRecordsPerFile", 0).text(folder)


def warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, page_id, payload_bytes, payload_digest, record_type, refers_to_id of all records but warcinfo, read back. Digests of what
    is there are computed again and must agree with the declared ones."""
    def bare(value: str) -> str:
        return value.removeprefix("<urn:uuid:").removesuffix(">")

    def rows_of(_: str, content: bytes) -> Iterator[tuple]:
        for fields, block in warc_records(opened(content)):
            kind, (head, payload) = fields["warc-type"], split_http(block)
            if kind == "warcinfo":
                continue
            declared = fields["warc-payload-digest"].removeprefix("sha1:")
            if fields["warc-block-digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}" or (
                    kind != "revisit" and declared != hashlib.sha1(payload).hexdigest()):
                raise ValueError(f"digest of {fields['warc-record-id']} does not agree")
            size = int(fields["warc-payload-length"]) if kind == "revisit" else len(payload)
            yield bare(fields["warc-record-id"]), page_of(head), size, declared, kind, bare(fields["warc-refers-to"]) if kind == "revisit" else None

    return each_file(archive_rows(spark, folder), rows_of,
                     "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to_id string", lambda _: 250)


def convert(spark: SparkSession, arc_folder: str, folder: str, least: int = LEAST) -> DataFrame:
    """Convert the ARC files of a folder; the index of the WARC files, read back, with ``refers_to`` the page id of the named response."""
    write_warc(spark, arc_folder, folder, checkpointed(arc_index(spark, arc_folder)), least)
    index = checkpointed(warc_index(spark, folder))
    again, rest = index.filter("record_type = 'revisit'"), index.filter("record_type <> 'revisit'")
    names = rest.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    found = again.join(names, "refers_to_id", "left").select(*index.columns, "refers_to")
    return rest.withColumn("refers_to", F.lit(None).cast("long")).unionByName(found)


def archived(pages: DataFrame, folder: str | None = None, least: int = LEAST, **columns) -> DataFrame:
    """``pages`` through ARC and WARC files: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id. The WARC
    files stay in ``folder`` where one is named; the ARC files, and WARC files of no name, go once the index is written."""
    spark = pages.sparkSession
    work = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    target = folder or os.path.join(work, "warc")
    write_arc(pages, f"{work}/arc", **columns)
    out = convert(spark, f"{work}/arc", target, least)
    remove(spark, work)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")
