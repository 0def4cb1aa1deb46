"""WARC: records of legacy ARC archives become WARC records.

An ARC archive starts with a ``filedesc`` record that names its version and the fields of the
header lines after it: version 1 has ``URL IP-address Archive-date Content-type Archive-length``,
version 2 also ``Result-code Checksum Location Offset Filename``.  Each header line declares the
bytes of content that follow it.  The converter reads header lines by the version in force, takes
the declared bytes, and makes up what WARC has and ARC lacks: a record id (a name-based UUID, so a task that runs
again writes the same one), the date in ISO form, the record type and a SHA-256 digest of the payload.
Of records with equal payloads of at least ``least`` bytes the first is a response and the others are revisits
without payload.

Archives are files that Spark's text writer makes, compressed with gzip, since declared lengths allow any
line ends in the content, and that its binary reader reads.  A file is one task's share of the
input: its size follows from the number of partitions.

Defined results: a null html is an empty payload, a null url is stored as ``-``, white space in a url
is percent-encoded, a null page_id is stored as an absent header field and sorts last.  Repeated pages are
records of their own; equal ones have one response.  Extra columns are left out.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordance.llm.tables import keep, new_path

# Fixed values of the formats.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
DATE = "20240229123456"
IP = "0.0.0.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Records of one archive; a file holds several, of either version in turn.
ARCHIVE_RECORDS = 1000
TEXT = pa.schema([("value", pa.string())])


def _header(url: str, content_type: str, length: int, version: int, name: str, offset: int, date=DATE) -> str:
    if version == 1:
        return f"{url} {IP} {date} {content_type} {length}\n"
    return f"{url} {IP} {date} {content_type} 200 - - {offset} {name} {length}\n"


def _filedesc(name: str, version: int) -> str:
    body = f"{version} 0 accordance\n{FIELDS[version]}\n"
    return _header(f"filedesc://{name}", "text/plain", len(body), version, name, 0) + body


def _http(page_id: int | None, length: int) -> str:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n{own}\r\n"


def write_arc(pages: DataFrame, path: str) -> None:
    """page_id, url and html as gzipped ARC files."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = offset = 0
        version, name = 2, ""
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if count % ARCHIVE_RECORDS == 0:
                    version, offset = 3 - version, 0
                    name = f"{count // ARCHIVE_RECORDS:06d}.arc"
                    out.append(_filedesc(name, version))
                    offset += len(out[-1]) + 1
                body = html or ""
                size = len(body.encode())
                content = _http(page_id, size) + body
                head = len(content) - len(body)
                place = quote(url, safe="%/:=&?~#+!$,;'@()*[]|") if url else "-"
                if place.startswith("filedesc://"):  # only an archive's own record starts so
                    place = place.replace(":", "%3A", 1)
                out.append(_header(place, "text/html", head + size, version, name, offset) + content)
                offset += len(out[-1].encode()) + 1
                count += 1
            yield pa.record_batch([pa.array(out, pa.string())], schema=TEXT)

    rows = pages.select("page_id", "url", "html").mapInArrow(lines, "value string")
    rows.write.option("compression", "gzip").text(path)


def parse_arc(data: bytes) -> Iterator[tuple[int, str, str, str, bytes]]:
    """Offset, url, 14-digit date, content type and content of each record but ``filedesc``."""
    at, version = 0, 1
    while at < len(data):
        end = data.index(b"\n", at)
        fields = data[at:end].decode().split(" ")
        length = int(fields[-1])
        content = data[end + 1 : end + 1 + length]
        if len(content) != length:
            raise ValueError(f"an ARC record at {at} declares {length} bytes and has {len(content)}")
        if fields[0].startswith("filedesc://"):
            version = int(content.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        elif len(fields) != len(FIELDS[version].split(" ")):
            raise ValueError(f"an ARC {version} header line at {at} has {len(fields)} fields")
        else:
            yield at, fields[0], fields[2], fields[3], content
        at = end + 1 + length + 1  # a line end closes each record


def parse_http(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Fields by lower-case name, the head as it is, the payload."""
    head, found, payload = content.partition(b"\r\n\r\n")
    if not found:
        return {}, b"", content
    fields = {}
    for line in head.decode("latin-1").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, head + found, payload


def _page_id(fields: dict[str, str]) -> int | None:
    value = fields.get("x-page-id", "")
    return int(value) if re.fullmatch(r"-?\d+", value) else None


ARC_RECORDS = (
    "file string, offset long, url string, date string, content_type string, page_id long,"
    " payload_bytes long, digest string"
)


def read_arc(spark: SparkSession, path: str, contents: bool = False) -> DataFrame:
    """One row for each record of the ARC files; with the HTTP head and payload if asked for."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = [[] for _ in range(10 if contents else 8)]
                for offset, url, date, kind, content in parse_arc(gzip.decompress(data)):
                    fields, head, payload = parse_http(content)
                    row = (
                        file, offset, url, date, kind, _page_id(fields), len(payload),
                        hashlib.sha256(payload).hexdigest(), head.decode("latin-1"), payload.decode(),
                    )
                    for column, value in zip(out, row, strict=False):
                        column.append(value)
                    if len(out[0]) == 1000:
                        yield _batch(out, contents)
                        out = [[] for _ in out]
                yield _batch(out, contents)

    schema = ARC_RECORDS + (", head string, payload string" if contents else "")
    return _files(spark, path).mapInArrow(records, schema)


def _batch(columns: list[list], contents: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    kinds += [pa.string(), pa.string()] * contents
    names = ["file", "offset", "url", "date", "content_type", "page_id", "payload_bytes", "digest"]
    names += ["head", "payload"] * contents
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 100) -> None:
    """The records of ARC files as gzipped WARC files, repeated payloads as revisits."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset")
    firsts = keep(
        read_arc(spark, arc_path)
        .where(F.col("payload_bytes") >= least)
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first"),
        "firsts",
    )
    records = read_arc(spark, arc_path, contents=True).join(firsts, "digest", "left")
    is_first = (F.col("first.file") == F.col("file")) & (F.col("first.offset") == F.col("offset"))
    records = records.select(
        "file", "offset", "url", "date", "digest", "head", "payload",
        F.when(is_first, None).otherwise(F.col("first.file")).alias("first_file"),
        F.when(is_first, None).otherwise(F.col("first.offset")).alias("first_offset"),
        F.when(is_first, None).otherwise(F.col("first.page_id")).alias("first_page"),
    )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [warc_record(*row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.record_batch([pa.array(out, pa.string())], schema=TEXT)

    records.mapInArrow(lines, "value string").write.option("compression", "gzip").text(warc_path)


def record_id(file: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{offset}')}>"


def warc_record(file, offset, url, date, digest, head, payload, first_file, first_offset, first_page) -> str:
    """The record as text, but for the line feed at its end."""
    revisit = first_file is not None
    block = head if revisit else head + payload
    iso = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(file, offset)}",
        f"WARC-Date: {iso}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        fields += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(first_file, first_offset)}",
        ]
        if first_page is not None:
            fields.append(f"X-Refers-To-Page-Id: {first_page}")
    fields += [
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block.encode())}",
    ]
    return "\r\n".join(fields) + "\r\n\r\n" + block + "\r\n\r"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields by lower-case name and block of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *rest = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError(f"no WARC record at {at}")
        fields = {}
        for line in rest:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) != length or data[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"the WARC record at {at} isn't of its declared length")
        yield fields, block
        at = end + 4 + length + 4


WARC_RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " record_id string, target_uri string, warc_date string, refers_to_id string"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record; digests of responses are computed from what the file holds."""
    names = [x.split()[0] for x in WARC_RECORDS.split(",")]
    kinds = [pa.int64() if x.split()[1] == "long" else pa.string() for x in WARC_RECORDS.split(",")]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(1).to_pylist():
                rows = []
                for fields, block in parse_warc(gzip.decompress(data)):
                    http, _, payload = parse_http(block)
                    digest, size = fields["warc-payload-digest"].removeprefix("sha256:"), len(payload)
                    if fields["warc-type"] == "revisit":
                        size = int(http["content-length"])
                    elif hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
                    refers = fields.get("x-refers-to-page-id")
                    rows.append(
                        (
                            _page_id(http), size, digest, fields["warc-type"], int(refers) if refers else None,
                            fields["warc-record-id"], fields["warc-target-uri"], fields["warc-date"],
                            fields.get("warc-refers-to"),
                        )
                    )
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

    return _files(spark, path).mapInArrow(records, WARC_RECORDS)


def archive_pages(pages: DataFrame, least: int = 100) -> DataFrame:
    """Pages written as ARC files, converted to WARC files and read back."""
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, least)
    return read_warc(spark, warc)
