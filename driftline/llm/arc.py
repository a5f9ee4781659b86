"""ARC to WARC: a converter for the legacy archive format, with both writers and
readers.

An ARC file is a version block and then records of one header line and as many
content bytes as the line declares. The version (1 or 2) names the fields of all
header lines that follow. The converter reads those, synthesises what WARC wants in
addition (record ids, ISO dates, types, SHA-1 digests in base32) and turns repeated
payloads into revisit records.

Archives are files in a folder, each of a bounded size, written by Spark's own text
writer, so a lost task is simply written again. They are gzip files at the fastest
level, or plain ones; readers take both and unpack record by record. Readers go by
declared lengths alone: a payload may hold anything, also what looks like a header.

Heads and payloads are bytes from end to end, in any character set. Content that
begins with an HTTP status line is a response: its head goes up to the first empty
line, of CR LF or LF ends, and is kept as it is. Any other content (``dns:`` records,
say) is a resource, all payload, with the type that the ARC header names. An address may
hold blanks, as ARC 1 writers left them in; in a WARC header they are percent-encoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm.common import checkpointed, free_name

#: Bytes of records an archive holds before the next is begun.
ARCHIVE_BYTES = 4 << 20
#: Parts a repeated payload's records are spread over when they look up the first.
SALTS = 16
#: Repeated payloads whose first records (some 250 bytes each) are broadcast.
FEW = 50_000

# The header fields that each ARC version block names.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
       "Filename Archive-length",
}
#: How the fields stand in a header line: the date is the anchor, address and type may
#: hold blanks.
_ARC_LINE = {n: re.compile(r"(.*) (\S+) (\d{8,17}) (.*) " + r"(\S+) " * (len(f.split()) - 5) + r"(\d+)")
             for n, f in ARC_FIELDS.items()}
_EMPTY_LINE = re.compile(rb"\r?\n\r?\n")
RECORD_SCHEMA = ("key string, url string, date string, type string, head binary, payload binary, "
                 "record_id string, payload_digest string, payload_bytes bigint")
WARC_SCHEMA = ("record_type string, record_id string, url string, date string, key string, "
               "refers_to_key string, payload binary, payload_digest string, payload_bytes bigint")
_KEY, _SIZE = "X-Record-Key", "X-Payload-Length"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC headers carry it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str | None) -> str:
    """One field of a header line: white space, control and non-ASCII characters are
    percent-encoded; a missing value is ``-``."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode())
                   for c in value or "") or "-"


def _http(key: str | None, size: int, kind: str) -> str:
    named = "" if key is None else f"{_KEY}: {key}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n{named}Content-Length: {size}\r\n\r\n"


def _archives(build: Callable[[list, str], bytes], size_of: Callable[[tuple], int]):
    """mapInArrow function: rows to archives of about ARCHIVE_BYTES, one row each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number, rows, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append(row)
                held += size_of(row)
                if held >= ARCHIVE_BYTES:
                    yield _one(build(rows, f"{part:06d}-{number:04d}"))
                    number, rows, held = number + 1, [], 0
        if rows:
            yield _one(build(rows, f"{part:06d}-{number:04d}"))

    return run


def _one(archive: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive], type=pa.binary())], names=["value"])


def _write(archives: DataFrame, path: str, end: str, compression: str) -> None:
    # The text writer puts a value's bytes out as they are, whatever they stand for.
    archives.select(F.col("value").cast("string")).write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", end) \
        .option("compression", compression).option("zlib.compress.level", "BEST_SPEED").text(path)


def arc_archive(rows: list, name: str, version: int, date: str) -> str:
    """An ARC file without its last newline, of (key, url, payload) rows."""
    lines = f"{version} 0 driftline\n{ARC_FIELDS[version]}\n"
    extra = "" if version == 1 else "200 - - 0 - "
    size = len(lines.encode())
    records = [f"filedesc://{name}.arc 0.0.0.0 {date} text/plain {extra}{size}\n{lines}"]
    offset = len(records[0]) + 1
    for key, url, payload in rows:
        body = payload or ""
        content = _http(key, len(body.encode()), "text/html; charset=utf-8") + body
        more = "" if version == 1 else f"200 - - {offset} {name}.arc "
        record = f"{_field(url)} 0.0.0.0 {date} text/html {more}{len(content.encode())}\n{content}"
        offset += len(record.encode()) + 1
        records.append(record)
    return "\n".join(records)


def write_arc(df: DataFrame, path: str, key_col: str, url_col: str, payload_col: str,
              date: str = "20240101000000", version: int | None = None,
              compression: str = "gzip") -> None:
    """Write rows as ARC archives below ``path``: a null key is left out of the
    record, a null url is ``-``, a null payload is empty. ``version`` None writes
    both versions by turns."""
    rows = df.select(F.col(key_col).cast("string"), F.col(url_col).cast("string"),
                     F.col(payload_col).cast("string"))

    def build(some: list, name: str) -> bytes:
        number = version or 1 + (int(name[:6]) + int(name[-4:])) % 2
        return arc_archive(some, name, number, date).encode()

    archives = rows.mapInArrow(_archives(build, lambda r: 300 + 4 * len(r[2] or "")), "value binary")
    _write(archives, path, "\n", compression)


def _opened(data: bytes) -> BinaryIO:
    """The bytes of an archive as a stream, unpacked as it is read."""
    raw = io.BytesIO(data)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if data[:2] == b"\x1f\x8b" else raw


def read_arc_stream(stream: BinaryIO) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """(header fields by name, offset, content) of each record of an ARC file, one record
    in memory at a time.

    Raises ``ValueError`` for an unknown version, a header line that is not made of the
    version's fields, or a declared length that the file does not hold.
    """
    at, version = 0, None
    while raw := stream.readline():
        if raw == b"\n":   # between records
            at += 1
            continue
        line = raw.rstrip(b"\r\n").decode("latin-1")
        if not raw.endswith(b"\n"):
            raise ValueError(f"no header line at {at}")
        size = line.rsplit(" ", 1)[-1]
        match = _ARC_LINE[version].fullmatch(line) if version else None
        if not size.isdigit() or version and not match:
            raise ValueError(f"header at {at} does not have the fields of version {version}")
        content = stream.read(int(size))
        if len(content) != int(size):
            raise ValueError(f"record at {at} declares {size} bytes, {len(content)} are left")
        if version is None:
            first, fields = (content.decode("latin-1").splitlines() + ["", ""])[:2]
            number = first.split(" ")[0]
            if not line.startswith("filedesc:") or ARC_FIELDS.get(int(number) if number.isdigit() else 0) != fields:
                raise ValueError(f"not an ARC file of a known version: {first!r}")
            version = int(number)
        else:
            yield dict(zip(ARC_FIELDS[version].split(" "), match.groups(), strict=True)), at, content
        at += len(raw) + len(content)


def _split_http(content: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(head with its empty line, header fields, payload) of an HTTP message; other
    content has no head."""
    if not content.startswith(b"HTTP/"):
        return b"", {}, content
    end = _EMPTY_LINE.search(content)
    head = content[:end.end()] if end else content
    lines = head.decode("latin-1").splitlines()[1:]
    return head, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, content[len(head):]


def convert(data: bytes | BinaryIO) -> Iterator[tuple]:
    """RECORD_SCHEMA rows of an ARC file: WARC ids, dates and digests synthesised. Records
    that are no HTTP responses have an empty head."""
    stream = _opened(data) if isinstance(data, bytes) else data
    name = None
    for fields, offset, content in read_arc_stream(stream):
        head, http, payload = _split_http(content)
        d = fields["Archive-date"].ljust(14, "0")
        name = name or hashlib.sha1(f"{fields['URL']} {d} {offset}".encode()).hexdigest()
        made = uuid.uuid5(uuid.NAMESPACE_URL, f"{fields['URL']} {d} {name} {offset} {digest(content)}")
        yield (http.get(_KEY.lower()), fields["URL"],
               f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", fields["Content-type"],
               head, payload, f"<urn:uuid:{made}>", digest(payload), len(payload))


def _parsed(spark: SparkSession, path: str, parse: Callable[[BinaryIO], Iterator[tuple]],
            schema: str) -> DataFrame:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    types = [{"bigint": pa.int64(), "binary": pa.binary()}.get(k, pa.string()) for k in kinds]
    size = names.index("payload_bytes")

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for row in parse(_opened(data.as_py())):
                    rows.append(row)
                    held += 500 + (row[size] or 0)
                    if held >= ARCHIVE_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all ARC archives below a folder (RECORD_SCHEMA)."""
    return _parsed(spark, path, convert, RECORD_SCHEMA)


def with_revisits(records: DataFrame, min_bytes: int = 0, order: Column | None = None) -> DataFrame:
    """``records`` with ``refers_to`` (record_id, url, date, key of the first record
    with the same payload) where a record repeats one, else null.

    First is the smallest ``order`` (default: the key). Records without order value,
    with payloads below ``min_bytes``, or equal to the first in order (repeated rows)
    are no revisits. Firsts are found by an aggregation that combines on the map side
    and reads no payload. Up to FEW payloads that come again are broadcast, so that no
    payload is shuffled; more are joined, with a payload that many records share
    spread over SALTS partitions.
    """
    rank, salt, first = (free_name(records, s) for s in ("rank", "salt", "first"))
    order = F.col("key") if order is None else order
    ranked = records.withColumn(rank, F.when(F.col("payload_bytes") >= min_bytes, order))
    firsts = checkpointed(
        ranked.where(F.col(rank).isNotNull()).groupBy("payload_digest", "payload_bytes")
        .agg(F.min_by(F.struct("record_id", "url", "date", "key"),
                      F.struct(rank, "record_id")).alias("refers_to"),
             F.min(rank).alias(first), F.max(rank).alias("last"))
        .where(F.col(first) < F.col("last")).drop("last"))
    same = ["payload_digest", "payload_bytes"]
    if firsts.count() <= FEW:
        joined = ranked.join(F.broadcast(firsts), same, "left")
    else:
        spread = firsts.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = ranked.withColumn(salt, F.pmod(F.hash("record_id"), F.lit(SALTS))) \
            .join(spread, [*same, salt], "left").drop(salt)
    return joined.withColumn("refers_to", F.when(F.col(rank) > F.col(first), F.col("refers_to"))) \
        .drop(rank, first)


def warc_record(row: tuple) -> bytes:
    """One WARC 1.1 record without its closing blank lines. A revisit's block is the
    HTTP head alone; its digest and length are of the full payload."""
    key, url, date, kind, head, payload, record_id, payload_digest, payload_bytes, ref = row
    block = head + (b"" if ref else payload)
    name = "revisit" if ref else "response" if head else "resource"
    headers = [("WARC-Type", name), ("WARC-Record-ID", record_id), ("WARC-Date", date),
               ("WARC-Target-URI", _field(url)),
               ("Content-Type", "application/http;msgtype=response" if head else kind),
               ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
               ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if key is not None:
        headers.append((_KEY, key))
    if ref:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", ref["record_id"]), ("WARC-Refers-To-Target-URI", _field(ref["url"])),
                    ("WARC-Refers-To-Date", ref["date"]), (_SIZE, str(payload_bytes))]
        if ref["key"] is not None:
            headers.append((f"{_KEY}-Referred", ref["key"]))
    headers.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n").encode() + block


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records that have ``refers_to`` as WARC archives below ``path``."""

    def build(rows: list, name: str) -> bytes:
        about = f"software: driftline\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}"
        made = uuid.uuid5(uuid.NAMESPACE_URL, rows[0][6] + name)
        info = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{made}>\r\n"
                f"WARC-Date: {rows[0][2]}\r\nContent-Type: application/warc-fields\r\n"
                f"Content-Length: {len(about.encode())}\r\n\r\n{about}")
        return b"\r\n\r\n".join([info.encode(), *map(warc_record, rows)])

    rows = records.select("key", "url", "date", "type", "head", "payload", "record_id", "payload_digest", "payload_bytes", "refers_to")
    _write(rows.mapInArrow(_archives(build, lambda r: 800 + len(r[4]) + len(r[5])), "value binary"),
           path, "\r\n\r\n", compression)


def read_warc_stream(stream: BinaryIO) -> Iterator[tuple]:
    """WARC_SCHEMA rows of a WARC file's response, resource and revisit records, one record
    in memory at a time. The size of a revisit's payload is null where no header says it.

    Raises ``ValueError`` when a record is cut short or a payload does not have the digest
    that its header names.
    """
    at = 0
    while first := stream.readline():
        if first in (b"\r\n", b"\n"):   # between records
            at += len(first)
            continue
        lines, size = [first], len(first)
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line)
            size += len(line)
        fields = {k.lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
        declared = fields.get("content-length", "")
        block = stream.read(int(declared)) if declared.isdigit() else b""
        if not first.startswith(b"WARC/") or not line or not declared.isdigit() or len(block) != int(declared):
            raise ValueError(f"no whole WARC record at {at}")
        at += size + len(line) + len(block)
        if (kind := fields.get("warc-type")) not in ("response", "resource", "revisit"):
            continue
        _, http, payload = _split_http(block) if kind != "resource" else (b"", {}, block)
        named = fields.get("warc-payload-digest", "").removeprefix("sha1:") or digest(payload)
        if kind != "revisit" and digest(payload) != named:
            raise ValueError(f"{fields.get('warc-record-id')}: the payload has another digest")
        said = fields.get(_SIZE.lower(), http.get("content-length", ""))
        yield (kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"),
               fields.get(_KEY.lower()), fields.get(f"{_KEY}-Referred".lower()), None if kind == "revisit" else payload, named,
               len(payload) if kind != "revisit" else int(said) if said.isdigit() else None)


def read_warc_bytes(data: bytes) -> Iterator[tuple]:
    """``read_warc_stream`` of an archive in memory."""
    return read_warc_stream(_opened(data))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response, resource and revisit records of all WARC archives below a folder."""
    return _parsed(spark, path, read_warc_stream, WARC_SCHEMA)


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0,
                key_type: str = "string", compression: str = "gzip") -> None:
    """Convert a folder of ARC archives; keys are ordered as ``key_type``. A folder
    without archives gives one without. Payloads keep their bytes, in any character set;
    records that are no HTTP responses become resources."""
    records = read_arc(spark, arc_path)
    write_warc(with_revisits(records, min_bytes, F.col("key").cast(key_type)), warc_path, compression)
