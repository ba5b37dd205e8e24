"""Legacy ARC archives turned into WARC.

``write_arc`` makes ARC files, of version 1 or 2, from pages; ``read_arc`` parses them by
their version's header line and the declared lengths; ``to_warc`` gives each record the
identifier, date, type and digests a WARC record has, and makes records with a payload
seen before into revisits; ``write_warc`` and ``read_warc`` are the files.

An archive holds about ARCHIVE_BYTES of records, a longer record by itself. Archives are
folders of one file each, gzipped, made by Spark's text writer: a task that is lost and run
again leaves no parts behind. Readers get whole files, so the size of an archive, not of the
table, bounds their memory.

A null payload is empty. A null page_id is kept as absent: such a record is never the one
that others refer to by page, and is a response where its group has no page_id at all. Rows
that repeat a page are records of their own; all with the group's smallest page_id are
responses. Empty tables give no archives and no rows. A malformed archive is an error that
names the place.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_BYTES = 32 << 20
SALTS = 64
# Fixed by the formats: the fields of a header line in each version.
ARC_FIELDS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename"
    b" Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVED = "archive string, place long, record binary"
NAMED = "page_id long, url string, payload_bytes long, payload_digest string"
PARSED = (
    NAMED + ", ip string, date string, content_type string, block_digest string, "
    "head binary, packed binary"
)
RECORDS = (
    "record_id string, warc_type string, url string, page_id long, payload_bytes long, "
    "payload_digest string, refers_to long"
)


# Files of records


def _in_archives(records: Iterator[bytes], opening) -> Iterator[pa.RecordBatch]:
    """Records with the archive each goes to; ``opening(name)`` is an archive's first."""
    task, number, size, place = TaskContext.get().partitionId(), -1, ARCHIVE_BYTES, 0
    for record in records:
        rows = []
        if size >= ARCHIVE_BYTES:
            number, size, place = number + 1, 0, 0
            name = f"a{task:06d}-{number:06d}"
            rows.append((name, place, opening(name)))
        place, size = place + 1, size + len(record)
        rows.append((name, place, record))
        names, places, bodies = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(places, pa.int64()), pa.array(bodies, pa.binary())],
            ["archive", "place", "record"],
        )


def _write(records: DataFrame, path: str, end: str) -> None:
    """One gzipped file per archive, its records in place, each ended by ``end``. The cast
    to text keeps the bytes. Half of the work was deflating at the writer's own level."""
    ordered = records.sortWithinPartitions("archive", "place")
    (
        ordered.select("archive", F.col("record").cast("string").alias("value"))
        .write.partitionBy("archive")
        .option("lineSep", end)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )


def _read(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            yield path.as_py(), gzip.decompress(content.as_py())


# ARC


def _line_field(value: str | None, absent: str) -> str:
    """A field of a header line: no white space, never empty."""
    return "".join(f"%{ord(c):02X}" if c <= " " else c for c in value or absent)


def arc_record(
    version: int, url: str, ip: str, date: str, content_type: str, body: bytes, result: str = "200"
) -> bytes:
    fields = [_line_field(url, "urn:none"), ip, date, content_type]
    if version == 2:
        checksum = hashlib.md5(body).hexdigest()
        fields += [result, checksum, "-", "0", "-"]
    line = " ".join([*fields, str(len(body))])
    return line.encode() + b"\n" + body


def arc_opening(version: int, name: str, date: str) -> bytes:
    """The record that names the file and declares the fields of the others."""
    body = b"%d 0 tidemark\n%s\n" % (version, ARC_FIELDS[version])
    return arc_record(version, f"filedesc://{name}.arc", "0.0.0.0", date, "text/plain", body)


def write_arc(
    pages: DataFrame, path: str, versions: tuple[int, ...] = (1,), date: str = "20000101000000"
) -> None:
    """Writes pages (page_id, url, html) as ARC files: each body is the response that a
    server would have sent, with the page's id in a header. Tasks have ``versions`` in turn."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = versions[TaskContext.get().partitionId() % len(versions)]

        def records() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, html in zip(*batch.columns, strict=True):
                    payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                    head = http_head(page_id.as_py(), len(payload))
                    yield arc_record(
                        version, url.as_py(), "0.0.0.0", date, "text/html", head + payload
                    )

        yield from _in_archives(records(), lambda name: arc_opening(version, name, date))

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    _write(rows.mapInArrow(each, ARCHIVED), path, "\n")


def http_head(page_id: int | None, size: int) -> bytes:
    lines = ["HTTP/1.0 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    return "\r\n".join([*lines, "", ""]).encode()


def parse_arc(content: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by name, body) of every record but the first, which declares the fields.

    Bodies are told by their declared length alone. A URL may hold spaces, so the other
    fields are counted from the line's end."""
    at, fields = 0, None
    while at < len(content):
        if content[at : at + 1] == b"\n":  # between records
            at += 1
            continue
        stop = content.find(b"\n", at)
        line = content[at : stop if stop >= 0 else len(content)]
        try:
            size = int(line.rsplit(b" ", 1)[1])
        except (IndexError, ValueError):
            raise ValueError(f"{name}: no header line at byte {at}") from None
        body = content[stop + 1 : stop + 1 + size]
        if stop < 0 or len(body) != size:
            raise ValueError(f"{name}: the record at byte {at} is cut off")
        if fields is None:
            if not line.startswith(b"filedesc://"):
                raise ValueError(f"{name}: no filedesc record")
            fields = _declared(body, name)
        else:
            parts = line.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
            if len(parts) != len(fields):
                raise ValueError(f"{name}: {len(parts)} of {len(fields)} fields at byte {at}")
            yield dict(zip(fields, parts, strict=True)), body
        at = stop + 1 + size


def _declared(body: bytes, name: str) -> list[str]:
    lines = body.split(b"\n")
    version = lines[0].split(b" ")[0]
    if not version.isdigit() or int(version) not in ARC_FIELDS or len(lines) < 2:
        raise ValueError(f"{name}: unknown version {version!r}")
    return lines[1].decode().split(" ")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(body: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Head with its blank line, payload, and the head's fields by lower-case name."""
    if not body.startswith(b"HTTP/"):
        return b"", body, {}
    stop = body.find(b"\r\n\r\n")
    stop = len(body) if stop < 0 else stop + 4
    lines = body[:stop].decode("latin-1").split("\r\n")[1:]
    named = (line.split(":", 1) for line in lines if ":" in line)
    return body[:stop], body[stop:], {k.strip().lower(): v.strip() for k, v in named}


def read_arc(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """Records of all ARC files under ``path`` with their digests; bodies are deflated.
    Without ``bodies``, only what identifies a payload."""
    kinds = _ARC_ROWS if bodies else _ARC_NAMES

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, content in _contents(batches):
            for some in _hundreds(parse_arc(content, name)):
                rows = [_arc_row(fields, body, bodies) for fields, body in some]
                yield pa.RecordBatch.from_pylist(rows, kinds)

    return _read(spark, path).mapInArrow(each, PARSED if bodies else NAMED)


def _arc_row(fields: dict[str, str], body: bytes, bodies: bool) -> dict:
    head, payload, named = split_http(body)
    row = {
        "page_id": int(named["x-page-id"]) if "x-page-id" in named else None,
        "url": fields["URL"],
        "payload_bytes": len(payload),
        "payload_digest": sha1_base32(payload),
    }
    if bodies:
        row |= {
            "ip": fields["IP-address"],
            "date": fields["Archive-date"],
            "content_type": fields["Content-type"],
            "block_digest": sha1_base32(body),
            "head": head,
            "packed": zlib.compress(payload, 1),
        }
    return row


_ARC_NAMES = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)
_ARC_ROWS = pa.schema(
    [
        *_ARC_NAMES,
        *((n, pa.string()) for n in ("ip", "date", "content_type", "block_digest")),
        *((n, pa.binary()) for n in ("head", "packed")),
    ]
)


def _hundreds(rows: Iterator) -> Iterator[list]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 100:
            yield held
            held = []
    if held:
        yield held


# WARC


def with_first(records: DataFrame, named: DataFrame, least: int = 0) -> DataFrame:
    """Adds ``first``: the smallest page_id among the records of the same payload, null for
    payloads of fewer than ``least`` bytes. ``named`` has the same records without bodies.

    A payload that a third of all records share is spread over SALTS groups: each finds
    its own smallest, the few results meet, and the answer goes back to every group."""
    salt = F.pmod(F.hash("page_id", "url"), F.lit(SALTS))
    groups = (
        named.withColumn("salt", salt)
        .where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "salt")
        .agg(F.min("page_id").alias("first"))
    )
    met = groups.groupBy("payload_digest").agg(
        F.min("first").alias("first"), F.collect_list("salt").alias("salts")
    )
    spread = met.select("payload_digest", "first", F.explode("salts").alias("salt"))
    salted = records.withColumn("salt", salt)
    return salted.join(spread, ["payload_digest", "salt"], "left").drop("salt")


def record_id(page_id: int | None, digest: str, block_digest: str) -> str:
    """The same for the same record however often archives are converted."""
    name = block_digest if page_id is None else f"{page_id}"
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {digest}')}"


def warc_date(arc_date: str) -> str:
    """14 digits as an ISO instant; shorter ones are filled up with the earliest."""
    d = arc_date + "00000101000000"[len(arc_date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def converted(r: dict) -> bytes:
    """The WARC record of a parsed ARC record that knows the first with its payload."""
    digest, first = r["payload_digest"], r["first"]
    revisit = first is not None and first != r["page_id"]
    http = bool(r["head"])
    fields = [
        ("WARC-Type", "revisit" if revisit else "response" if http else "resource"),
        ("WARC-Record-ID", f"<{record_id(r['page_id'], digest, r['block_digest'])}>"),
        ("WARC-Date", warc_date(r["date"])),
        ("WARC-Target-URI", r["url"]),
        ("WARC-IP-Address", r["ip"]),
        ("Content-Type", "application/http; msgtype=response" if http else r["content_type"]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", f"<{record_id(first, digest, '')}>"),
            ("X-Refers-To-Page-Id", str(first)),
        ]
        return warc_record(fields, r["head"])
    fields.append(("WARC-Block-Digest", f"sha1:{r['block_digest']}"))
    return warc_record(fields, r["head"] + zlib.decompress(r["packed"]))


def write_warc(records: DataFrame, path: str) -> None:
    """Writes records of ``read_arc`` with ``first`` as WARC files."""

    def opening(name: str) -> bytes:
        about = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
        return warc_record(
            [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                ("WARC-Date", "2000-01-01T00:00:00Z"),
                ("WARC-Filename", f"{name}.warc"),
                ("Content-Type", "application/warc-fields"),
            ],
            about,
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for batch in batches
            for i in range(0, batch.num_rows, 100)
            for row in batch.slice(i, 100).to_pylist()
        )
        yield from _in_archives(map(converted, rows), opening)

    _write(records.mapInArrow(each, ARCHIVED), path, "\r\n\r\n")


def parse_warc(content: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by name, block) of every record, blocks by their declared length."""
    at = 0
    while at < len(content):
        stop = content.find(b"\r\n\r\n", at)
        if stop < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"{name}: no record at byte {at}")
        lines = content[at:stop].decode("utf-8").split("\r\n")[1:]
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        block = content[stop + 4 : stop + 4 + size]
        at = stop + 4 + size + 4
        if at > len(content):
            raise ValueError(f"{name}: the last record is cut off")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files under ``path`` but those that only describe a file."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, content in _contents(batches):
            for some in _hundreds(parse_warc(content, name)):
                rows = [_warc_row(f, b, name) for f, b in some if f["WARC-Type"] != "warcinfo"]
                yield pa.RecordBatch.from_pylist(rows, _WARC_ROWS)

    return _read(spark, path).mapInArrow(each, RECORDS)


_WARC_ROWS = pa.schema(
    [
        ("record_id", pa.string()),
        ("warc_type", pa.string()),
        ("url", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _warc_row(fields: dict[str, str], block: bytes, name: str) -> dict:
    _, payload, named = split_http(block)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind != "revisit" and sha1_base32(payload) != digest:
        raise ValueError(f"{name}: {fields['WARC-Record-ID']} doesn't have its digest")
    refers = fields.get("X-Refers-To-Page-Id")
    return {
        "record_id": fields["WARC-Record-ID"].strip("<>"),
        "warc_type": kind,
        "url": fields["WARC-Target-URI"],
        "page_id": int(named["x-page-id"]) if "x-page-id" in named else None,
        "payload_bytes": int(named["content-length"]) if kind == "revisit" else len(payload),
        "payload_digest": digest,
        "refers_to": int(refers) if refers else None,
    }


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 0) -> None:
    """All ARC files under one path, of either version, as WARC files under another."""
    records, named = read_arc(spark, arc_path), read_arc(spark, arc_path, bodies=False)
    write_warc(with_first(records, named, least), warc_path)
