"""Web archives packed in ZIP files, read by byte ranges (operator 7).

A package holds one stored member ``archive/data.warc.gz``, every record a gzip member of its own,
back to back, and one stored member ``indexes/index.cdx`` with a line per record: page key, offset,
length, payload digest. The reader finds both members through the central directory, with its ZIP64 fields, and
reads index and records by their byte ranges; nothing is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.storage import open_store, write_once
from barloom.session import new_folder, written

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
#: A package is closed after this many bytes of records.
PACKAGE_BYTES = 64 << 20
#: Bytes of records or index lines a reading task asks the store for at a time.
READ_BYTES = 8 << 20
_DATE = "2000-01-01T00:00:00Z"


class Member(NamedTuple):
    """A stored ZIP member: its name, size, and where its data begins in the file."""

    name: str
    size: int
    begin: int


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page: str, url: str, payload: bytes | None, digest: str, size: int, refers_to: str | None) -> bytes:
    """A response record with the payload, or a revisit record that names the page it repeats.

    Both carry the HTTP head with the full payload's length; only a response carries the payload.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name; lines without a colon are none."""
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, colon, v in pairs if colon}


def parse_record(data: bytes) -> dict:
    """Headers (lower case), HTTP headers and payload of one record; raises on a torn one.

    The payload of a record that is no HTTP message is its whole block.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head.split(b"\r\n")[1:])
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return {"fields": fields, "http": {}, "payload": rest[:length]}
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    return {"fields": fields, "http": _fields(http.split(b"\r\n")[1:]), "payload": payload}


def zip_members(f) -> list[Member]:
    """The stored members of a ZIP file given as a random-access file, from its central directory.

    Reads the end record (behind a comment if there is one), the ZIP64 end record where a field is
    at its limit, the directory, and each member's local header. Folders and compressed members,
    which can't be read by range, are left out.
    """
    size = f.size()
    tail_at = max(0, size - (22 + 65535))
    tail = f.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06", 0, max(len(tail) - 18, 0))
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, at = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or at == 0xFFFFFFFF:
        locator = f.read_at(20, tail_at + end - 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = f.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        count, length, at = struct.unpack_from("<QQQ", record, 32)
    directory, members, pos = f.read_at(length, at), [], 0
    for _ in range(count):
        if directory[pos : pos + 4] != b"PK\x01\x02":
            raise ValueError("a central directory entry is damaged")
        method, = struct.unpack_from("<H", directory, pos + 10)
        packed, full = struct.unpack_from("<II", directory, pos + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, pos + 28)
        header_at, = struct.unpack_from("<I", directory, pos + 42)
        name = directory[pos + 46 : pos + 46 + n_name].decode()
        extra = directory[pos + 46 + n_name : pos + 46 + n_name + n_extra]
        wide = _zip64_values(extra)
        full = wide.pop(0) if full == 0xFFFFFFFF else full
        packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
        header_at = wide.pop(0) if header_at == 0xFFFFFFFF else header_at
        pos += 46 + n_name + n_extra + n_comment
        if name.endswith("/") or method != 0 or packed != full:
            continue  # a folder, or compressed: its parts can't be read by range
        local = f.read_at(30, header_at)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no local header")
        members.append(Member(name, full, header_at + 30 + sum(struct.unpack_from("<HH", local, 26))))
    return members


def record_places(f) -> Iterator[tuple[int, int]]:
    """(begin in the file, length) of every record that the package's indexes list, in their order.

    An index is a stored member that ends in ``.cdx`` or ``.cdxj``, perhaps with ``.gz``. Its lines hold
    a JSON object, perhaps behind other fields, with ``offset``, ``length`` and, if there are several
    archives, the ``filename`` of one. Raises if there is no archive, no index, or no such file.
    """
    members = zip_members(f)
    archives = [m for m in members if m.name.endswith((".warc.gz", ".warc"))]
    indexes = [m for m in members if m.name.removesuffix(".gz").endswith((".cdx", ".cdxj"))]
    if not archives or not indexes:
        raise ValueError("the package has no stored archive with a stored index")
    for index in indexes:
        data = f.read_at(index.size, index.begin)
        data = gzip.decompress(data) if index.name.endswith(".gz") else data
        for line in data.split(b"\n"):
            if b"{" not in line:
                continue
            entry = json.loads(line[line.index(b"{") :])
            name = entry.get("filename")
            found = [m for m in archives if name is None or m.name == name or m.name.endswith(f"/{name}")]
            if len(found) != 1:
                raise ValueError(f"an index names {name!r}, which is no single archive")
            yield found[0].begin + int(entry["offset"]), int(entry["length"])


def _zip64_values(extra: bytes) -> list[int]:
    pos = 0
    while pos + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, pos)
        if kind == 1:
            return list(struct.unpack_from(f"<{n // 8}Q", extra, pos + 4))
        pos += 4 + n
    return []


def plan_records(pages: DataFrame, page: str, html: str, url: str | None, least: int = 0) -> DataFrame:
    """Pages with their payload's digest and size and, for a repeated payload, the page it repeats.

    Of equal payloads of ``least`` bytes or more the smallest page key stays; null keys come last.
    Digests are counted with map-side combine, so a payload that a third of all pages share is one
    row per task there; its pages meet that row in a join whose hot partition is split at run time.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page).cast("bigint").alias("page"),
        (F.col(url) if url else F.lit("")).cast("string").alias("url"),
        body.alias("payload"),
        F.sha1(body).alias("sha1"),
        F.octet_length(body).cast("bigint").alias("size"),
    )
    repeated = (
        rows.where(F.col("size") >= least)
        .groupBy("sha1", "size")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    return rows.join(repeated, ["sha1", "size"], "left").select(
        "page", "url", "payload", "size", F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, folder: str, page: str = "page_id", html: str = "html", url: str | None = "url", least: int = 0
) -> DataFrame:
    """Writes packages below ``folder`` and returns their manifest: ``file``, ``n_records``.

    Nulls: a null html is the empty payload; a null page key is written as such and read back as
    null; a null url is empty. Repeated rows with the least key of their payload are all responses.
    Empty table: no packages. Extra columns are not read.

    Scale: a package is streamed record by record and closed at PACKAGE_BYTES; its index is all a
    task holds. Packages are named by attempt; only those in the committed manifest are read.
    """
    limit = PACKAGE_BYTES

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for b in batches for row in b.itertuples(index=False))
        following = next(rows, None)
        while following is not None:
            name, index = f"pages-{uuid.uuid4().hex}.wacz", []

            def package(out) -> None:
                nonlocal following
                with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
                    with z.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True) as member:
                        at = 0
                        while following is not None and at < limit:
                            r = following
                            key = "" if pd.isna(r.page) else str(int(r.page))
                            refers = None if pd.isna(r.refers_to) else str(int(r.refers_to))
                            digest = payload_digest(r.payload)
                            line_url = (r.url or "").replace("\r", "").replace("\n", "")
                            record = warc_record(key, line_url, r.payload, digest, int(r.size), refers)
                            data = gzip.compress(record, 6, mtime=0)
                            member.write(data)
                            index.append(json.dumps({"page": key, "offset": at, "length": len(data), "digest": digest}))
                            at += len(data)
                            following = next(rows, None)
                    z.writestr(zipfile.ZipInfo(INDEX_MEMBER), "\n".join(index))

            write_once(folder, name, package)
            yield pd.DataFrame({"file": [name], "n_records": [len(index)]})

    planned = plan_records(pages, page, html, url, least)
    return written(planned.mapInPandas(write, "file string, n_records bigint"), "archive-manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the packages: page, payload_bytes, payload_digest, record_type, refers_to, payload.

    A response's bytes and digest come from its payload and must agree with its header; a revisit's come
    from its headers, and its payload is null. In packages of other writers (see ``record_places``)
    records name no page; a digest they lack is worked out.

    Scale: a first pass reads directories and indexes and yields runs of records of about READ_BYTES;
    runs are then dealt to tasks, which read each with one range request.
    """
    span = READ_BYTES

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["file"]:
                store, path = open_store(f"{folder}/{name}")
                run: list[int] = []
                begin = size = 0
                with store.open_input_file(path) as f:
                    for at, length in record_places(f):
                        if run and (size >= span or len(run) >= 4096 or at != begin + size):
                            yield pd.DataFrame({"file": [name], "at": [begin], "lengths": [run]})
                            run = []
                        if not run:
                            begin, size = at, 0
                        run.append(length)
                        size += length
                if run:
                    yield pd.DataFrame({"file": [name], "at": [begin], "lengths": [run]})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                store, path = open_store(f"{folder}/{row.file}")
                with store.open_input_file(path) as f:
                    data = f.read_at(int(sum(row.lengths)), int(row.at))
                out, pos = [], 0
                for n in row.lengths:
                    record = data[pos : pos + n]
                    out.append(_row(parse_record(gzip.decompress(record) if record[:2] == b"\x1f\x8b" else record)))
                    pos += n
                yield pd.DataFrame(out, columns=["page", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]).astype(
                    {"page": "Int64", "refers_to": "Int64"}
                )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = manifest.repartition(parts, "file").mapInPandas(locate, "file string, at bigint, lengths array<bigint>")
    return runs.repartition(parts, "file", "at").mapInPandas(
        read,
        "page bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary",
    )


def _row(record: dict) -> tuple:
    fields, kind = record["fields"], record["fields"]["warc-type"]
    page, payload = _page(fields.get("warc-record-id", "")), record["payload"]
    ours = fields.get("warc-record-id", "").startswith(_PAGE)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    size = int(record["http"].get("content-length", len(payload)))
    if kind == "revisit":
        return page, size, digest, kind, _page(fields.get("warc-refers-to", "")), None
    if not ours:
        return None, len(payload), digest or payload_digest(payload), kind, None, payload
    if payload_digest(payload) != digest or len(payload) != size:
        raise ValueError(f"page {page}: the payload does not match its header")
    return page, size, digest, kind, None, payload


_PAGE = "<urn:page:"


def _page(urn: str) -> int | None:
    text = urn.removeprefix(_PAGE).removesuffix(">")
    return int(text) if urn.startswith(_PAGE) and text else None


def archive_round_trip(
    pages: DataFrame, page: str = "page_id", html: str = "html", url: str | None = "url", least: int = 0
) -> DataFrame:
    """Writes all pages and reads them back, without the payloads."""
    folder = new_folder(pages.sparkSession, "archives")
    manifest = write_archives(pages, folder, page, html, url, least)
    back = read_archives(pages.sparkSession, folder, manifest).drop("payload")
    return back.withColumnRenamed("page", page)
