"""WARC records in ZIP-packaged archives, written and read back without extraction.

An archive is a ZIP file with two stored members: gzipped WARC records one after the other, and an index
line for each.  The reader parses the end record, the ZIP64 records where there are any, and the central
directory; it locates a stored member's bytes from its local header and range-reads single records.
Archives lie in a folder that driver and executors share.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usertide.session import materialize, new_folder

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A task starts a new archive beyond this many bytes of records; it holds one at a time.
ARCHIVE_BYTES = 48 << 20
#: Neighbouring records are read together up to this many bytes.
WINDOW = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


# Writing


def record(page_id: object, url: str | None, payload: bytes, refers_to: object, date: str) -> bytes:
    """A gzipped WARC record: a response, or a revisit of the page ``refers_to`` without the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
    ]
    block = http if revisit else http + payload
    data = "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "replace") + block + b"\r\n\r\n"
    press = zlib.compressobj(4, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def packed(records: list[bytes], entries: list[dict]) -> bytes:
    """The ZIP file of some records and their index."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr(zipfile.ZipInfo(RECORDS), b"".join(records))
        lines = "".join(f"{e['digest']} {json.dumps(e, sort_keys=True)}\n" for e in entries)
        archive.writestr(zipfile.ZipInfo(INDEX), lines)
    return out.getvalue()


def write_archives(rows: DataFrame, folder: str, *, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes rows ``page_id, url, payload, refers_to`` and returns the stored list ``archive, records, bytes``.

    Every task attempt writes files of its own name, and only those of the attempts that ended well are
    listed; what a lost executor left half done is never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        records: list[bytes] = []
        entries: list[dict] = []
        at = 0

        def close() -> pa.RecordBatch:
            path = f"{root}/{uuid.uuid4().hex}.wacz"
            data = packed(records, entries)
            with system.open_output_stream(path) as out:
                out.write(data)
            return pa.RecordBatch.from_pydict({"archive": [path.removeprefix(f"{root}/")], "records": [len(records)], "bytes": [len(data)]})

        system.create_dir(root, recursive=True)
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, payload, refers_to in zip(*columns, strict=True):
                data = record(page_id.as_py(), url.as_py(), payload.as_py() or b"", refers_to.as_py(), date)
                records.append(data)
                entries.append({"digest": f"{zlib.crc32(data):08x}", "filename": RECORDS, "offset": at, "length": len(data)})
                at += len(data)
                if at >= archive_bytes:
                    yield close()
                    records, entries, at = [], [], 0
        if records:
            yield close()

    return materialize(rows.mapInArrow(run, "archive string, records long, bytes long"))


# Reading


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    flags: int
    packed_size: int
    size: int
    header: int


class ZipReader:
    """Reads a ZIP archive by ranges of its bytes; ``read_at(offset, length)`` gives them."""

    def __init__(self, read_at: Callable[[int, int], bytes], size: int) -> None:
        self.read_at, self.size = read_at, size
        self.members = {m.name: m for m in self.directory()}

    def end(self) -> tuple[int, int]:
        """Offset and size of the central directory, from the ZIP64 records where they stand."""
        tail_at = max(0, self.size - 65_557)
        tail = self.read_at(tail_at, self.size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("not a ZIP archive: no end record")
        size, offset = struct.unpack_from("<II", tail, at + 12)
        end_at = tail_at + at
        if end_at >= 20 and (locator := self.read_at(end_at - 20, 20)).startswith(LOCATOR):
            (end64_at,) = struct.unpack_from("<Q", locator, 8)
            end64 = self.read_at(end64_at, 56)
            if not end64.startswith(END64):
                raise ValueError("the ZIP64 end record isn't where its locator says")
            size, offset = struct.unpack_from("<QQ", end64, 40)
        return offset, size

    def directory(self) -> Iterator[Member]:
        offset, size = self.end()
        data, at = self.read_at(offset, size), 0
        while at + 46 <= len(data):
            if data[at : at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, at + 8)
            packed_size, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
            (header,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n_name]
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            full, packed_size, header = wide_values(extra, full, packed_size, header)
            yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, flags, packed_size, full, header)
            at += 46 + n_name + n_extra + n_comment

    def start(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes begin, and how many there are."""
        member = self.members.get(name)
        if member is None:
            raise ValueError(f"no member {name}")
        if member.method or member.flags & 1:
            raise ValueError(f"{name} isn't stored plainly, so it has no ranges")
        local = self.read_at(member.header, 30)
        if not local.startswith(LOCAL):
            raise ValueError(f"no local header of {name}")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        return member.header + 30 + n_name + n_extra, member.size

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        start, size = self.start(name)
        length = size - offset if length is None else length
        if offset < 0 or length < 0 or offset + length > size:
            raise ValueError(f"{name} has no bytes {offset} to {offset + length}")
        return self.read_at(start + offset, length)


def wide_values(extra: bytes, *values: int) -> list[int]:
    """Values of the central directory, those that don't fit from the ZIP64 extra field."""
    wide, at = b"", 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = extra[at + 4 : at + 4 + size]
        at += 4 + size
    out, at = [], 0
    for value in values:
        if value == 0xFFFFFFFF and len(wide) >= at + 8:
            (value,) = struct.unpack_from("<Q", wide, at)
            at += 8
        out.append(value)
    return out


def parsed(data: bytes) -> dict:
    """A gzipped WARC record's id, type, target, payload and its full length and digest, checked where it is there."""
    text = zlib.decompress(data, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda name: fields.get(name, "").removeprefix("<urn:page:").removesuffix(">") or None
    if fields["WARC-Type"] == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't hold the payload it names")
    return {
        "page_id": number("WARC-Record-ID"),
        "target": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload": payload if fields["WARC-Type"] == "response" else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": number("WARC-Refers-To"),
    }


def archive_records(read_at: Callable[[int, int], bytes], size: int, window: int = WINDOW) -> Iterator[dict]:
    """All records that an archive's index names, neighbouring ones read together."""
    archive = ZipReader(read_at, size)
    entries = [json.loads(line.split(" ", 1)[1]) for line in archive.read(INDEX).decode().splitlines()]
    held, held_name, held_at = b"", "", 0
    for i, e in enumerate(entries):
        offset, length = e["offset"], e["length"]
        if e["filename"] != held_name or offset < held_at or offset + length > held_at + len(held):
            end = offset + length
            for later in entries[i + 1 :]:
                if later["filename"] != e["filename"] or later["offset"] != end or end + later["length"] - offset > window:
                    break
                end += later["length"]
            held, held_name, held_at = archive.read(e["filename"], offset, end - offset), e["filename"], offset
        yield parsed(held[offset - held_at : offset - held_at + length])


def read_archives(archives: DataFrame, folder: str, *, payloads: bool = True) -> DataFrame:
    """A row per record of the listed archives; ``payload`` is null for revisits, and left out on request."""
    fields = [("page_id", pa.string()), ("target", pa.string()), ("record_type", pa.string())]
    fields += [("payload", pa.binary())] * payloads
    fields += [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                with system.open_input_file(f"{root}/{name}") as file:
                    rows: list[dict] = []
                    for row in archive_records(lambda offset, length: file.read_at(length, offset), file.size()):  # noqa: B023
                        rows.append(row)
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], k) for n, k in fields})
                            rows = []
                    yield pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], k) for n, k in fields})

    kinds = {pa.string(): T.StringType(), pa.binary(): T.BinaryType(), pa.int64(): T.LongType()}
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField(n, kinds[k]) for n, k in fields])
    return archives.select("archive").repartition(tasks, "archive").mapInArrow(run, schema)


def first_pages(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Rows ``digest, first``: payloads that several rows share, with their smallest page id."""
    shared = pages.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return shared.where("n > 1 and first is not null").select("digest", "first")


def archived(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    folder: str | None = None,
    payloads: bool = False,
) -> DataFrame:
    """Writes a record per row of ``pages`` and reads them back: ``page_id``, ``target``, type, payload figures.

    Of rows with equal payloads of ``min_bytes`` or more, those with the smallest id are responses and the
    others revisit it.  A null payload counts as empty, a null URL too.  Rows with a null id are written as
    well; they revisit the smallest id that shares their payload, and are responses if there is none.
    Repeated rows give a record each.  Other columns are ignored; an empty table gives no rows.

    Only payload digests are grouped; the payloads meet their first page in a join that the adaptive skew
    join can split, or in none at all where the stored list of first pages is small enough to broadcast.
    """
    kind = pages.schema[id_col].dataType
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    firsts = materialize(first_pages(rows, min_bytes))
    revisit = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    named = rows.join(firsts, "digest", "left").select("page_id", "url", "payload", revisit.cast("string").alias("refers_to"))
    folder = folder or new_folder(pages.sparkSession, "archives")
    records = read_archives(write_archives(named, folder), folder, payloads=payloads)
    return records.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))
