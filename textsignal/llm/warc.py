"""WARC: archives of page records, and a reader that salvages what a damaged archive still holds."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

VERSION = b"WARC/1.1\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 32 << 20  # a task starts a new archive beyond this
LEVEL = 3
STEP = 1 << 16  # bytes given to the decompressor at a time

_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"

PARSED = (
    "archive string, start long, end long, inner_start long, inner_end long, kind string, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)
_FIELDS = [c.split()[0] for c in PARSED.split(", ")]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return VERSION + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """A response, or, if it repeats the payload of page ``refers_to``, a revisit without it."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x1f\x7f]", "", url or "") or None
    return record_bytes(
        {
            "WARC-Type": "revisit" if revisit else "response",
            "WARC-Record-ID": f"<urn:page:{'null' if page_id is None else page_id}>",
            "WARC-Date": DATE,
            "WARC-Target-URI": uri,
            "WARC-Profile": REVISIT if revisit else None,
            "WARC-Refers-To": f"<urn:page:{refers_to}>" if revisit else None,
            "WARC-Payload-Digest": f"sha1:{digest(payload)}",
            "WARC-Block-Digest": f"sha1:{digest(block)}",
            "Content-Type": "application/http; msgtype=response",
        },
        block,
    )


def member(record: bytes) -> bytes:
    """The record as a gzip member of its own."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def first_pages(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(page_id, digest, refers_to): the least page id with the same payload, null where it is the page itself.

    Only digests move.  A payload that a third of all pages share is one group of partial minima, and a skewed
    join key that adaptive execution splits.  Pages with a null id refer to the first with an id.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.sha1(payload).alias("digest"), F.length(payload).alias("n"))
    least = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    other = (F.col("n") >= min_payload) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(least, "digest").select("page_id", "digest", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_payload: int = 0, compress: bool = True) -> int:
    """Write all pages below ``folder``; returns the number of records.

    Every task writes archives of its own, each record a gzip member, under a name of its partition; a
    file appears under its final name when it is whole, so a task that is run again after a lost
    executor, or twice, replaces it by an equal one.  ``folder`` must be shared by all executors.
    """
    opened(folder)  # an empty table makes an empty folder
    marks = first_pages(pages, min_payload).select(
        F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to"
    )
    marks = marks.dropDuplicates(["_id", "_digest"])
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.sha1("payload") == F.col("_digest"))
    rows = rows.join(marks, same).select("page_id", "url", "payload", "refers_to")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        fs, root = opened(folder)
        context = TaskContext.get()
        name = f"{root}/part-{context.partitionId():06d}"
        out, partial, number, written = None, "", 0, 0

        def close() -> None:
            out.close()
            fs.move(partial, f"{name}-{number:05d}.warc{'.gz' if compress else ''}")

        for batch in batches:
            for row in batch.itertuples(index=False):
                record = page_record(plain(row.page_id), row.url, row.payload, plain(row.refers_to))
                record = member(record) if compress else record
                if out is not None and out.tell() + len(record) > ARCHIVE_BYTES:
                    close()
                    out, number = None, number + 1
                if out is None:
                    partial = f"{name}-{number:05d}.{uuid.uuid4().hex}.partial"
                    out = fs.open_output_stream(partial, compression=None)
                out.write(record)
                written += 1
        if out is not None:
            close()
        yield pd.DataFrame({"n": [written]})

    return rows.mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def opened(folder: str):
    """File system and path of a folder, which is made if need be."""
    import pyarrow.fs

    fs, root = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    return fs, root


def plain(value):
    return None if value is None or value != value else str(int(value)) if isinstance(value, float) else str(value)


@dataclass
class Found:
    start: int
    end: int
    kind: str  # record or gap
    reason: str | None = None
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    inner: tuple[int, int] | None = None  # range inside the member, if it holds more than one record


class Damaged(ValueError):
    pass


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``; every check that fails raises ``Damaged``."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        raise Damaged("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Damaged("headers without end")
    headers: dict[str, str] = {}
    for line in data[version.end() : head_end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line without colon")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    start = head_end + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("no record end where the length says")
    block = data[start:end]
    claimed = headers.get("warc-block-digest", "")
    if claimed.startswith("sha1:") and claimed[5:] != digest(block):
        raise Damaged("block digest differs")
    return headers, block, end + 4


def inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at ``at`` holds, its end, and why it could not be read to its end, if so."""
    reader, view, parts, to = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while not reader.eof and to < len(data):
            parts.append(reader.decompress(view[to : to + STEP]))
            to = min(to + STEP, len(data))
    except zlib.error as e:
        return _rest_of(data, at, parts), to, f"gzip: {str(e)[:80]}"
    if not reader.eof:
        return b"".join(parts), to, "gzip member without end"
    return b"".join(parts), to - len(reader.unused_data), None


def _rest_of(data: bytes, at: int, parts: list[bytes]) -> bytes:
    """The whole steps that were read before a failure, and the bytes of the failing step that come before it."""
    reader, done = zlib.decompressobj(31), at + STEP * len(parts)
    out = [reader.decompress(data[at:done])] if parts else []
    try:
        for i in range(done, min(done + STEP, len(data)), 64):
            out.append(reader.decompress(data[i : i + 64]))
    except zlib.error:
        pass
    return b"".join(out)


def starts_record(data: bytes, at: int) -> bool:
    """Whether a gzip member at ``at`` begins with a version line; reads a few hundred bytes."""
    try:
        return bool(_VERSION_LINE.match(zlib.decompressobj(31).decompress(data[at : at + 512], 16)))
    except zlib.error:
        return False


class Starts:
    """Places that look like a member or a version line; asked in ascending order, it reads the archive once."""

    def __init__(self, data: bytes):
        self.data, self.line = data, -1

    def after(self, at: int) -> int:
        """The next such place at or after ``at``, else the end."""
        if self.line < at:
            found = _VERSION_LINE.search(self.data, at)
            self.line = found.start() if found else len(self.data)
        place = self.data.find(_MEMBER, at, self.line + 2)
        while 0 <= place < self.line:
            if starts_record(self.data, place):
                return place
            place = self.data.find(_MEMBER, place + 1, self.line + 2)
        return self.line


def salvage_plain(data: bytes) -> Iterator[Found]:
    """Records and gaps of uncompressed bytes; after a failed check the search goes on at the next version line."""
    at, gap, reason = 0, -1, None
    while at < len(data):
        try:
            headers, block, end = parse_record(data, at)
        except Damaged as e:
            if gap < 0:
                gap, reason = at, str(e)
            found = _VERSION_LINE.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap >= 0:
            yield Found(gap, at, "gap", reason)
            gap = -1
        yield Found(at, end, "record", None, headers, block)
        at = end
    if gap >= 0:
        yield Found(gap, len(data), "gap", reason)


def salvage(data: bytes) -> Iterator[Found]:
    """All records of an archive that pass their checks, and the byte ranges between them that do not.

    After a failed check the search goes on one byte later for the next gzip member that begins with a version
    line, or the next plain version line.  Neighbouring failures are one gap, with the first reason.

    A member may hold any number of records: each is a record with the member's range and its own range inside
    (``inner``), and bytes inside that belong to none are a gap with the member's range.  A member that cannot be
    read to its end is a gap; the records that it held before the damage are recovered, with an empty range
    at its start.
    """
    starts, at, gap, reason = Starts(data), 0, -1, None
    while at < len(data):
        inside, why, end = None, None, at
        if data.startswith(_MEMBER, at):
            text, end, why = inflated(data, at)
            inside = [f for f in salvage_plain(text) if why is None or f.kind == "record"]
            if why is None and not inside:
                why = "an empty member"
            elif why is None and all(f.kind == "gap" for f in inside):
                why = inside[0].reason
        else:
            try:
                headers, block, end = parse_record(data, at)
            except Damaged as e:
                why = str(e)
        recovered = [f for f in inside or () if f.kind == "record"]
        if gap >= 0 and (why is None or recovered):
            yield Found(gap, at, "gap", reason)
            gap = -1
        if why is not None:
            yield from (Found(at, at, "record", None, f.headers, f.block, (f.start, f.end)) for f in recovered)
            if gap < 0:
                gap, reason = at, why
            at = starts.after(at + 1)
            continue
        if inside is None:
            yield Found(at, end, "record", None, headers, block)
        elif len(inside) == 1:
            yield Found(at, end, "record", None, inside[0].headers, inside[0].block)
        else:
            yield from (Found(at, end, f.kind, f.reason, f.headers, f.block, (f.start, f.end)) for f in inside)
        at = end
    if gap >= 0:
        yield Found(gap, len(data), "gap", reason)


def described(archive: str, found: Found) -> tuple:
    place = (archive, found.start, found.end, *(found.inner or (None, None)))
    if found.kind == "gap":
        return (*place, "gap", found.reason, *[None] * 7)
    h = found.headers
    http, _, body = found.block.partition(b"\r\n\r\n")
    said = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    revisit = h.get("warc-type") == "revisit"
    n = int(said[1]) if said else len(body)
    claimed = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if not revisit and (n != len(body) or claimed not in (None, digest(body))):
        return (*place, "gap", "payload differs from its length or digest", *[None] * 7)
    return (
        *place, "record", None, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"),
        h.get("warc-refers-to"), claimed, n, None if revisit else body,
    )


def archive_files(spark, folder: str) -> DataFrame:
    """(path, content) of all ``*.warc`` and ``*.warc.gz`` files below ``folder``; the writer bounds their size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,warc.gz}").load(folder)
    return files.select("path", "content")


def parse_archives(files: DataFrame) -> DataFrame:
    """A row per record and per quarantined gap of archives given as (path, content), one archive per task row.

    ``kind`` is ``record`` or ``gap``; gaps have ``reason`` and the byte range ``start``..``end`` alone.  ``inner_start``
    and ``inner_end`` are the range inside a member that holds several records, else null.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows, size = [], 0
                for found in salvage(content):
                    rows.append(described(path, found))
                    size += len(found.block)
                    if size > 4 << 20:
                        yield _frame(rows)
                        rows, size = [], 0
                yield _frame(rows)

    return files.mapInPandas(parse, PARSED)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    whole = ["start", "end", "inner_start", "inner_end", "payload_bytes"]
    return pd.DataFrame(rows, columns=_FIELDS).astype({c: "Int64" for c in whole})


def read_archives(spark, folder: str) -> DataFrame:
    """All records and gaps of the archives below ``folder``, as ``parse_archives`` gives them."""
    return parse_archives(archive_files(spark, folder))


def spoiled(files: DataFrame, every: int, rest: int) -> DataFrame:
    """``files`` with a byte turned over in the middle of the records of all pages whose id modulo ``every`` is ``rest``.

    Nothing is written: a drill for the reader, on archives that are otherwise sound.
    """

    def spoil(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                hurt = bytearray(content)
                for found in salvage(content):
                    page = re.fullmatch(r"<urn:page:(-?[0-9]+)>", found.headers.get("warc-record-id", ""))
                    if page and int(page[1]) % every == rest:
                        hurt[(found.start + found.end) // 2] ^= 0xFF
                yield pd.DataFrame({"path": [path], "content": [bytes(hurt)]})

    return files.mapInPandas(spoil, "path string, content binary")


def gaps(parsed: DataFrame) -> DataFrame:
    """The log of quarantined byte ranges."""
    return parsed.filter("kind = 'gap'").select("archive", "start", "end", "reason")


def records(parsed: DataFrame) -> DataFrame:
    """Records with page ids: (page_id, record_type, refers_to, payload_digest, payload_bytes, payload, target_uri)."""

    def page(column: str):
        found = F.regexp_extract(column, r"^<urn:page:(-?[0-9]+)>$", 1)
        return F.when(found != "", found).cast("long")

    rows = parsed.filter("kind = 'record'")
    return rows.select(
        page("record_id").alias("page_id"),
        "record_type",
        page("refers_to").alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        "payload",
        "target_uri",
    )
