"""WARC archives: deduplicating writer and salvage reader.

Records are gzip members of their own. Files carry names of the attempt that
wrote them, and only manifest rows that Spark commits name valid files.

The reader checks every record: gzip checksum, version line, headers, declared
lengths, block and payload digests. After a failed check it searches for the next valid member (or
version line, in plain files), goes on from there, and reports the bytes passed
over as a quarantined gap. It holds one record and one buffer at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridsteps.llm.common import stored
from gridsteps.session import work_dir
from gridsteps.sources.files import open_path

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"
GZIP = b"\x1f\x8b\x08"
MIN_DEDUP_BYTES = 0
BUFFER = 1 << 20
PAGES_PER_FILE = 1 << 15

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = ("path string, offset long, record_type string, record_id string, target_uri string, refers_to_id string, "
           "payload_digest string, payload_bytes long, payload binary, gap_bytes long, reason string")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One uncompressed record; a revisit has the HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"),
               ("WARC-Record-ID", f"<{PAGE_URN}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        # White space and control characters would break the header line.
        uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        headers.append(("WARC-Target-URI", uri))
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]
    headers += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
                ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
                ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def first_pages(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """digest and the smallest page_id of every payload that occurs more than once."""
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), _digest().alias("digest"),
                         F.octet_length(_payload()).alias("size"))
    return keyed.filter(F.col("size") >= min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("digest", "first_id")


def _payload():
    return F.coalesce(F.col("html"), F.lit(""))


def _digest():
    # The length guards the digest; equal digests and lengths are taken as equal payloads.
    return F.concat(F.sha1(F.encode(_payload(), "utf-8")), F.lit(":"), F.octet_length(_payload()))


def write_warc(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_DEDUP_BYTES,
               date: str = "2024-01-01T00:00:00Z", compress: bool = True,
               pages_per_file: int = PAGES_PER_FILE) -> DataFrame:
    """Write a record per row; returns the committed manifest (path, n_records, n_bytes).

    Among equal payloads of at least ``min_bytes`` the row with the smallest
    page_id is the response and the others revisit it. A null html is an empty
    payload. A row without page_id never is the first of its payload unless no
    row has one; rows that repeat the first page_id are responses as well. Other
    columns are not read.
    """
    folder = folder or work_dir(pages.sparkSession, "warc")
    system, inner = open_path(folder)
    system.create_dir(inner, recursive=True)
    firsts = first_pages(pages, min_bytes)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.encode(_payload(), "utf-8").alias("payload"), _digest().alias("page_digest"))
    joined = rows.join(firsts, F.col("page_digest") == F.col("digest"), "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def write(batches):
        out, path, records, size = None, None, 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [records], "n_bytes": [size]})

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, records, size = f"{folder}/{uuid.uuid4().hex}.warc" + ".gz" * compress, 0, 0
                    target, place = open_path(path)
                    out = target.open_output_stream(place, compression=None)
                data = record(page_id, url, payload, refers_to, date)
                if compress:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = packer.compress(data) + packer.flush()
                out.write(data)
                records, size = records + 1, size + len(data)
                if records == pages_per_file:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return stored(joined.mapInArrow(write, MANIFEST), "warc-manifest")


class _Bad(Exception):
    pass


class _Input:
    """A file read forward through a sliding buffer that can look ahead and step back to ``at``."""

    def __init__(self, path: str):
        system, inner = open_path(path)
        self.f = system.open_input_file(inner)
        self.size = self.f.size()
        self.at = 0
        self.low, self.held = 0, b""

    def peek(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes at an offset."""
        n = max(0, min(n, self.size - at))
        if at < self.low or at + n > self.low + len(self.held):
            self.low, self.held = at, self.f.read_at(min(max(n, BUFFER), self.size - at), at)
        return self.held[at - self.low:at - self.low + n]

    def find(self, pattern: re.Pattern, at: int, overlap: int) -> int | None:
        """Offset of the next match at or after ``at``."""
        while at < self.size:
            window = self.peek(at, BUFFER)
            m = pattern.search(window)
            if m and (m.end() < len(window) or at + len(window) >= self.size):
                return at + m.start()
            if at + len(window) >= self.size:
                return None
            at += max(1, len(window) - overlap)
        return None


def _parse(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/\d+\.\d+", lines[0]):
        raise _Bad("no version line")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or re.search(rb"[\x00-\x08\x0a-\x1f\x7f]", line):
            raise _Bad("malformed header")
        try:
            fields[name.decode().strip().lower()] = value.decode().strip()
        except UnicodeDecodeError:
            raise _Bad("malformed header") from None
    if not all(fields.get(k) for k in ("warc-type", "warc-record-id", "warc-date")):
        raise _Bad("a mandatory header is missing")
    if not fields.get("content-length", "").isdigit():
        raise _Bad("no content length")
    return fields


def _check(fields: dict[str, str], block: bytes) -> tuple:
    """Payload and its length, after all digests have been compared."""
    def differs(name: str, data: bytes) -> bool:
        kind, _, value = fields.get(name, "").partition(":")
        return kind.lower() == "sha1" and value.upper() != base32_sha1(data)

    if differs("warc-block-digest", block):
        raise _Bad("block digest differs")
    kind = fields.get("warc-type", "")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise _Bad("no end of the HTTP header")
        size = len(payload)
        if kind == "revisit":
            # A revisit declares the length of the payload it stands for.
            m = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
            size = int(m[1]) if m else None
    if kind != "revisit" and differs("warc-payload-digest", payload):
        raise _Bad("payload digest differs")
    digest = fields.get("warc-payload-digest", "").partition(":")[2].upper() or base32_sha1(payload)
    ids = [fields.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")]
    return kind, ids[0], fields.get("warc-target-uri"), ids[1], digest, size, payload


def _whole(data: bytes) -> tuple:
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        raise _Bad("no end of the header")
    fields = _parse(head)
    n = int(fields["content-length"])
    if len(rest) < n or rest[n:] != b"\r\n\r\n":
        raise _Bad("length differs")
    return _check(fields, rest[:n])


def _member(source: _Input) -> tuple[tuple, int]:
    """The record of the gzip member at ``source.at`` and the offset after it."""
    if source.peek(source.at, 3) != GZIP:
        raise _Bad("no gzip member")
    unpacker, at, parts, n = zlib.decompressobj(31), source.at, [], 0
    while not unpacker.eof:
        data = source.peek(at, 1 << 16)
        if not data:
            raise _Bad("member is cut off")
        at += len(data)
        try:
            parts.append(unpacker.decompress(data))
        except zlib.error as e:
            raise _Bad(f"gzip: {e}") from None
        if n < 16 <= n + len(parts[-1]) and not b"".join(parts).startswith(b"WARC/"):
            raise _Bad("no version line")
        n += len(parts[-1])
    return _whole(b"".join(parts)), at - len(unpacker.unused_data)


def _plain(source: _Input) -> tuple[tuple, int]:
    """The uncompressed record at ``source.at`` and the offset after it."""
    n = 4096
    while b"\r\n\r\n" not in (head := source.peek(source.at, n)):
        if len(head) < n or n > 1 << 20:
            raise _Bad("no end of the header")
        n *= 2
    head = head[:head.index(b"\r\n\r\n")]
    total = len(head) + 4 + int(_parse(head)["content-length"]) + 4
    if source.at + total > source.size:
        raise _Bad("record is cut off")
    return _whole(source.peek(source.at, total)), source.at + total


_NEXT_MEMBER = re.compile(re.escape(GZIP))
_NEXT_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")


def salvage(path: str) -> Iterator[tuple]:
    """Rows of one file in file order: its records, and a ``gap`` row per stretch that was passed over."""
    source = _Input(path)
    packed = path.endswith(".gz")
    read, pattern, overlap = (_member, _NEXT_MEMBER, 8) if packed else (_plain, _NEXT_VERSION, 32)
    gap, reason = None, None
    while source.at < source.size:
        try:
            found, after = read(source)
        except _Bad as e:
            if gap is None:
                gap, reason = source.at, str(e)
            source.at = source.find(pattern, source.at + 1, overlap) or source.size
            continue
        if gap is not None:
            yield (path, gap, "gap", None, None, None, None, None, None, source.at - gap, reason)
            gap = None
        yield (path, source.at, *found, None, None)
        source.at = after
    if gap is not None:
        yield (path, gap, "gap", None, None, None, None, None, None, source.size - gap, reason)
    source.f.close()


def read_warc(paths: DataFrame, files: int | None = None) -> DataFrame:
    """Records and gaps (record_type ``gap``) of the files named by column ``path``, one task per few files."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    kinds = [types[c.split()[1]] for c in RECORDS.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in salvage(path):
                    rows.append(row)
                    held += 500 + len(row[8] or b"")
                    if held >= 4_000_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    picked = paths.select("path")
    return (picked.repartition(files) if files else picked).mapInArrow(read, RECORDS)


def list_warc(spark: SparkSession, folder: str) -> DataFrame:
    """path of the archive files below a folder, listed by Spark's own reader; none in an empty folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.{warc,warc.gz}").load(folder).select("path")


def lost_records(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """path, n_records, n_found of files that returned fewer records than were written.

    ``rows`` are those of ``read_warc``, or any that kept ``path`` and ``record_type``. A file of the
    manifest without a row has lost all its records.
    """
    found = rows.filter("record_type != 'gap'").groupBy("path").agg(F.count("*").alias("n_found"))
    return manifest.select("path", "n_records").join(found, "path", "left").withColumn(
        "n_found", F.coalesce("n_found", F.lit(0))).filter("n_found < n_records")


def read_pages(manifest: DataFrame, strict: bool = True) -> DataFrame:
    """``page_records`` of all files of a manifest, read once and stored.

    A file that returns fewer records than were written is an error that names it, unless ``strict`` is off; the
    log of its gaps is in ``read_warc``.
    """
    files = max(1, manifest.count())
    rows = read_warc(manifest, files).drop("payload")
    rows = stored(rows, "warc-records")
    if strict:
        lost = lost_records(manifest, rows).orderBy("path").first()
        if lost:
            raise ValueError(f"{lost.path}: {lost.n_found} of {lost.n_records} records came back")
    return page_records(rows)


def gaps(rows: DataFrame) -> DataFrame:
    """path, offset, gap_bytes, reason: the quarantine log; empty where every record passed its checks."""
    return rows.filter("record_type = 'gap'").select("path", "offset", "gap_bytes", "reason")


def page_records(rows: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records of ``write_warc``."""
    number = lambda c: F.regexp_extract(c, f"^{PAGE_URN}(-?[0-9]+)$", 1)
    return rows.filter("record_type != 'gap'").select(
        *(
            F.when(number(c) != "", number(c).cast("long")).alias(name)
            for c, name in (("record_id", "page_id"), ("refers_to_id", "refers_to"))),
        "payload_bytes", "payload_digest", "record_type")
