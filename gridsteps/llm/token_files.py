"""Binary token files: ids bit-packed at the width of the vocabulary.

File layout (all integers little-endian):

    header   8 bytes magic, u32 width, u32 ids per block
    blocks   packed ids; every block but the last holds the same number of ids
    table    i64 doc ids, u8 presence flags, u64 starts (one more than documents)
    offsets  u64 byte offset of each block, one more than blocks
    footer   u64 ids, u64 documents, u64 blocks, u64 table offset, 8 bytes magic

A reader finds any id from the footer, the block offsets and one block.
Tasks write files under names of their own attempt; only the manifest rows that
Spark commits name the valid files, so repeated attempts leave no wrong data.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridsteps.llm.bits import min_width, pack, unpack
from gridsteps.llm.common import raw_texts, slices, stored, width_of
from gridsteps.llm.tokens import default_path, encoder, vocabulary_size
from gridsteps.session import work_dir
from gridsteps.sources.files import open_path

MAGIC = b"TOKBITS1"
HEADER = "<8sII"
FOOTER = "<QQQQ8s"
BLOCK_IDS = 1 << 16
DOCS_PER_FILE = 1 << 16
QUANTILES = 4096

MANIFEST = "file int, path string, n_docs long, n_ids long, n_bytes long"


class FileWriter:
    """Streams documents into one token file; holds one block and the document table."""

    def __init__(self, path: str, width: int, block_ids: int):
        system, inner = open_path(path)
        self.out = system.open_output_stream(inner)
        self.width, self.block_ids = width, block_ids
        self.out.write(struct.pack(HEADER, MAGIC, width, block_ids))
        self.at = struct.calcsize(HEADER)
        self.offsets = [self.at]
        self.pending: list[np.ndarray] = []
        self.n_pending = self.n_ids = 0
        self.doc_ids: list[int | None] = []
        self.starts = [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.n_ids += ids.size
        self.starts.append(self.n_ids)
        self.pending.append(ids)
        self.n_pending += ids.size
        if self.n_pending >= self.block_ids:
            held = np.concatenate(self.pending)
            cut = held.size // self.block_ids * self.block_ids
            for k in range(0, cut, self.block_ids):
                self._block(held[k:k + self.block_ids])
            self.pending, self.n_pending = [held[cut:]], held.size - cut

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.out.write(data)
        self.at += len(data)
        self.offsets.append(self.at)

    def close(self) -> int:
        if self.n_pending:
            self._block(np.concatenate(self.pending))
        table = self.at
        self.out.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array([d is not None for d in self.doc_ids], np.uint8).tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(struct.pack(FOOTER, self.n_ids, len(self.doc_ids), len(self.offsets) - 1, table, MAGIC))
        size = self.out.tell()
        self.out.close()
        return size


class FileReader:
    """Random access to one token file."""

    def __init__(self, path: str):
        system, inner = open_path(path)
        self.f = system.open_input_file(inner)
        size = self.f.size()
        magic, self.width, self.block_ids = struct.unpack(HEADER, self.f.read_at(struct.calcsize(HEADER), 0))
        self.n_ids, self.n_docs, self.n_blocks, table, end = struct.unpack(FOOTER, 
            self.f.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        tail = self.f.read_at(size - struct.calcsize(FOOTER) - table, table)
        n, at = self.n_docs, 0
        ids = np.frombuffer(tail, "<i8", n, at)
        present = np.frombuffer(tail, np.uint8, n, at + 8 * n)
        self.doc_ids = [int(d) if p else None for d, p in zip(ids, present)]
        self.starts = np.frombuffer(tail, "<u8", n + 1, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(tail, "<u8", self.n_blocks + 1, 9 * n + 8 * (n + 1)).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        low, high = int(self.offsets[k]), int(self.offsets[k + 1])
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        return unpack(self.f.read_at(high - low, low), self.width, n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file, from the blocks that hold them."""
        if not n:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (start + n - 1) // self.block_ids
        held = np.concatenate([self.block(k) for k in range(first, last + 1)])
        low = start - first * self.block_ids
        return held[low:low + n]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) in file order; each block is unpacked once."""
        held, held_at, k = np.empty(0, np.uint32), 0, 0
        for i in range(self.n_docs):
            low, high = int(self.starts[i]), int(self.starts[i + 1])
            more = [held[low - held_at:]]
            held_at = low
            n = more[0].size
            while n < high - low:
                more.append(self.block(k))
                n += more[-1].size
                k += 1
            held = np.concatenate(more) if len(more) > 1 else more[0]
            yield self.doc_ids[i], low, held[:high - low]

    def close(self) -> None:
        self.f.close()


class Routes:
    """Which file a row goes to: files cover ascending runs of ids, and several of them one id that many rows share."""

    def __init__(self, bounds: list[int], parts: dict[int | None, int]):
        """``bounds`` end the runs; ``parts`` says how many files the rows of one id fill, if more than one."""
        ends = {*bounds}
        for k in parts:
            if k is not None:
                ends |= {k - 1, k}
        self.ends = np.array(sorted(ends), np.int64)
        # Run 0 is for rows without id if they fill files of their own; else they precede the first run in its file.
        counts = np.ones(len(ends) + 2, np.int64)
        counts[0] = parts.get(None, 0)
        for k, n in parts.items():
            if k is not None:
                counts[1 + int(np.searchsorted(self.ends, k))] = n
        self.counts, self.first = counts, np.cumsum(counts) - counts
        self.files = int(counts.sum())

    def of(self, ids: list[int | None], texts: list[bytes], seen: dict) -> list[int]:
        """Files of rows; those of a shared id are dealt by checksum, equal ones in turn (``seen`` counts them)."""
        runs = np.searchsorted(self.ends, np.array([k or 0 for k in ids], np.int64), side="left") + 1
        files = []
        for k, run, text in zip(ids, runs.tolist(), texts):
            if k is None:
                run = 0 if self.counts[0] else 1
            n = int(self.counts[run])
            part = 0
            if n > 1:
                checksum = zlib.crc32(text)
                turn = seen.get((k, checksum), 0)
                seen[k, checksum] = turn + 1
                part = (checksum + turn) % n
            files.append(int(self.first[run]) + part)
        return files


def encoded(docs: DataFrame, path: str, end_id: int, routes: Routes) -> DataFrame:
    """(file, doc_id, ids): id bytes of each document with its end id, and the file it goes to."""

    def encode(batches):
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        seen: dict = {}
        for whole in batches:
            for batch in slices(whole):
                texts = [b"" if t is None else t for t in raw_texts(batch)]
                files = routes.of(batch.column(0).to_pylist(), texts, seen)
                ids = [i + end for i in enc.encode(t.decode() for t in texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(files, pa.int32()), batch.column(0), pa.array(ids, pa.binary())],
                    names=["file", "doc_id", "ids"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return picked.mapInArrow(encode, "file int, doc_id long, ids binary")


def shared_ids(docs: DataFrame, rows_per_file: int) -> dict[int | None, int]:
    """Ids of more rows than a file holds, and the files they fill; at most one id per ``rows_per_file`` rows."""
    counted = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    return {r.doc_id: -(-r.n // rows_per_file) for r in counted.filter(F.col("n") > rows_per_file).collect()}


def range_bounds(docs: DataFrame, files: int) -> list[int]:
    """At most ``files - 1`` ascending ids that cut all ids into runs of about equal numbers.

    A bounded number of quantiles comes from one mergeable summary of all ids;
    where more files are wanted, the ids between two quantiles are cut evenly.
    """
    if files < 2:
        return []
    n = min(files, QUANTILES)
    ids = F.col("doc_id").cast("long")
    low, cuts, high = docs.agg(F.min(ids), F.percentile_approx(ids, [k / n for k in range(1, n)], 100 * n), F.max(ids)).first()
    if low is None:
        return []
    edges = sorted({low, *cuts, high})
    parts = files // n
    return sorted({a + (b - a) * k // parts for a, b in zip(edges, edges[1:]) for k in range(1, parts + 1)} - {high})


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer_path: str | None = None,
                      end_id: int = 0, block_ids: int = BLOCK_IDS, docs_per_file: int = DOCS_PER_FILE) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the committed manifest.

    Files cover consecutive ranges of doc_id, cut at quantiles of all ids; an id, or the lack of one,
    that more rows share than a file is meant for fills several. A null text counts as empty,
    a document without id comes first, repeated ids stay next to each other. Other
    columns are not looked at.
    """
    spark = docs.sparkSession
    tokenizer_path = tokenizer_path or default_path()
    folder = folder or work_dir(spark, "token-files")
    width = min_width(max(vocabulary_size(tokenizer_path), end_id + 1))
    n = docs.count()
    files = max(1, min(n, max(width_of(spark), -(-n // docs_per_file))))
    per_file = -(-n // files) if n else 1
    routes = Routes(range_bounds(docs, files), shared_ids(docs, per_file))
    system, inner = open_path(folder)
    system.create_dir(inner, recursive=True)

    def write(batches):
        writer, current, path = None, None, None
        dtype = np.dtype("<u2" if width <= 16 else "<u4")

        def done():
            size = writer.close()
            return pa.RecordBatch.from_pydict(
                {"file": pa.array([current], pa.int32()), "path": [path], "n_docs": [len(writer.doc_ids)],
                 "n_ids": [writer.n_ids], "n_bytes": [size]})

        for batch in batches:
            for file, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if file != current:
                    if writer:
                        yield done()
                    current, path = file, f"{folder}/{file:07d}-{uuid.uuid4().hex}.tok"
                    writer = FileWriter(path, width, block_ids)
                writer.add(doc_id, np.frombuffer(ids, dtype))
        if writer:
            yield done()

    rows = encoded(docs, tokenizer_path, end_id, routes)
    routed = rows.repartitionById(routes.files, F.col("file"))
    ordered = routed.sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "ids")
    return stored(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the files of a manifest: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it in the whole set; the
    totals per file (one row each) are summed on the driver. With ``with_ids``
    the ids follow as an array.
    """
    spark = manifest.sparkSession
    totals = sorted((r.file, r.n_ids) for r in manifest.select("file", "n_ids").collect())
    before, at = {}, 0
    for file, n in totals:
        before[file] = at
        at += n
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def read(batches):
        for batch in batches:
            for file, path in zip(*(c.to_pylist() for c in batch.columns)):
                reader = FileReader(path)
                rows: list[tuple] = []
                held = 0
                for doc_id, start, ids in reader.documents():
                    row = (doc_id, before[file] + start, ids.size, zlib.crc32(ids.astype("<u4").tobytes()))
                    rows.append((*row, ids) if with_ids else row)
                    held += ids.size if with_ids else 1
                    if held >= 1 << 20 or len(rows) >= 8192:
                        yield _batch(rows, with_ids, names)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, with_ids, names)
                reader.close()

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    paths = manifest.select("file", "path").repartition(max(1, len(totals)))
    return paths.mapInArrow(read, schema)


def _batch(rows: list[tuple], with_ids: bool, names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]]
    if with_ids:
        columns.append(pa.array([r[4].astype(np.int64) for r in rows], pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(columns, names=names)
