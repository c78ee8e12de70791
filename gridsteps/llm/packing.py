"""Concatenate and cut: documents as one id stream, cut into fixed windows.

Pass 1 tokenizes every document once and stores its ids with the number of ids
before it in its partition. Sums over partition totals (one number each) give
global offsets. Pass 2 cuts each partition's stretch at multiples of the window.
Windows that no single stretch covers come out as boundary records, at most two
per stretch; only these are shuffled and joined.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridsteps.llm.common import raw_texts, slices, stored
from gridsteps.llm.tokens import default_path, encoder

WINDOW = 1024

TOKENS = "part int, before long, doc_id long, n long, ids binary"
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long"
FRAGMENTS = f"sequence_id long, at long, whole boolean, ids binary, pieces array<struct<{PIECE.replace(' long', ':bigint')}>>"


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Pass 1: ids of each document and the ids before it in its partition."""

    def encode(batches):
        enc = encoder(tokenizer_path)
        end = np.array([end_id], enc.dtype).tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole):
                ids = [i + end for i in enc.encode("" if t is None else t.decode() for t in raw_texts(batch))]
                n = np.array([len(i) // enc.dtype.itemsize for i in ids], np.int64)
                ends = before + np.cumsum(n)
                before = int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n.size, part, np.int32)), pa.array(ends - n), batch.column(0),
                     pa.array(n), pa.array(ids, pa.binary())],
                    names=["part", "before", "doc_id", "n", "ids"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return picked.mapInArrow(encode, TOKENS)


class _Cutter:
    """Assembles windows from documents that follow one another in the stream."""

    def __init__(self, window: int, item: int):
        self.window, self.item = window, item
        self.next = None  # global position after the last id seen
        self.parts: list[bytes] = []
        self.pieces: list[tuple] = []
        self.at = self.sequence = 0
        self.rows: list[tuple] = []

    def flush(self) -> None:
        if self.pieces:
            length = sum(p[2] for p in self.pieces)
            self.rows.append((self.sequence, self.at, length == self.window, b"".join(self.parts), self.pieces))
            self.parts, self.pieces = [], []

    def add(self, position: int, doc_id: int | None, n: int, ids: bytes) -> None:
        if position != self.next:
            self.flush()
        start = 0
        while start < n:
            sequence, offset = divmod(position + start, self.window)
            if not self.pieces:
                self.sequence, self.at = sequence, offset
            length = min(n - start, self.window - offset)
            data = ids[start * self.item:(start + length) * self.item]
            wide = np.frombuffer(data, f"<u{self.item}").astype("<u4").tobytes()
            self.parts.append(data)
            self.pieces.append((doc_id, start, length, zlib.crc32(wide), n, offset))
            if offset + length == self.window:
                self.flush()
            start += length
        self.next = position + n


def pack_sequences(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW,
                   end_id: int = 0) -> DataFrame:
    """Sequences of ``window`` ids: sequence_id, ids (bytes of the narrowest id width), pieces.

    Every id of every document lies in one piece; only the last sequence is
    shorter. A null text is an empty document of one end id; rows without doc_id
    and repeated rows are packed like any other. An empty table gives no rows.
    """
    tokenizer_path = tokenizer_path or default_path()
    item = encoder(tokenizer_path).dtype.itemsize
    tokens = stored(tokenized(docs, tokenizer_path, end_id), "packing-tokens", "zstd")
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total")).collect()
    offsets, at = {}, 0
    for part, total in sorted((r.part, r.total) for r in totals):
        offsets[part] = at
        at += total
    last = at // window if at % window else -1
    piece_type = pa.struct([(p.split()[0], pa.int64()) for p in PIECE.split(", ")])

    def cut(batches):
        cutter = _Cutter(window, item)

        def out():
            rows, cutter.rows = cutter.rows, []
            names = [p.split()[0] for p in PIECE.split(", ")]
            columns = list(zip(*rows))
            flat = [p for pieces in columns[4] for p in pieces]
            ends = np.cumsum([0, *map(len, columns[4])]).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*flat)], names=names)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array([w or s == last and a == 0 and s * window + sum(p[2] for p in ps) == at
                           for s, a, w, _, ps in rows]),
                 pa.array(columns[3], pa.binary()),
                 pa.ListArray.from_arrays(ends, values.cast(piece_type))],
                names=["sequence_id", "at", "whole", "ids", "pieces"])

        for batch in batches:
            for part, before, doc_id, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                cutter.add(offsets[part] + before, doc_id, n, ids)
                if len(cutter.rows) >= 4096:
                    yield out()
        cutter.flush()
        if cutter.rows:
            yield out()

    found = stored(tokens.mapInArrow(cut, FRAGMENTS), "packing-windows", "zstd")
    whole = found.filter("whole").select("sequence_id", "ids", "pieces")
    # At most ``window`` fragments share a sequence, since each holds an id.
    joined = (
        found.filter("NOT whole").groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("at", "ids", "pieces"))).alias("f"))
        .select("sequence_id", F.expr("aggregate(f, cast('' AS binary), (a, x) -> concat(a, x.ids))").alias("ids"),
                F.expr("flatten(transform(f, x -> x.pieces))").alias("pieces"))
    )
    return whole.unionByName(joined)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece of the sequences."""
    return sequences.select("sequence_id", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens", "sequence_id", "p.offset")
