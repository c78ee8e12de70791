"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised at quantiles of all rows, the cells are numbered
along the curve, and the curve order is cut into runs. Rows that are close in
all dimensions end up in the same run, so the bounds of each shard in every
dimension are narrow and a filter on any of them skips most shards.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridsteps.llm.common import free_name, numbered, raw_texts, running_sums, slices, stored

BITS = 6
SHARDS = 16

KEYS = "doc_id long, size long, text_crc32 long"


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with one row per dimension."""
    x = cells.astype(np.uint64).copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(x.shape[0]):
            upper = (x[i] & bit) != 0
            swap = np.where(upper, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
    for i in range(1, x.shape[0]):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
    x ^= turn
    index = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(x.shape[0]):
            index = (index << one) | ((x[i] >> np.uint64(level)) & one)
    return index


def measured(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, lang, source of every whole text, and the number that column ``row`` holds."""

    def measure(batches):
        for whole in batches:
            for batch in slices(whole):
                texts = [t or b"" for t in raw_texts(batch)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(t) + 1 for t in texts], pa.int64()),
                     pa.array([zlib.crc32(t) for t in texts], pa.int64()), *batch.columns[2:]],
                    names=["doc_id", "size", "text_crc32", *batch.schema.names[2:]])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                         *(F.col(c).cast("string").alias(c) for c in ("lang", "source")), *([F.col(row).alias("row")] if row else []))
    return picked.mapInArrow(measure, KEYS + ", lang string, source string" + ", row long" * bool(row))


def quantile_cuts(rows: DataFrame, dimension: str, cells: int) -> list:
    """At most ``cells - 1`` values that cut all rows into runs of about equal numbers.

    Numbers go through one mergeable quantile summary. Other values are counted
    first, and the running sums over distinct values tell where a cut falls.
    """
    kind = dict(rows.dtypes)[dimension]
    some = rows.filter(F.col(dimension).isNotNull())
    if kind in ("bigint", "int", "double"):
        steps = [k / cells for k in range(1, cells)]
        return sorted(set(some.agg(F.percentile_approx(dimension, steps, 100 * cells)).first()[0] or []))
    counted = some.groupBy(dimension).agg(F.count("*").alias("n"))
    ordered, (_, total) = running_sums(counted, [F.col(dimension)], ["n"])
    step = lambda c: F.floor(c * cells / F.lit(total))
    cut = ordered.filter(step(F.col("before")[1]) < step(F.col("before")[1] + F.col("n")))
    return sorted(r[0] for r in cut.select(dimension).collect())


def on_curve(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """Adds ``curve``; a null takes cell 0 of its dimension."""
    cuts = [quantile_cuts(rows, d, (1 << bits) - 1) for d in dimensions]
    at = [rows.columns.index(d) for d in dimensions]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", curve long"

    def number(batches):
        for batch in batches:
            cells = np.zeros((len(at), batch.num_rows), np.uint64)
            for k, i in enumerate(at):
                values = batch.column(i).to_pylist()
                if cuts[k] and isinstance(cuts[k][0], str):
                    # Strings compare by code point, like the engine's bytes.
                    codes = {v: int(np.searchsorted(np.array(cuts[k], object), v, side="left")) + 1 for v in {*values} - {None}}
                    cells[k] = [0 if v is None else codes[v] for v in values]
                else:
                    filled = np.array([0 if v is None else v for v in values])
                    codes = np.searchsorted(np.array(cuts[k]), filled, side="left") + 1
                    cells[k] = np.where([v is None for v in values], 0, codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve_index(cells, bits).astype(np.int64))],
                                             names=[*batch.schema.names, "curve"])

    return rows.mapInArrow(number, schema)


def shard(docs: DataFrame, shards: int = SHARDS, law: str = "rows",
          dimensions: tuple[str, ...] = ("lang", "source", "size"), bits: int = BITS, row: str | None = None) -> DataFrame:
    """Every row with its shard and slot: doc_id, size, text_crc32, lang, source, curve, law, shard, slot, grown_shard.

    ``law`` is ``rows`` (numbers of rows differ by one at most) or ``bytes``
    (runs of equal total size, up to one document). Rows of one cell are ordered
    by checksum, size and doc_id, so a crowded cell is cut like any other run and equal
    texts of a cell stand together, in one shard or in neighbouring ones. A
    null text has size 1; null dimensions come first; rows without doc_id come
    before others of equal text; repeated rows take neighbouring slots. Empty tables
    give no rows. Other columns are not read, but for the row's number, if column ``row`` holds
    one, which the result then has as ``row``.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"unknown law {law}")
    rows = stored(measured(docs, row), "hilbert-keys")
    placed = on_curve(rows, list(dimensions), bits)
    order = [F.col("curve"), F.col("text_crc32"), F.col("size"), F.col("doc_id").asc_nulls_first()]
    ordered, (n, total) = running_sums(placed, order, ["size"])
    ordered = ordered.select("*", F.col("before")[0].alias("rank"), F.col("before")[1].alias("ahead")).drop("before")
    if law == "rows":
        run = F.expr(f"cast(rank * {shards} div {max(n, 1)} AS int)")
        first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
        found = ordered.withColumn("shard", run).withColumn("slot", F.col("rank") - first)
    else:
        run = F.expr(f"cast(least({shards - 1}, cast((ahead + size / 2) * {shards} / {max(total, 1)} AS int)) AS int)")
        found = ordered.withColumn("shard", run)
        starts = found.groupBy("shard").agg(F.min("rank").alias("first"))
        # One row per shard.
        found = found.join(F.broadcast(starts), "shard").withColumn("slot", F.col("rank") - F.col("first")).drop("first")
    return found.select("doc_id", "size", "text_crc32", "lang", "source", "curve", F.lit(law).alias("law"), "shard",
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                        *(["row"] if row else []))


def bounds(assigned: DataFrame, dimensions: tuple[str, ...] = ("lang", "source", "size")) -> DataFrame:
    """Rows and bounds of each dimension per shard, for pruning."""
    least = [f(d).alias(f"{p}_{d}") for d in dimensions for p, f in (("min", F.min), ("max", F.max))]
    return assigned.groupBy("shard").agg(F.count("*").alias("n_rows"), *least)


def prune(shard_bounds: DataFrame, dimension: str, low, high) -> DataFrame:
    """The shards that can hold values of a closed range."""
    return shard_bounds.filter((F.col(f"max_{dimension}") >= low) & (F.col(f"min_{dimension}") <= high))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, law: str = "rows", **options) -> None:
    """Every row as Parquet, in folders per shard and in slot order; the folders' column is ``_shard``.

    Rows are numbered and placed by their number, so null and repeated ids, repeated rows and
    null texts are written once each. Where the documents have a column of that name, the
    folders' gets underscores before it. An empty table writes no shard.
    """
    row, name, slot = (free_name(docs, n) for n in ("row_number", "_shard", "slot_number"))
    rows = numbered(docs, row)
    placed = shard(rows, shards, law, row=row, **options).select(
        F.col("row").alias(free_name(rows, "placed")), F.col("shard").alias(name), F.col("slot").alias(slot))
    joined = rows.join(placed, rows[row] == placed[placed.columns[0]]).drop(row, placed.columns[0])
    (joined.repartitionByRange(name, slot).sortWithinPartitions(name, slot).drop(slot)
     .write.partitionBy(name).parquet(path))
