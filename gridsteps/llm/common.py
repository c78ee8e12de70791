"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridsteps.session import work_dir

SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows written once to the shared folder and read back.

    Cuts the lineage, so a lost executor never makes earlier stages run again,
    and several readers share one evaluation.
    """
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width_of(spark: SparkSession) -> int:
    """Tasks that a shuffle of the session makes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, name: str = "text", size: int = SLICE_BYTES,
           rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of a batch of about ``size`` bytes of text, one row at least and ``rows`` at most."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(name))
    lengths = np.array([0 if v is None else v for v in pa.compute.binary_length(column).to_pylist()], np.int64)
    ends = np.cumsum(lengths + 1)
    start, base = 0, 0
    while start < batch.num_rows:
        stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, base + size, side="right"))))
        yield batch.slice(start, stop - start)
        start, base = stop, int(ends[stop - 1])


def worker_registry() -> dict:
    """A dict of the Python process; functions of this package reach workers by value, with globals of their own."""
    return sys.modules.setdefault("_gridsteps_worker", types.ModuleType("_gridsteps_worker")).__dict__


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def running_sums(df: DataFrame, order: list[Column], weights: list[str]) -> tuple[DataFrame, list[int]]:
    """The rows in a global order with sums over all rows before each, and the totals.

    Adds ``before`` (an array with a sum per weight column, preceded by the
    number of rows). Two passes: range partitions are sorted and summed on their
    own and written; their totals, one row per partition, give the offsets.
    Order columns should tell rows apart, so that ties can be split.
    """
    k = len(weights) + 1
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", part int, before array<long>"
    at = [df.columns.index(w) for w in weights]

    def add(batches):
        part, sums = TaskContext.get().partitionId(), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns = [np.ones(batch.num_rows, np.int64)]
            columns += [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in at]
            values = np.stack(columns, axis=1)
            ends = sums + np.cumsum(values, axis=0)
            sums = ends[-1]
            before = pa.ListArray.from_arrays(np.arange(0, (batch.num_rows + 1) * k, k, dtype=np.int32),
                                              pa.array((ends - values).ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), before],
                names=[*batch.schema.names, "part", "before"])

    spark = df.sparkSession
    ordered = df.repartitionByRange(width_of(spark), *order).sortWithinPartitions(*order)
    summed = stored(ordered.mapInArrow(add, schema), "running-sums")
    own = ["count(*)", *(f"sum(`{w}`)" for w in weights)]
    rows = summed.groupBy("part").agg(F.array(*(F.expr(e).cast("long") for e in own)).alias("t")).collect()
    offsets, total = [], [0] * k
    for r in sorted(rows, key=lambda r: r.part):
        offsets.append((r.part, list(total)))
        total = [x + y for x, y in zip(total, r.t)]
    starts = spark.createDataFrame(offsets, "part int, offset array<long>")
    # One row per shuffle partition.
    found = summed.join(F.broadcast(starts), "part").withColumn(
        "before", F.zip_with("before", "offset", lambda x, y: x + y)).drop("part", "offset")
    return found, total


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with a number of their own, written once so that it never changes."""
    def tag(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = pa.array(range(number, number + batch.num_rows), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, rows], names=[*batch.schema.names, name])
            number += batch.num_rows

    schema = type(df.schema)([*df.schema.fields]).add(name, "long")
    return stored(df.mapInArrow(tag, schema), "numbered")


def release_cached() -> None:
    """Drop what earlier tasks of other operators keep in this worker process."""
    held = worker_registry()
    for key in [k for k in held if isinstance(k, tuple)]:
        del held[key]
