"""Dense numbering without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BITS = 22


def dense_index(df: DataFrame, key: str, out: str = "cell_index", bits: int = BITS) -> DataFrame:
    """Number rows 0..n-1 in ascending order of a unique bigint key.

    Rows are numbered inside blocks of ``2**bits`` consecutive key values, blocks
    inside groups of ``2**bits`` blocks, and groups one after another. The width
    of a key bounds every window, also for sparse or hashed keys: ``2**bits`` rows
    per block and group, ``2**(64 - 2 * bits)`` groups in all.
    """
    block, group = "__block", "__group"
    blocked = df.withColumn(block, F.shiftright(F.col(key).cast("bigint"), bits))
    counts = blocked.groupBy(block).agg(F.count(F.lit(1)).alias("__n")).withColumn(
        group, F.shiftright(block, bits))
    groups = counts.groupBy(group).agg(F.sum("__n").alias("__total"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    firsts = groups.select(group, F.coalesce(
        F.sum("__total").over(earlier(Window.orderBy(group))), F.lit(0)).alias("__first"))
    starts = counts.withColumn("__before", F.coalesce(
        F.sum("__n").over(earlier(Window.partitionBy(group).orderBy(block))), F.lit(0)))
    starts = starts.join(firsts, group).select(
        block, (F.col("__first") + F.col("__before")).alias("__start"))
    inside = Window.partitionBy(block).orderBy(key)
    return (
        blocked.join(starts, block)
        .withColumn(out, F.col("__start") + F.row_number().over(inside) - 1)
        .drop(block, "__start")
    )
