"""User functions on spatial blocks with a border.

Space is cut into square blocks. A function sees the rows of one block together with
copies of the rows within ``halo`` of it, so that whatever looks no farther than
``halo`` is computed as if all rows were there. Crowded blocks are cut in four, time
and again, while their sides stay as long as the border is wide.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gridsteps.model import require_columns

MAX_ROWS = 50_000
MAX_CUTS = 5


def cut_blocks(rows: DataFrame, side: float, halo: float, max_rows: int = MAX_ROWS) -> DataFrame:
    """(bx, by, blocks): the blocks of each occupied square of ``side``, as (cuts, x, y).

    ``x`` and ``y`` count in sides of the smallest blocks. A block of more than
    ``max_rows`` rows is cut in four as long as the parts are no narrower than the
    border. Rows are counted per smallest square first; only these counts meet per
    square, 4 ** MAX_CUTS at most.
    """
    cuts = most_cuts(side, halo)
    fine = side / 2 ** cuts
    tiles = rows.groupBy(F.floor(F.col("lon") / fine).alias("x"), F.floor(F.col("lat") / fine).alias("y")).agg(
        F.count(F.lit(1)).alias("n")).filter("x IS NOT NULL AND y IS NOT NULL")
    low = lambda c, k: F.shiftleft(F.shiftright(c, cuts - k), cuts - k)
    tiles = tiles.withColumn("bx", F.shiftright("x", cuts)).withColumn("by", F.shiftright("y", cuts))
    chosen: Column = F.lit(cuts)
    for k in range(cuts, -1, -1):
        inside = Window.partitionBy("bx", "by", low(F.col("x"), k), low(F.col("y"), k))
        tiles = tiles.withColumn(f"n{k}", F.sum("n").over(inside))
        chosen = F.when(F.col(f"n{k}") <= max_rows, F.lit(k)).otherwise(chosen)
    tiles = tiles.withColumn("cuts", chosen)
    corner = F.expr(f"shiftleft(1, {cuts} - cuts)")
    block = F.struct("cuts", (F.col("x") - F.pmod("x", corner)).alias("x"), (F.col("y") - F.pmod("y", corner)).alias("y"))
    return tiles.groupBy("bx", "by").agg(F.collect_set(block).alias("blocks"))


def most_cuts(side: float, halo: float) -> int:
    """How often a block may be cut in four without getting narrower than the border."""
    if not 0 < halo <= side:
        raise ValueError(f"the border ({halo}) must be positive and no wider than a block ({side})")
    return min(MAX_CUTS, int(math.log2(side / halo)))


def with_halo(rows: DataFrame, side: float, halo: float, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows once per block they belong to or border on, with ``block`` and ``core``.

    ``block`` names the block; ``core`` is true in the one block that holds the row's
    place. Rows without a place belong to no block and are left out.
    """
    require_columns(rows, ["lon", "lat"])
    cuts = most_cuts(side, halo)
    fine = side / 2 ** cuts
    blocks = cut_blocks(rows, side, halo, max_rows)
    far = halo * (1 + 1e-9)  # a little more, so that rounding never drops a row
    near = {}
    for c, name in (("lon", "x"), ("lat", "y")):
        near[f"{name}0"] = F.floor((F.col(c) - far) / fine)
        near[f"{name}1"] = F.floor((F.col(c) + far) / fine)
        near[name] = F.floor(F.col(c) / fine)
    reach = F.struct(*(v.alias(k) for k, v in near.items()))
    placed = (
        rows.filter("lon IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lon) AND NOT isnan(lat)").withColumn("__reach", reach)
        .withColumn("bx", F.explode(F.sequence(F.shiftright("__reach.x0", cuts), F.shiftright("__reach.x1", cuts))))
        .withColumn("by", F.explode(F.sequence(F.shiftright("__reach.y0", cuts), F.shiftright("__reach.y1", cuts))))
    )
    width = lambda b: F.call_function("shiftleft", F.lit(1), F.lit(cuts) - b["cuts"])

    def touched(b: Column) -> Column:
        out = F.lit(True)
        for c, name in (("lon", "x"), ("lat", "y")):
            out &= (F.col(c) + far >= b[name] * fine) & (F.col(c) - far < (b[name] + width(b)) * fine)
        return out

    b, r = F.col("__block"), F.col("__reach")
    core = ((r["x"] >= b["x"]) & (r["x"] < b["x"] + width(b)) & (r["y"] >= b["y"]) & (r["y"] < b["y"] + width(b)))
    return (
        placed.join(blocks, ["bx", "by"]).withColumn("__block", F.explode(F.filter("blocks", touched)))
        .withColumn("block", F.concat_ws("/", "__block.cuts", "__block.x", "__block.y")).withColumn("core", core)
        .drop("bx", "by", "blocks", "__block", "__reach")
    )


def map_blocks(rows: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str, side: float, halo: float,
               by: Sequence[str] = (), max_rows: int = MAX_ROWS) -> DataFrame:
    """Apply ``fn(own, around)`` to every block, and every value of ``by`` in it.

    ``rows`` carries lon and lat. ``own`` holds the rows of the block, ``around``
    those and the copies within ``halo`` of it, both with the columns of ``rows``; the
    result has ``schema``. Blocks are cut by rows of all values of ``by`` together.
    """
    names = rows.columns
    nothing = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def run(table: pa.Table) -> pa.Table:
        around = table.select(names)
        own = around.filter(table.column("core"))
        return fn(own, around) if own.num_rows else nothing  # only copies: nothing to compute

    return with_halo(rows, side, halo, max_rows).groupBy("block", *by).applyInArrow(run, schema)
