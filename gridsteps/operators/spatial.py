"""Neighbourhoods, nearest selection, and region extraction on cell tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridsteps.model import MISSING_INT
from gridsteps.operators.numbering import dense_index

# Neighbours kept per cell, and radius in cell sizes.
MAX_NEIGHBOURS = 8
RADIUS_FACTOR = 1.5


def _neighbour_lists(cells: DataFrame, by: str, cellsize: float) -> DataFrame:
    """Cell table with ``__near``: its first neighbours in ascending order.

    All cells of one coordinate share one list, so the search runs over distinct
    coordinates. Nothing beyond the smallest nine ids of a coordinate, or of the
    ids within reach, can enter a list of eight without the cell itself; both
    cuts are exact and bound what a crowded coordinate sends on.

    Coordinates meet by an equi-join on tiles whose diagonal is shorter than the
    radius. All points of a tile are then neighbours of each other, so the ninth
    smallest id of a tile limits the ids its points can still take from
    elsewhere, which thins candidates of crowded tiles before the join.

    Limits, candidates and lists have about a row per cell or more, but all
    derive from a few columns, so the size that Spark estimates from the files
    is far too small. The joins are merges, lest one be collected and broadcast.
    """
    keep = MAX_NEIGHBOURS + 1
    size: Column | float = cellsize
    if "cellsize" in cells.columns:
        # What is attached to the data wins over the argument.
        size = F.coalesce(cells.agg(F.max("cellsize")).scalar(), F.lit(cellsize))
    radius = RADIUS_FACTOR * size
    side = 0.7 * radius

    def tile(coord: Column) -> Column:
        # Never NULL, so no branch adds a filter of its own and all of them
        # share the one exchange by coordinate.
        return F.coalesce(F.floor(coord / side), F.lit(0))

    at_point = Window.partitionBy("lon", "lat").orderBy("pid")
    points = (
        cells.select(F.col(by).cast("bigint").alias("pid"), F.col("lon").cast("double").alias("lon"),
                     F.col("lat").cast("double").alias("lat"))
        .filter(F.col("pid").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .withColumn("rank", F.row_number().over(at_point))
        .withColumn("point", F.first("pid").over(at_point.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("rank") <= keep)
    )
    tiled = points.withColumn("tx", tile(F.col("lon"))).withColumn("ty", tile(F.col("lat")))

    in_tile = Window.partitionBy("tx", "ty").orderBy("pid")
    limits = (
        tiled.withColumn("r", F.row_number().over(in_tile)).filter(F.col("r") <= keep)
        .groupBy("tx", "ty")
        .agg(F.max(F.when(F.col("r") == keep, F.col("pid"))).alias("limit"))
    )

    def reach(coord: str) -> Column:
        far = radius * (1 + 1e-9)
        return F.explode(F.sequence(tile(F.col(coord) - far), tile(F.col(coord) + far)))

    candidates = (
        points.withColumn("tx", reach("lon")).withColumn("ty", reach("lat"))
        .select("tx", "ty", "pid", F.col("lon").alias("clon"), F.col("lat").alias("clat"))
        .join(limits.hint("merge"), ["tx", "ty"])
        .filter(F.col("limit").isNull() | (F.col("pid") <= F.col("limit")))
        .drop("limit")
    )

    seekers = tiled.filter(F.col("pid") == F.col("point")).select("point", "lon", "lat", "tx", "ty")
    dx, dy = F.col("lon") - F.col("clon"), F.col("lat") - F.col("clat")
    first = Window.partitionBy("point").orderBy("pid")
    lists = (
        seekers.join(candidates.hint("merge"), ["tx", "ty"])
        .filter(dx * dx + dy * dy <= radius * radius)
        .select("point", "lon", "lat", "pid")
        .withColumn("r", F.row_number().over(first)).filter(F.col("r") <= keep)
        .groupBy("point").agg(F.first("lon").alias("lon"), F.first("lat").alias("lat"),
                              F.array_sort(F.collect_list("pid")).alias("__ids"))
        .drop("point")
    )
    # Cells without a place have no neighbours; their NULL keys would meet in one task.
    lost = F.col("lon").isNull() | F.col("lat").isNull()
    placed = cells.filter(~lost).join(lists.hint("merge"), ["lon", "lat"], "left")
    nowhere = cells.filter(lost).withColumn("__ids", F.lit(None).cast("array<bigint>"))
    return (
        placed.unionByName(nowhere)
        .withColumn("__near", F.slice(
            F.filter(F.coalesce(F.col("__ids"), F.array().cast("array<bigint>")),
                     lambda n: n != F.col(by)), 1, MAX_NEIGHBOURS))
        .drop("__ids")
    )


def neighbours(cells: DataFrame, cellsize: float = 0.5, by: str = "cell") -> DataFrame:
    """Pairs (cell, neighbour): at most eight per cell, ascending.

    A neighbour lies within 1.5 cell sizes in degrees, other cells at the same
    coordinate included. There is no date-line wrap and no latitude correction.
    A column ``cellsize`` of the cells wins over the argument.
    ``by`` names the id column, for example a dense index.
    """
    return _neighbour_lists(cells, by, cellsize).select(
        F.col(by), F.explode("__near").alias("neighbour"))


def neighbourhood(cells: DataFrame, cellsize: float = 0.5, by: str = "cell") -> DataFrame:
    """(cell, lon, lat, neighbours): eight entries, padded with -9999."""
    pad = F.array_repeat(F.lit(MISSING_INT).cast("bigint"), MAX_NEIGHBOURS - F.size("__near"))
    return _neighbour_lists(cells, by, cellsize).select(
        F.col(by), "lon", "lat",
        F.concat(F.col("__near").cast("array<bigint>"), pad).alias("neighbours"))


def nearest_on_axis(targets: DataFrame, axis: DataFrame, column: str,
                    buckets: int = 256) -> DataFrame:
    """(target, nearest) for every distinct target; the larger value wins a tie.

    Targets and axis values are made distinct and sorted together inside buckets
    cut at quantiles of the distinct axis values, so an outlying value leaves the
    others spread. What lies beyond a bucket's own values comes from a summary
    with one row per bucket, so no task sorts the whole axis.
    """
    v = F.col(column).cast("double").alias("v")
    marks = axis.select(v).filter("v is not null")
    steps = [k / buckets for k in range(1, buckets)]
    none = F.array().cast("array<double>")
    cuts = marks.distinct().agg(F.coalesce(
        F.percentile_approx("v", steps, 20 * buckets), none).alias("s")).scalar()

    def placed(df: DataFrame) -> DataFrame:
        place = F.size(F.filter("s", lambda c: c < F.col("v")))
        return df.withColumn("s", cuts).withColumn("b", place).drop("s")

    distinct = (
        marks.select("v", F.lit(1).alias("mark"), F.lit(0).alias("target"))
        .unionByName(targets.select(v).filter("v is not null")
                     .select("v", F.lit(0).alias("mark"), F.lit(1).alias("target")))
        .groupBy("v").agg(F.max("mark").alias("mark"), F.max("target").alias("target"))
    )
    mark = F.when(F.col("mark") == 1, F.col("v"))
    inside = Window.partitionBy("b").orderBy("v")
    local = (
        placed(distinct)
        .withColumn("below", F.max(mark).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("above", F.min(mark).over(inside.rowsBetween(0, Window.unboundedFollowing)))
        .filter("target = 1")
    )

    # Every bucket gets a row, also those that hold targets only.
    filled = placed(marks).groupBy("b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    every = axis.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    order = Window.orderBy("b")
    edges = every.join(filled, "b", "left").select(
        "b",
        F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("prev"),
        F.min("lo").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("next"),
    )
    below, above = F.coalesce("below", "prev"), F.coalesce("above", "next")
    return local.join(F.broadcast(edges), "b").select(
        F.col("v").alias("target"),
        F.when(below.isNull(), above).when(above.isNull(), below)
        .when(above - F.col("v") <= F.col("v") - below, above).otherwise(below).alias("nearest"),
    )


def nearest_on_regular_axis(target: Column, first: Column, last: Column, spacing: float) -> Column:
    """Nearest value of a gap-free regular axis, without any join."""
    n = F.round((last - first) / spacing)
    steps = F.floor((target - first) / spacing + 0.5)
    return first + F.least(F.greatest(steps, F.lit(0)), n) * spacing


def select_nearest(raster: DataFrame, cells: DataFrame, spacing: float | None = None) -> DataFrame:
    """Raster rows at the point nearest to each cell, per axis independently.

    ``raster`` carries lon and lat plus any further columns; the result carries
    ``cell`` and those columns, with the raster point as ``rlon``, ``rlat``. A
    cell keeps its row, with NULL, where the raster has no such point.
    With ``spacing`` both raster axes are regular and free of gaps, so the point
    is computed instead of searched.
    """
    targets = cells.select("cell", F.col("lon").cast("double").alias("lon"),
                           F.col("lat").cast("double").alias("lat"))
    source = raster.withColumn("lon", F.col("lon").cast("double")).withColumn(
        "lat", F.col("lat").cast("double"))
    if spacing is not None:
        ends = raster.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in ("lon", "lat")
                            for n, f in (("lo", F.min), ("hi", F.max))])
        ends = ends.select(F.struct(*ends.columns).alias("e")).scalar()
        snapped = targets.withColumn("__e", ends)
        for c in ("lon", "lat"):
            snapped = snapped.withColumn(f"r{c}", nearest_on_regular_axis(
                F.col(c), F.col(f"__e.lo_{c}"), F.col(f"__e.hi_{c}"), spacing))
        snapped = snapped.drop("__e")
    else:
        snapped = targets
        for c in ("lon", "lat"):
            found = nearest_on_axis(targets, source, c).select(
                F.col("target").alias(c), F.col("nearest").alias(f"r{c}"))
            snapped = snapped.join(found, c, "left")
    points = source.withColumnRenamed("lon", "rlon").withColumnRenamed("lat", "rlat")
    return snapped.select("cell", "rlon", "rlat").join(points, ["rlon", "rlat"], "left")


def extract_region(cells: DataFrame, countries: DataFrame, code: str) -> DataFrame:
    """Cells of one country code, renumbered 0..n-1 in ascending cell order.

    Keeps the old id as ``cell`` and adds ``new_cell``. ``cells`` carries
    ``country_id``, ``countries`` carries ``id`` and ``code``.
    """
    wanted = countries.filter(F.col("code") == code).select(F.col("id").alias("country_id"))
    kept = cells.join(wanted, "country_id", "left_semi")
    return dense_index(kept, "cell", "new_cell")


def cell_mapping(old_cells: DataFrame, new_cells: DataFrame) -> DataFrame:
    """(cell, new_cell) by the old id that ``new_cells`` carries as ``cell``, else by coordinates.

    A coordinate that several cells of one side share maps nothing for certain,
    so it is an error there.
    """
    if "cell" in new_cells.columns:
        return old_cells.select("cell").join(new_cells.select("cell", "new_cell"), "cell")

    def single(df: DataFrame, name: str) -> DataFrame:
        several = F.raise_error(F.concat_ws(" ", F.lit("several cells at"), "lon", "lat")).cast("bigint")
        return df.groupBy("lon", "lat").agg(
            F.when(F.count(F.lit(1)) > 1, several).otherwise(F.first(name)).alias(name))

    return single(old_cells, "cell").join(single(new_cells, "new_cell"), ["lon", "lat"]).select("cell", "new_cell")


def regrid_values(values: DataFrame, mapping: DataFrame) -> DataFrame:
    """Values of the mapped cells under their new ids."""
    return (
        values.join(mapping, "cell").drop("cell").withColumnRenamed("new_cell", "cell")
        .select(*values.columns)
    )


def regrid_links(links: DataFrame, mapping: DataFrame) -> DataFrame:
    """Cell-to-cell references under new ids; a target outside the region is NULL."""
    source = mapping.select("cell", F.col("new_cell").alias("__from"))
    target = mapping.select(F.col("cell").alias("to_cell"), F.col("new_cell").alias("__to"))
    return (
        links.join(source, "cell").join(target, "to_cell", "left")
        .withColumn("cell", F.col("__from")).withColumn("to_cell", F.col("__to"))
        .select(*links.columns)
    )


def regrid_inputs(catalog: DataFrame) -> DataFrame:
    """Inputs of a catalogue that a regrid carries over.

    Only headered grid files take part, never the grid itself or the lakes
    (extracted on their own) and no placeholder. Links are marked by ``kind``.
    """
    # Names with a rule of their own, and the placeholder path.
    return (
        catalog.filter((F.col("fmt") == "clm")
                       & ~F.col("name").isin("coord", "lakes")
                       & (F.col("filename") != "DUMMYLOCATION"))
        .withColumn("kind", F.when(F.col("name").isin("drainage", "irrigation"), "links")
                    .otherwise("values"))
    )
