"""Queries over the driver's tables, one per operator."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridsteps.functions.times import decode_time
from gridsteps.model import MISSING_INT
from gridsteps.operators import bands as B
from gridsteps.operators import blocks, combine, cube, inputs, lookup, numbering, select, spatial, validate
from gridsteps.operators import reduce as R
from gridsteps.plans import views as V
from gridsteps.session import work_dir
from gridsteps.sources import convert, files, flatgrid, grid, metadata
from gridsteps.streaming import gate
from gridsteps.streaming import steps as S

KEYS = ["variable", "cell", "band", "year"]
# Spreads dense ids over the whole key range.
SPARSE = 1_000_003_000_019
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


# --- space -----------------------------------------------------------------

@query
def neighbour_pairs(spark, d):
    return spatial.neighbours(V.cells(spark, d))


@query
def neighbourhood_padded(spark, d):
    return spatial.neighbourhood(V.cells(spark, d)).withColumn(
        "neighbours", F.array_join(F.col("neighbours").cast("array<string>"), " "))


@query
def neighbour_mean(spark, d):
    """Mean of the neighbours' values per cell and year.

    Values are summed per cell and year before they meet the eight pairs.
    """
    sums = V.quantity(spark, d).groupBy(F.col("cell").alias("neighbour"), "year").agg(
        F.sum("value").alias("s"), F.count("value").alias("c"))
    return (
        spatial.neighbours(V.cells(spark, d)).join(sums, "neighbour").groupBy("cell", "year")
        .agg((F.sum("s") / F.sum("c")).alias("mean_value"), F.sum("c").alias("n"))
    )


@query
def nearest_cell(spark, d):
    return spatial.select_nearest(V.raster(spark, d), V.cells(spark, d))


@query
def nearest_with_holes(spark, d):
    """A raster without some of its points, and with one far away from all others."""
    raster = V.raster(spark, d).filter("rvalue % 7 <> 3")
    far = spark.range(1).select(F.lit(1e6).alias("lon"), F.lit(-1e6).alias("lat"), F.lit(-1).alias("rvalue"))
    return spatial.select_nearest(raster.unionByName(far), V.cells(spark, d))


@query
def neighbours_of_copies(spark, d):
    """Every fourth cell shares the place of the cell before it; the size comes with the data."""
    shifted = V.cells(spark, d).select(
        "cell", F.when(F.col("ix") % 4 == 3, F.col("lon") - 0.5).otherwise(F.col("lon")).alias("lon"), "lat",
        F.lit(0.5).alias("cellsize"))
    return spatial.neighbours(shifted, cellsize=2.0)


@query
def read_input(spark, d):
    """One year of both variables on the raster, for every cell from its nearest point."""
    squares = V.cells(spark, d).select("cell", (F.floor(F.col("ix") / 4) * 1000 + F.floor(F.col("iy") / 4)).alias("point"))
    coarse = V.grid_values(spark, d).join(squares, "cell").groupBy("variable", F.col("point").alias("cell"), "band", "year").agg(
        F.round(F.sum("value"), 2).alias("value"))
    points = V.raster(spark, d).select(F.col("rvalue").cast("bigint").alias("cell"), "lon", "lat")
    return inputs.read_input(coarse, V.variables(spark, d), V.bands(spark, d), points, V.cells(spark, d), 1996, 1996)


@query
def read_input_holes(spark, d):
    """The same where points, and values of points, are missing, and one variable has no metadata."""
    squares = V.cells(spark, d).select("cell", (F.floor(F.col("ix") / 4) * 1000 + F.floor(F.col("iy") / 4)).alias("point"))
    coarse = V.grid_values(spark, d).join(squares, "cell").filter("point % 11 <> 5").groupBy(
        "variable", F.col("point").alias("cell"), "band", "year").agg(F.round(F.sum("value"), 2).alias("value"))
    points = V.raster(spark, d).filter("rvalue % 7 <> 3").select(F.col("rvalue").cast("bigint").alias("cell"), "lon", "lat")
    known = V.variables(spark, d).filter("variable = 'quantity'")
    return inputs.read_input(coarse, known, V.bands(spark, d), points, V.cells(spark, d), 1996, 1996)


def _window_mean(own: pa.Table, around: pa.Table) -> pa.Table:
    """Mean over the cells of a 3 x 3 window that have a value, as a user would write it with numpy."""
    columns = ["ix", "iy", "s"]
    ix, iy, s = (around.column(c).to_numpy() for c in columns)
    key = ix.astype("i8") * 1_000_000 + iy
    order = np.argsort(key)
    key, s = key[order], s[order]
    x, y = (own.column(c).to_numpy().astype("i8") for c in columns[:2])
    total, n = np.zeros(len(x)), np.zeros(len(x), "i8")
    for dx in (-1, 0, 1):
        for dy in (-1, 0, 1):
            wanted = (x + dx) * 1_000_000 + y + dy
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            hit = key[at] == wanted
            total += np.where(hit, s[at], 0.0)
            n += hit
    return pa.table({"cell": own.column("cell"), "year": own.column("year"), "mean_value": total / n, "n": n})


@query
def focal_mean(spark, d):
    """Mean of the values around each cell by a user function on blocks with a border, years apart."""
    sums = V.quantity(spark, d).groupBy("cell", "year").agg(F.sum("value").alias("s"))
    rows = V.cells(spark, d).select("cell", "ix", "iy", "lon", "lat").join(sums, "cell")
    return blocks.map_blocks(rows, _window_mean, "cell bigint, year int, mean_value double, n bigint", side=8.0, halo=0.75,
                             by=["year"], max_rows=2000)


@query
def regrid_inputs(spark, d):
    """Inputs of all configurations that a regrid would carry over."""
    return spatial.regrid_inputs(metadata.catalog_inputs(_configs(spark, d, "s_name"))).select(
        F.regexp_extract("path", r"config=(\d+)", 1).cast("int").alias("config"), "name", "id", "fmt", "kind")


@query
def catalog_available(spark, d):
    return metadata.catalog_available(_configs(spark, d)).select(
        F.regexp_extract("path", r"config=(\d+)", 1).cast("int").alias("config"), "name")


@query
def catalog_coupled(spark, d):
    return metadata.catalog_outputs(_configs(spark, d), coupled=True).select(
        F.regexp_extract("path", r"config=(\d+)", 1).cast("int").alias("config"), "name", "index", "fmt")


@query
def nearest_regular(spark, d):
    return spatial.select_nearest(V.raster(spark, d), V.cells(spark, d), spacing=2.0)


def _region(spark, d):
    return spatial.extract_region(V.cells(spark, d), V.countries(spark, d), "N03")


@query
def extract_region(spark, d):
    return _region(spark, d).select("cell", "lon", "lat", "new_cell")


@query
def regrid_values(spark, d):
    mapping = spatial.cell_mapping(V.cells(spark, d), _region(spark, d))
    return spatial.regrid_values(V.grid_values(spark, d), mapping)


@query
def regrid_links(spark, d):
    mapping = spatial.cell_mapping(V.cells(spark, d), _region(spark, d))
    return spatial.regrid_links(V.links(spark, d), mapping)


# --- selection -------------------------------------------------------------

@query
def years_range(spark, d):
    return select.select_years(V.grid_values(spark, d), 1996, 1998)


@query
def years_clamped(spark, d):
    return select.clamp_years(V.grid_values(spark, d), V.variables(spark, d), 1990, 1996, 1995)


@query
def years_without_period(spark, d):
    """One of the variables has no metadata, so it keeps the years asked for."""
    known = V.variables(spark, d).filter("variable = 'quantity'")
    return select.clamp_years(V.grid_values(spark, d), known, 1990, 1996, 1995)


@query
def years_aligned(spark, d):
    quantity = select.select_years(V.quantity(spark, d), 1996, 1996)
    price = select.select_years(V.price(spark, d), 1998, 1998)
    return select.align_years(quantity.unionByName(price))


@query
def calendar(spark, d):
    values = V.grid_values(spark, d)
    years = select.observed_calendar(values, 1998)
    counts = values.groupBy("year").agg(F.count("cell").alias("n"))
    return years.join(counts, "year", "left").select(
        "year", "phase", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query
def cells_indexed(spark, d):
    return numbering.dense_index(
        V.cells(spark, d).select((F.col("cell") * SPARSE).alias("cell"), "lon", "lat"), "cell")


@query
def cells_selected(spark, d):
    """From cell 100 to the last one of the data."""
    values = V.quantity(spark, d)
    return select.select_cells(values, 100, values.agg(F.max("cell")).scalar())


@query
def bands_selected(spark, d):
    return select.select_bands(V.quantity(spark, d), [0, 3])


# --- lookups ---------------------------------------------------------------

@query
def code_to_name(spark, d):
    return lookup.code_to_name(
        V.cells(spark, d).select("cell", "country_id"), V.countries(spark, d))


@query
def code_to_iso(spark, d):
    dim = V.countries(spark, d)
    return lookup.code_to_iso(
        V.cells(spark, d).select("cell", "country_id"), dim, dim.select("name", "code"))


@query
def iso_to_name(spark, d):
    coded = V.cells(spark, d).select(
        "cell", F.concat(F.lit("N"), F.lpad(F.col("country_id").cast("string"), 2, "0")).alias("code"))
    return lookup.iso_to_name(coded, V.countries(spark, d))


@query
def name_metadata(spark, d):
    """Brands as variables; two of them hold ids that became names, one that became codes."""
    brands = V.table(spark, d, "part").groupBy(F.col("p_brand").alias("variable")).agg(
        F.min("p_type").alias("long_name"))
    return lookup.name_metadata(brands, ["Brand#11", "Brand#22"], ["Brand#33"])


@query
def fuzzy_match(spark, d):
    """Garbled part names against the list of part names."""
    part = V.table(spark, d, "part")
    names = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("pos")).withColumn(
        "code", F.concat(F.lit("C"), F.col("pos").cast("string")))
    garbled = F.concat(F.upper(F.translate("p_name", "aeiou", "eioua")), F.lit("#"),
                       F.col("p_size").cast("string"))
    return lookup.fuzzy_match(part.select(garbled.alias("q")), "q", names)


@query
def resolve_variable(spark, d):
    sums = V.table(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("index")).agg(
        F.sum("l_quantity").alias("value"))
    names = V.table(spark, d, "lineitem").select("l_linenumber").distinct().filter(
        "l_linenumber <> 7").select(
        F.col("l_linenumber").alias("index"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("name"))
    return lookup.resolve_variable(sums, names)


@query
def input_types(spark, d):
    line = F.col("l_linenumber")
    name = (F.when(line == 1, "landuse").when(line == 2, "with_tillage")
            .when(line == 3, "fertilizer_nr").when(line == 4, "sdate")
            .when(line == 5, "residue_on_field").otherwise("soil"))
    counts = V.table(spark, d, "lineitem").groupBy(line.alias("id"), name.alias("name")).agg(
        F.count(F.lit(1)).alias("n"))
    return lookup.input_type_rules(counts).join(counts.select("id", "n"), "id")


# --- bands and cube --------------------------------------------------------

@query
def labels_by_crop(spark, d):
    crops = V.crops(spark, d)
    counts = crops.agg((2 * F.count(F.lit(1))).alias("nbands")).withColumn("variable", F.lit("flags"))
    labels = B.crop_band_labels(counts, crops)
    return B.label_bands(V.flags(spark, d), labels).drop("variable")


@query
def labels_by_meta(spark, d):
    labels = B.band_labels_from_names(V.variables(spark, d))
    return B.label_bands(V.grid_values(spark, d), labels)


@query
def attach_metadata(spark, d):
    return cube.attach_metadata(V.grid_values(spark, d), V.variables(spark, d))


@query
def attach_coords(spark, d):
    cells = V.cells(spark, d)
    coords = cells.select("cell", F.lit(0).alias("band"), F.col("lon").alias("value")).unionByName(
        cells.select("cell", F.lit(1).alias("band"), F.col("lat").alias("value")))
    return cube.attach_coords(V.grid_values(spark, d), cube.grid_to_cells(coords))


def _period(values):
    """First and last year of the values, as scalar subqueries."""
    return tuple(values.agg(f("year")).scalar() for f in (F.min, F.max))


@query
def densify(spark, d):
    values = V.grid_values(spark, d)
    return cube.densify(values, V.cells(spark, d), V.bands(spark, d),
                        ["quantity", "price"], _period(values))


@query
def missing_roundtrip(spark, d):
    value = F.col("value")
    coded = V.grid_values(spark, d).withColumn(
        "value", F.when((F.col("variable") == "quantity") & (value % 7 == 0), F.lit(-9999.0))
        .when((F.col("variable") == "price") & (F.col("cell") % 5 == 0), F.lit(float("nan")))
        .otherwise(value))
    meta = V.variables(spark, d)
    plain = cube.decode_missing_values(coded, meta)
    again = cube.encode_missing_values(plain.withColumn("plain", value), meta)
    return again.select(
        *KEYS, F.col("plain").alias("value"), (value == -9999.0).alias("is_sentinel"),
        F.isnan(value).alias("is_nan"))


@query
def apply_scalar(spark, d):
    return cube.apply_scalar(V.grid_values(spark, d), V.variables(spark, d)).select(*KEYS, "value")


@query
def cast_types(spark, d):
    quarter = V.grid_values(spark, d).withColumn("value", F.col("value") / 4)
    return cube.cast_types(quarter, V.variables(spark, d)).select(*KEYS, "value")


def _daily(spark, d):
    return V.table(spark, d, "events").groupBy(
        F.lit("daily").alias("variable"), F.col("user_id").alias("cell"), F.lit(0).alias("band"),
        F.year("ts").alias("year"), F.day("ts").alias("step")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))


@query
def steps_as_bands(spark, d):
    return B.steps_to_bands(_daily(spark, d)).select(*KEYS, "value")


@query
def select_variable(spark, d):
    return B.select_variable(V.grid_values(spark, d), "quantity", V.bands(spark, d))


@query
def to_wide(spark, d):
    return cube.to_wide(V.grid_values(spark, d), ["quantity", "price"])


@query
def to_long(spark, d):
    return cube.to_long(to_wide(spark, d), ["quantity", "price"])


@query
def describe_dataset(spark, d):
    return cube.describe_dataset(V.grid_values(spark, d))


# --- combination -----------------------------------------------------------

@query
def assemble(spark, d):
    return combine.assemble_wide({"quantity": V.quantity(spark, d), "price": V.price(spark, d)})


@query
def append_years(spark, d):
    """Later years are appended to a stored table, twice, with the same result."""
    path = work_dir(spark, "append")
    values = V.quantity(spark, d)
    combine.write_years(values.filter("year < 1998"), path)
    for _ in range(2):
        combine.write_years(values.filter("year >= 1998"), path)
    return grid.load_values(spark, path)


@query
def overlay(spark, d):
    base = V.quantity(spark, d)
    new = base.filter("year = 1998 AND cell % 3 = 0").withColumn(
        "value", F.when(F.col("band") != 6, F.col("value") * 2))
    outside = new.withColumn("year", F.lit(2050))
    return combine.overlay(base, new.unionByName(outside))


@query
def compare_runs(spark, d):
    a = V.grid_values(spark, d)
    b = a.filter("NOT (variable = 'price' AND year = 1997)").withColumn(
        "value", F.when((F.col("variable") == "quantity") & (F.col("cell") % 100 == 0),
                        F.col("value") + 1).otherwise(F.col("value")))
    return combine.compare_runs(a, b)


def _two_versions(spark, d):
    a = V.quantity(spark, d).filter("cell % 3 <> 0")
    b = V.grid_values(spark, d).withColumn("value", F.when(
        (F.col("variable") == "quantity") & (F.col("cell") % 5 == 0), F.col("value") + 1).otherwise(F.col("value")))
    return combine.merge_datasets([a, b])


@query
def merge_datasets(spark, d):
    return _two_versions(spark, d)[0]


@query
def merge_conflicts(spark, d):
    return _two_versions(spark, d)[1]


@query
def undefined_vars(spark, d):
    part = V.table(spark, d, "part").select(F.col("p_name").alias("name"), "p_size")
    return combine.undefined_variables(part, part.filter("p_size = 50"))


# --- validation ------------------------------------------------------------

def _registry(spark, d):
    return V.variables(spark, d).select("variable", "datatype", F.col("nbands").alias("nband"))


@query
def validate_shape(spark, d):
    ncell = V.cells(spark, d).agg(F.count(F.lit(1))).scalar()
    return validate.check_counts(V.grid_values(spark, d), _registry(spark, d), ncell)


@query
def validate_missing(spark, d):
    values = V.grid_values(spark, d)
    return validate.check_missing(values, V.cells(spark, d), V.bands(spark, d),
                                  ["quantity", "price"], _period(values))


@query
def validate_type(spark, d):
    halves = V.grid_values(spark, d).withColumn("value", F.col("value") / 2)
    return validate.check_types(halves, _registry(spark, d))


@query
def validate_unknown(spark, d):
    known = _registry(spark, d).filter("variable = 'quantity'")
    return validate.check_unknown(V.grid_values(spark, d), known)


@query
def validate_index(spark, d):
    """Line numbers as output indices; two of them are not supported, one is twice."""
    asked = V.table(spark, d, "lineitem").select(F.col("l_linenumber").alias("index"))
    known = asked.distinct().filter("index <= 5").withColumn("name", F.explode(F.when(
        F.col("index") == 3, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))))
    return validate.check_index(asked, known)


@query
def validate_coupled(spark, d):
    """Coupled inputs of all configurations against a registry that lacks some and has others under another id."""
    coupled = metadata.catalog_inputs(_configs(spark, d), coupled=True)
    registry = V.table(spark, d, "supplier").filter("s_suppkey % 5 <> 0").select(
        (F.col("s_suppkey") + F.when(F.col("s_suppkey") % 7 == 0, 1).otherwise(0)).cast("int").alias("id"),
        F.col("s_name").alias("name"))
    return validate.check_coupled(coupled, registry)


@query
def validate_periods(spark, d):
    known = V.variables(spark, d).filter("variable = 'quantity'")
    return validate.check_periods(V.grid_values(spark, d), known.unionByName(known))


@query
def validate_streams(spark, d):
    """Suppliers as inputs and customers as outputs, one of each too few in the configuration."""
    inputs, outputs = V.table(spark, d, "supplier"), V.table(spark, d, "customer")
    ncell = V.cells(spark, d).agg(F.count(F.lit(1))).scalar()
    less = lambda df: df.agg(F.count(F.lit(1)) - 1).scalar()
    config = {"ncell": ncell, "ninput": less(inputs), "noutput": less(outputs)}
    return validate.check_streams(inputs, outputs, ncell, config)


@query
def validate_year(spark, d):
    return validate.check_year(V.grid_values(spark, d), 1996)


@query
def validate_metadata(spark, d):
    """Brands as variables; the cells of every third one are not square."""
    number = F.substring("p_brand", 7, 10).cast("int")
    brands = V.table(spark, d, "part").select(
        F.col("p_brand").alias("variable"), F.lit(0.5).alias("cellsize_lon"),
        F.when(number % 3 == 0, 0.25).when(number % 3 == 1, 0.5).alias("cellsize_lat")).distinct()
    return validate.check_metadata(brands)


@query
def validate_subannual(spark, d):
    """Days of events as steps, with the event types as bands of some years."""
    rows = V.table(spark, d, "events").select(
        F.lit("daily").alias("variable"), F.year("ts").alias("year"), F.day("ts").alias("step"),
        V.event_band().cast("int").alias("band"))
    return validate.check_subannual(rows)


@query
def validate_duplicates(spark, d):
    lines = V.table(spark, d, "lineitem").select(
        F.lit("line").alias("variable"), F.col("l_partkey").alias("cell"),
        (F.col("l_linenumber") - 1).alias("band"), F.year("l_shipdate").alias("year"))
    return validate.check_duplicates(lines)


# --- steps -----------------------------------------------------------------

@query
def operations_left(spark, d):
    years = V.grid_values(spark, d).select("year").distinct()
    done = years.filter("year < 1999").select("year", F.lit(S.SEND).alias("operation")).unionByName(
        years.filter("year < 1998").select("year", F.lit(S.READ).alias("operation")))
    return S.operations_left(years, done, 1998, 1996)


@query
def ledger_violations(spark, d):
    """Users as runs; their clicks send inputs and their purchases read outputs, days are the years."""
    events = V.table(spark, d, "events")
    log = events.filter("event_type IN ('click', 'purchase')").select(
        F.col("user_id").alias("run"), F.col("event_id").cast("bigint").alias("seq"), F.day("ts").alias("year"),
        F.when(F.col("event_type") == "click", S.SEND).otherwise(S.READ).alias("operation"))
    return S.ledger_violations(log, events.select(F.day("ts").alias("year")), 10, 5)


@query
def history(spark, d):
    return S.read_history(V.grid_values(spark, d), 1996, 1999)


def _event_stream(spark, d):
    """The events table as a file stream; the pattern fits a file and a folder."""
    schema = V.table(spark, d, "events").schema
    return spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")


@query
def stream_steps(spark, d):
    root = work_dir(spark, "stream")
    store = S.StepStore(root)
    rows = V.event_rows(_event_stream(spark, d))
    S.stream_steps(rows, store, f"{root}/checkpoint").awaitTermination()
    return store.arrivals(spark).groupBy("cell", "band", "year").agg(
        F.round(F.sum("value"), 2).alias("value"), F.count(F.lit(1)).alias("n"))


@query
def late_rows(spark, d):
    root = work_dir(spark, "late")
    store = S.StepStore(root)
    store.record(spark, -1, 10, [(10, S.READ)])
    rows = V.event_rows(_event_stream(spark, d)).withColumn(
        "year", F.when(F.col("step") % 97 != 0, F.col("year")))
    S.stream_steps(rows, store, f"{root}/checkpoint", first_year=1).awaitTermination()
    return store.quarantine(spark).drop("variable")


@query
def complete_steps(spark, d):
    rows = V.event_rows(V.table(spark, d, "events"))
    expected = rows.groupBy("variable", "year").agg(F.count(F.lit(1)).alias("n"))
    arrived = rows.filter("NOT (year % 4 = 0 AND band = 2) AND year % 10 <> 0")
    return S.complete_steps(arrived, expected)


@query
def gate_steps(spark, d):
    """Days of which every event has come, released by state of the stream."""
    gate.use_state(spark)
    root = work_dir(spark, "gate")
    rows = V.event_rows(V.table(spark, d, "events"))
    expected = rows.groupBy("variable", "year").agg(F.count(F.lit(1)).alias("n"))
    arrived = V.event_rows(_event_stream(spark, d)).filter("NOT (year % 4 = 0 AND band = 2) AND year % 10 <> 0")
    released = gate.release_years(arrived.select("variable", "cell", "band", "year", "step"), expected)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/released/batch_id={batch_id}")

    released.writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(gate.RELEASED).parquet(f"{root}/released").select("year", "keys", "missing")


@query
def stream_coords(spark, d):
    """Coordinates of the cells, read once, joined to a stream of events."""
    root = work_dir(spark, "coords")
    cells = S.StepStore(root).static(spark, "cells", V.cells(spark, d).select("cell", "lon", "lat"))
    rows = cube.attach_coords(V.event_rows(_event_stream(spark, d)), cells)
    rows.select("cell", "band", "step", "lon", "lat").writeStream.format("parquet").option("path", f"{root}/rows").option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("cell bigint, band int, step bigint, lon double, lat double").parquet(f"{root}/rows")


@query
def flat_arrivals(spark, d):
    """Years written as flat files, one write after the other, feed the exchange; present values become demand."""
    folder, root = work_dir(spark, "flat-arrivals"), work_dir(spark, "flat-run")
    values = V.quantity(spark, d)
    layout = _layout(spark, d)
    for k in range(3):
        flatgrid.write_flat_grid(values.filter(F.col("year") % 3 == k), folder, **layout)
    years = values.agg(F.min("year"), F.max("year")).first()
    store = S.StepStore(root)
    expected = spark.range(1).select(F.lit("quantity").alias("variable"), F.lit(layout["ncell"] * layout["nbands"]).alias("n"))
    rows = flatgrid.stream_flat_grid(spark, folder).select(
        *KEYS, F.lit(0).cast("bigint").alias("step"), F.when(F.col("raw") != MISSING_INT, F.col("value")).alias("value"))

    def demand(outputs: DataFrame, year: int) -> DataFrame:
        return outputs.groupBy("cell").agg(F.count("value").cast("double").alias("value")).select(
            F.lit("demand").alias("variable"), "cell", F.lit(0).alias("band"), F.lit(year + 1).alias("year"), "value")

    S.run_steps(rows, demand, store, expected, f"{root}/checkpoint", *years).awaitTermination()
    return store.inputs(spark)


@query
def run_steps(spark, d):
    """Weeks of events in order; each week's counts become the next week's demand."""
    root = work_dir(spark, "run")
    store = S.StepStore(root)
    batch = V.event_rows(V.table(spark, d, "events"), days=7)
    expected = batch.groupBy("variable", "year").agg(F.count(F.lit(1)).alias("n"))
    last = expected.agg(F.max("year")).first()[0]
    registry = spark.range(1).select(
        F.lit("demand").alias("variable"), F.lit("int").alias("datatype"), F.lit(1).alias("nband"))

    def demand(outputs: DataFrame, year: int) -> DataFrame:
        return outputs.groupBy("cell").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("demand").alias("variable"), "cell", F.lit(0).alias("band"),
            F.lit(year + 1).alias("year"), "value")

    S.run_steps(V.event_rows(_event_stream(spark, d), days=7), demand, store, expected,
                f"{root}/checkpoint", 1, last, registry).awaitTermination()
    return store.inputs(spark)


@query
def decode_time_axis(spark, d):
    orders = V.table(spark, d, "orders")
    status = F.col("o_orderstatus")
    base = F.lit("1990-01-15").cast("date")
    offset = (F.when(status == "O", F.datediff(F.to_date("o_orderdate"), base))
              .when(status == "F", F.col("o_orderkey") % 300).otherwise(F.col("o_orderkey") % 40))
    unit = F.when(status == "O", "days").when(status == "F", "months").otherwise("years")
    units = F.concat(unit, F.lit(" since 1990-01-15"))
    return orders.select(
        "o_orderkey", decode_time(offset, units).alias("year"),
        decode_time(offset, units, F.col("o_orderkey") % 300, "month_index").alias("month_index_year"))


# --- reductions ------------------------------------------------------------

@query
def area_weighted_mean(spark, d):
    return R.weighted_mean(V.quantity(spark, d), V.cells(spark, d), ["variable", "year", "band"])


@query
def reduce_mean(spark, d):
    return R.reduce_dims(V.quantity(spark, d), ["band"])


@query
def group_mean_by_country(spark, d):
    named = V.cells(spark, d).select("cell", F.col("country_id").alias("id")).join(
        V.countries(spark, d), "id").select("cell", F.col("name").alias("country"))
    return R.reduce_by_label(V.quantity(spark, d), named, ["cell"], "country")


@query
def resample_years(spark, d):
    return R.resample_years(_daily(spark, d))


@query
def rolling_mean(spark, d):
    return R.rolling(V.quantity(spark, d), 3)


@query
def year_diff(spark, d):
    return R.diff(V.quantity(spark, d))


@query
def shift(spark, d):
    return R.shift(V.quantity(spark, d))


@query
def cumsum(spark, d):
    return R.cumsum(V.quantity(spark, d))


def _gapped(spark, d):
    return R.where(V.quantity(spark, d), F.col("value") % 3 != 0)


@query
def ffill(spark, d):
    return R.ffill(_gapped(spark, d))


@query
def fillna(spark, d):
    return R.fillna(_gapped(spark, d), -1.0)


@query
def arithmetic(spark, d):
    return R.arithmetic(V.price(spark, d), V.quantity(spark, d), lambda a, b: a - b)


@query
def quantile(spark, d):
    return R.quantile(V.quantity(spark, d), 0.9, ["variable", "year"]).withColumn(
        "value", F.round("value", 6))


# --- files -----------------------------------------------------------------

def _write_files(df: DataFrame, folder: str) -> None:
    """One small file per row (name, content), written by the tasks."""
    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = files.open_path(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write(bytes(content))
            yield batch[["name"]]

    df.mapInPandas(put, "name string").write.format("noop").mode("overwrite").save()


def _supplied(spark, d):
    counts = V.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("c"))
    return V.table(spark, d, "supplier").select("s_suppkey").join(counts, "s_suppkey")


def _header(key: int, count: int) -> bytes:
    version, mark = key % 4 + 1, ">" if key % 3 == 0 else "<"
    data = struct.pack(mark + "7i", version, 1, 1901 + key % 50, 10, key, count, 1)
    if version >= 2:
        data += struct.pack(mark + "2f", 0.25, 1.0)
    if version >= 3:
        data += struct.pack(mark + "f", 0.25) + struct.pack(mark + "i", 3)
    if version == 4:
        data += struct.pack(mark + "2i", 1, 1)
    return b"LPJTEST" + data


@query
def inventory_files(spark, d):
    """One file per supplier, its kind by key, then told apart by first bytes."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = [_header(0, 1), b"\x89HDF\r\n\x1a\n", b' {"a":', b"id,", b"\x07\xfe"]
        for b in batches:
            yield pd.DataFrame({
                "name": [f"s{k}" for k in b["s_suppkey"]],
                "content": [starts[k % 5] + str(c).encode() for k, c in zip(b["s_suppkey"], b["c"])]})

    folder = work_dir(spark, "inventory")
    _write_files(_supplied(spark, d).mapInPandas(build, "name string, content binary"), folder)
    return files.inventory_files(spark, folder).select(
        F.regexp_extract("path", r"s(\d+)$", 1).cast("int").alias("id"), "io_type", "length")


@query
def header_catalog(spark, d):
    """One headered file per supplier, all versions and both byte orders."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({
                "name": [f"s{k}.clm" for k in b["s_suppkey"]],
                "content": [_header(k, c) for k, c in zip(b["s_suppkey"], b["c"])]})

    folder = work_dir(spark, "headers")
    _write_files(_supplied(spark, d).mapInPandas(build, "name string, content binary"), folder)
    return files.header_catalog(spark, folder).select(
        "firstcell", "version", "endian", "ncell", "lastyear", "datatype", "cellsize_lat",
        "header_bytes")


def _layout(spark, d) -> dict:
    """Flat layout of the quantities: all cells and bands."""
    span = V.cells(spark, d).agg(F.min("cell"), F.max("cell")).first()
    nbands = V.bands(spark, d).filter("variable = 'quantity'").agg(F.max("band") + 1).first()[0]
    return dict(ncell=span[1] - span[0] + 1, nbands=nbands, firstcell=span[0], datatype="int")


@query
def scan_flat_grid(spark, d):
    """Dense cube written as flat blocks and read back; gaps hold the sentinel."""
    folder = work_dir(spark, "flat")
    flatgrid.write_flat_grid(V.quantity(spark, d), folder, **_layout(spark, d))
    return flatgrid.read_flat_grid(spark, folder).select(*KEYS, "value")


@query
def flat_grid_part(spark, d):
    """Some years, bands and cells of a flat cube; the rest is not opened or read."""
    folder = work_dir(spark, "flat-part")
    flatgrid.write_flat_grid(V.quantity(spark, d), folder, blockelements=5000, **_layout(spark, d))
    return flatgrid.read_flat_grid(spark, folder).filter(
        "variable = 'quantity' AND year BETWEEN 1995 AND 1996 AND band IN (1, 4) AND cell > 150").select(*KEYS, "value")


@query
def convert_raw(spark, d):
    """Both variables to flat blocks and sidecars; later years again, changed, in blocks of another size."""
    folder = work_dir(spark, "raw")
    values = V.grid_values(spark, d)
    span = V.cells(spark, d).agg(F.min("cell").cast("int").alias("firstcell"), F.expr("cast(max(cell) - min(cell) + 1 as int)").alias("ncell"))
    sidecars = V.variables(spark, d).drop("scalar").join(span)
    catalog = sidecars.select(F.col("variable").alias("name"), F.lit("cdf").alias("fmt")).unionByName(
        spark.range(1).select(F.lit("grid").alias("name"), F.lit("cdf").alias("fmt")))
    convert.convert_raw(values, catalog, sidecars, folder, blockelements=5000)
    later = values.filter("year >= 1998").withColumn("value", F.col("value") + 1)
    convert.convert_raw(later, catalog, sidecars, folder, ids="quantity", blockelements=777)
    units = flatgrid.read_sidecars(spark, folder).select("variable", "unit", "format")
    return flatgrid.read_flat_grid(spark, folder).filter("NOT isnan(raw) AND raw <> -9999").select(*KEYS, "value").join(units, "variable")


def _brand_metadata(spark, d):
    return V.table(spark, d, "part").groupBy(F.col("p_brand").alias("variable")).agg(
        F.array_sort(F.collect_set("p_type")).alias("types"),
        F.count(F.lit(1)).cast("int").alias("ncell"))


@query
def metadata_catalog(spark, d):
    """One sidecar file per brand; every second one leaves out its band names."""
    folder = work_dir(spark, "sidecars")
    number = F.substring("variable", 7, 10).cast("int")
    sidecars = _brand_metadata(spark, d).select(
        "variable", F.size("types").alias("nbands"), "ncell",
        F.when(number % 2 != 0, F.col("types")).alias("band_names"), F.lit(1).alias("_private"))
    name = F.concat(F.regexp_replace("variable", r"\W", "_"), F.lit(".json"))
    _write_files(metadata.as_json(sidecars).select(
        name.alias("name"), F.col("json").cast("binary").alias("content")), folder)
    return metadata.load_metadata(spark, folder).select(
        "variable", "nbands", F.array_join("band_names", " ").alias("band_names"), "ncell")


@query
def nested_metadata(spark, d):
    """Private keys inside structs, arrays and maps are not written."""
    sizes = V.table(spark, d, "part").groupBy(F.col("p_brand").alias("variable")).agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("p_size")).alias("sizes"))
    tree = sizes.select(
        "variable", F.lit("x").alias("_hidden"),
        F.struct(F.col("n").alias("count"), F.lit(7).alias("_id"), F.transform("sizes", lambda x: F.struct(
            x.alias("size"), (x * 2).alias("_twice"))).alias("parts")).alias("settings"),
        F.create_map(F.lit("a"), F.struct(F.col("n").alias("v"), F.lit(1).alias("_w")),
                     F.lit("_b"), F.struct(F.lit(0).cast("bigint").alias("v"), F.lit(2).alias("_w"))).alias("named"))
    return metadata.as_json(tree)


@query
def merge_metadata(spark, d):
    brands = _brand_metadata(spark, d)
    number = F.substring("variable", 7, 10).cast("int")
    area = F.struct(F.lit("area.nc4.json").alias("filename"), F.lit("meta").alias("format"))
    target = brands.select(
        "variable", F.when(number % 3 != 0, "from target").alias("unit"),
        F.array(F.lit("old")).alias("band_names"), area.alias("ref_area"))
    source = brands.select(
        "variable", F.lit("from source").alias("unit"), F.col("types").alias("band_names"),
        "ncell", area.alias("ref_area"))
    return metadata.merge_metadata(target, source).select(
        "variable", "ncell", "unit", F.array_join("band_names", " ").alias("band_names"),
        F.col("ref_area.filename").alias("area_file"))


def _configs(spark, d, place="'DUMMYLOCATION'"):
    """Suppliers as run configurations, fifty to a file; ``place`` names the input files."""
    folder = work_dir(spark, "configs")
    key = F.col("s_suppkey").cast("int")
    odd = key % 2 != 0
    rows = V.table(spark, d, "supplier").groupBy(F.expr("s_suppkey div 50").alias("config")).agg(
        F.collect_list(F.struct(key.alias("id"), F.col("s_name").alias("name"))).alias("outputvar"),
        F.collect_list(F.struct(F.col("s_name").alias("id"), F.struct(
            F.when(odd, "raw").otherwise("cdf").alias("fmt"),
            F.when(key % 3 == 0, F.lit(True)).alias("socket")).alias("file"))).alias("output"),
        F.map_from_entries(F.collect_list(F.struct(F.col("s_name"), F.struct(
            key.alias("id"), F.expr(place).alias("name"),
            F.when(odd, "raw").otherwise("clm").alias("fmt"),
            F.when(key % 3 == 0, F.lit(True)).alias("socket"))))).alias("input"))
    rows.write.partitionBy("config").json(folder)
    return metadata.read_config(spark, folder).withColumn(
        "config", F.regexp_extract("path", r"config=(\d+)", 1).cast("int"))


@query
def catalog_outputs(spark, d):
    configs = _configs(spark, d)
    return metadata.catalog_outputs(configs, fmt="cdf").select(
        F.regexp_extract("path", r"config=(\d+)", 1).cast("int").alias("config"),
        "name", "index", "fmt", "socket")


@query
def catalog_inputs(spark, d):
    configs = _configs(spark, d)
    return metadata.catalog_inputs(configs, coupled=True).select(
        F.regexp_extract("path", r"config=(\d+)", 1).cast("int").alias("config"),
        "name", "id", "fmt")


@query
def convert_format(spark, d):
    """Values landed as csv, converted to parquet by a catalogue, and read back."""
    values = V.grid_values(spark, d)
    landed, path = work_dir(spark, "landed"), work_dir(spark, "converted")
    values.write.option("header", True).csv(landed)
    stored = spark.read.option("header", True).schema(values.schema).csv(landed)
    catalog = values.select(F.col("variable").alias("name")).distinct().withColumn(
        "fmt", F.when(F.col("name") == "quantity", "cdf").otherwise("raw"))
    convert.convert_format(stored, path, variables=convert.convertible(catalog))
    return grid.load_values(spark, path)


@query
def load_grid(spark, d):
    """A landed table with one extra dimension; its values become bands 0..n-1."""
    lines = V.table(spark, d, "lineitem").groupBy(
        F.col("l_partkey").alias("cell"), F.col("l_linenumber").alias("line"),
        F.year("l_shipdate").alias("time")).agg(F.sum("l_quantity").alias("quantity"))
    return grid.shape_grid(lines, ["quantity"], cell="cell")
