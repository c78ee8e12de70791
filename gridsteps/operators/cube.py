"""Cube structure: metadata, coordinates, dense templates, missing values, shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridsteps.functions.missing import cast_by_datatype, decode_missing, encode_missing
from gridsteps.model import KEYS, STATIC_VARIABLES, require_columns, single_rows


def attach_metadata(values: DataFrame, variables: DataFrame, strict: bool = True) -> DataFrame:
    """Join descriptive metadata by variable; two rows of one variable are an error.

    Square cells are required: a row whose two cell sizes differ raises when
    ``strict``, otherwise its cellsize is NULL.
    """
    unequal = ~F.col("cellsize_lat").eqNullSafe(F.col("cellsize_lon"))
    fail = F.raise_error(F.concat(
        F.lit("cell sizes of longitude and latitude differ: "), F.col("variable"))).cast("double")
    cellsize = F.when(unequal, fail if strict else F.lit(None)).otherwise(F.col("cellsize_lon"))
    picked = [
        F.col("variable"),
        F.col("variable").alias("standard_name"),
        "long_name",
        F.col("unit").alias("units"),
        "source",
        "history",
        cellsize.alias("cellsize"),
    ]
    if "global_attrs" in variables.columns:
        picked += [F.col(f"global_attrs.{a}").alias(a) for a in ("institution", "contact", "comment")]
    return values.join(single_rows(variables.select(*picked), "variable"), "variable", "left")


def grid_to_cells(grid: DataFrame) -> DataFrame:
    """Grid variable (band 0 longitude, band 1 latitude) to a cell table."""
    return grid.groupBy("cell").agg(
        F.max(F.when(F.col("band") == 0, F.col("value"))).alias("lon"),
        F.max(F.when(F.col("band") == 1, F.col("value"))).alias("lat"),
    )


def attach_coords(values: DataFrame, cells: DataFrame) -> DataFrame:
    """Longitude and latitude of each cell; works on streams as well. A cell listed twice is an error."""
    return values.join(single_rows(cells.select("cell", "lon", "lat"), "cell"), "cell", "left")


def template(cells: DataFrame, bands: DataFrame, variables: Sequence[str],
             years: tuple[int, int] | None) -> DataFrame:
    """Every key of the dense cube: cells x bands of each variable x years.

    Cells are expanded in place by the variable list, then meet the band axis
    by an equi-join on the variable, then expand by the years. No cell row is
    shuffled while the band table stays within the broadcast bound.
    """
    names = F.array(*[F.lit(v) for v in variables])
    axis = bands.select("variable", F.col("band").cast("int").alias("band"))
    keys = (
        cells.select(F.col("cell").cast("bigint").alias("cell"))
        .withColumn("variable", F.explode(names)).join(axis, "variable")
    )
    if years is None:
        return keys.select("variable", "cell", "band")
    first, last = years
    return keys.select(
        "variable", "cell", "band",
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))


def on_template(values: DataFrame, cells: DataFrame, bands: DataFrame, variables: Sequence[str],
                years: tuple[int, int] | None) -> DataFrame:
    """Template keys with ``value`` and ``present``: does the table hold the key.

    Cells and values are both partitioned by cell before the cells expand, so
    the dense rows, which outnumber both, are merged where they arise and never
    shuffled.
    """
    keys = KEYS if years is not None else KEYS[:3]
    wanted = template(cells.select("cell").repartition("cell"), bands, variables, years).select(
        *keys, F.lit(None).cast("double").alias("value"), F.lit(True).alias("wanted"))
    given = (
        values.filter(F.col("variable").isin(*variables))
        .select("variable", F.col("cell").cast("bigint").alias("cell"), *keys[2:],
                F.col("value").cast("double").alias("value"))
        .repartition("cell").withColumn("wanted", F.lit(False))
    )
    return (
        wanted.unionByName(given).groupBy(*keys)
        .agg(_one_value(F.col("value"), keys).alias("value"), F.bool_or("wanted").alias("wanted"),
             (~F.bool_and("wanted")).alias("present"))
        .filter("wanted").drop("wanted")
    )


def _one_value(value: Column, keys: Sequence[str]) -> Column:
    """The value of a key; rows of one key that differ are an error."""
    clash = F.raise_error(F.concat_ws(" ", F.lit("different values of one key:"), *(F.col(k).cast("string") for k in keys)))
    return F.when(F.min(value) < F.max(value), clash.cast("double")).otherwise(F.max(value))


def densify(values: DataFrame, cells: DataFrame, bands: DataFrame, variables: Sequence[str],
            years: tuple[int, int] | None) -> DataFrame:
    """Dense template with the values written in; NULL where there is none.

    Rows of one key with different values are an error. ``years=None`` gives the
    template of static variables, without time axis.
    """
    return on_template(values, cells, bands, variables, years).drop("present")


def _with_datatype(values: DataFrame, variables: DataFrame) -> DataFrame:
    dim = single_rows(variables.select("variable", F.col("datatype").alias("__datatype")), "variable")
    return values.join(dim, "variable", "left")


def decode_missing_values(values: DataFrame, variables: DataFrame) -> DataFrame:
    """Sentinels to NULL by the declared type of the variable."""
    return (
        _with_datatype(values, variables)
        .withColumn("value", decode_missing(F.col("value"), F.col("__datatype")))
        .drop("__datatype")
    )


def encode_missing_values(values: DataFrame, variables: DataFrame) -> DataFrame:
    """NULL to sentinels by the declared type of the variable."""
    return (
        _with_datatype(values, variables)
        .withColumn("value", encode_missing(F.col("value"), F.col("__datatype")))
        .drop("__datatype")
    )


def cast_types(values: DataFrame, variables: DataFrame) -> DataFrame:
    """Values as their declared type would hold them."""
    return (
        _with_datatype(values, variables)
        .withColumn("value", cast_by_datatype(F.col("value"), F.col("__datatype")))
        .drop("__datatype")
    )


def apply_scalar(values: DataFrame, variables: DataFrame, only_static: bool = False) -> DataFrame:
    """Multiply by the metadata scalar, for all or only the static variables."""
    scale = F.coalesce(F.col("__scalar"), F.lit(1.0))
    if only_static:
        scale = F.when(F.col("variable").isin(*STATIC_VARIABLES), scale).otherwise(F.lit(1.0))
    return (
        values.join(single_rows(variables.select("variable", F.col("scalar").alias("__scalar")), "variable"),
                    "variable", "left")
        .withColumn("value", F.col("value") * scale)
        .drop("__scalar")
    )


def to_wide(values: DataFrame, variables: Sequence[str],
            keys: Sequence[str] = ("cell", "band", "year")) -> DataFrame:
    """One column per variable; the names are given, so no extra pass finds them.

    Rows of one key with different values are an error; ``combine.merge_datasets``
    merges such tables and reports what clashes.
    """
    picks = [_one_value(F.when(F.col("variable") == v, F.col("value")), keys).alias(v) for v in variables]
    return (
        values.filter(F.col("variable").isin(*variables)).groupBy(*keys).agg(*picks)
    )


def to_long(wide: DataFrame, variables: Sequence[str],
            keys: Sequence[str] = ("cell", "band", "year"), keep_null: bool = False) -> DataFrame:
    """Inverse of :func:`to_wide`."""
    require_columns(wide, list(keys) + list(variables))
    long = wide.unpivot(list(keys), list(variables), "variable", "value")
    return long if keep_null else long.filter(F.col("value").isNotNull())


def split_variables(values: DataFrame, variables: Sequence[str]) -> dict[str, DataFrame]:
    """Lazy view of each variable."""
    return {v: values.filter(F.col("variable") == v) for v in variables}


def describe_dataset(values: DataFrame) -> DataFrame:
    """Shape and time bounds of each variable.

    Distinct cells and bands are counted in two steps, so that a variable that
    holds most rows is reduced by many tasks: first per (variable, cell) and
    (variable, band), then per variable.
    """
    per_cell = values.groupBy("variable", "cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("year").alias("lo"), F.max("year").alias("hi"))
    cells = per_cell.groupBy("variable").agg(
        F.count(F.lit(1)).alias("ncell"), F.sum("n").alias("nvalue"),
        F.min("lo").alias("firstyear"), F.max("hi").alias("lastyear"))
    bands = (
        values.select("variable", "band").distinct()
        .groupBy("variable").agg(F.count(F.lit(1)).alias("nband"))
    )
    return cells.join(bands, "variable").select(
        "variable", "ncell", "nband", "nvalue", "firstyear", "lastyear")
