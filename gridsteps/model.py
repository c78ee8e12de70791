"""Schemas of the long tables and the canonical column order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

KEYS = ["variable", "cell", "band", "year"]

VALUES = T.StructType([
    T.StructField("variable", T.StringType()),
    T.StructField("cell", T.LongType()),
    T.StructField("band", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("step", T.LongType()),
    T.StructField("value", T.DoubleType()),
])

# Fields of a file reference in the sidecars.
FILE_REF = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("format", T.StringType()),
])

# The fields of one metadata sidecar. ``band_names`` is read as strings because files hold
# either labels or numbers there; ``datatype`` likewise holds a word or a code.
METADATA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "sim_name", "source", "history", "variable", "name", "standard_name", "long_name", "unit")]
    + [T.StructField(n, T.IntegerType()) for n in (
        "firstcell", "ncell", "nstep", "timestep", "nbands", "firstyear", "lastyear", "nyear")]
    + [T.StructField(n, T.DoubleType()) for n in ("cellsize_lon", "cellsize_lat", "scalar")]
    + [
        T.StructField("band_names", T.ArrayType(T.StringType())),
        T.StructField("datatype", T.StringType()),
        T.StructField("order", T.StringType()),
        T.StructField("bigendian", T.BooleanType()),
        T.StructField("format", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("grid", FILE_REF),
        T.StructField("ref_area", FILE_REF),
        T.StructField("global_attrs", T.StructType([
            T.StructField(n, T.StringType()) for n in ("institution", "contact", "comment")])),
    ]
)

# Variables that carry no time axis.
STATIC_VARIABLES = ["grid", "country", "region", "terr_area", "lake_area"]

# Value-type codes, words, and the Spark type of each.
VALUE_TYPES = [
    (0, "byte", "tinyint"),
    (1, "short", "smallint"),
    (2, "int", "int"),
    (3, "float", "float"),
    (4, "double", "double"),
]
INTEGER_TYPES = ["byte", "short", "int"]

# Fixed value: sentinel that stands for a missing integer.
MISSING_INT = -9999


def canonical(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Rename columns, add the axes that are absent, and order the columns.

    Key axes come first in the order variable, cell, band, year, step, then the
    value, then whatever else the table carries.
    """
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    if "band" not in df.columns:
        df = df.withColumn("band", F.lit(0))
    axes = [c for c in ("variable", "cell", "band", "year", "step") if c in df.columns]
    casts = {f.name: f.dataType for f in VALUES.fields}
    head = [F.col(c).cast(casts[c]).alias(c) for c in axes]
    if "value" in df.columns:
        head.append(F.col("value").cast("double").alias("value"))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in axes and c != "value"]
    return df.select(*head, *rest)


def single_rows(dim: DataFrame, *keys: str) -> DataFrame:
    """The rows of a dimension table; a key that several rows have is an error, a NULL key matches nothing.

    A join with a repeated key would repeat what it is joined to without a word.
    """
    rest = [c for c in dim.columns if c not in keys]
    several = F.raise_error(F.concat_ws(" ", F.lit("repeated key in a dimension:"), *(F.col(k).cast("string") for k in keys)))
    known = dim.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    row = F.first(F.struct(*(F.col(f"`{c}`") for c in rest)))
    return known.groupBy(*keys).agg(F.when(F.count(F.lit(1)) > 1, several).otherwise(row).alias("__row")).select(
        *keys, *(F.col(f"__row.`{c}`") for c in rest))


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; table has {df.columns}")
