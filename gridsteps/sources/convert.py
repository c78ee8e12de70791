"""Conversion of stored variables between table formats, and to flat files with sidecars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gridsteps.model import single_rows
from gridsteps.sources.flatgrid import write_blocks
from gridsteps.sources.metadata import merge_metadata, public_columns

def convertible(catalog: DataFrame, ids: str | Sequence[str] | None = None) -> DataFrame:
    """Outputs stored as cdf that a conversion takes: never the grid, or only ``ids``."""
    picked = catalog.filter((F.col("fmt") == "cdf") & (F.col("name") != "grid"))
    if ids is None:
        return picked
    return picked.filter(F.col("name").isin([ids] if isinstance(ids, str) else list(ids)))


def _of_variables(values: DataFrame, names: DataFrame) -> DataFrame:
    """Values of the variables that ``names`` lists.

    Names are sent to the values, a row per variable: an exchange of the values by
    variable would give one task all rows of a variable.
    """
    return values.join(F.broadcast(names.select("variable").distinct()), "variable", "left_semi")


def convert_format(values: DataFrame, path: str, fmt: str = "parquet",
                   variables: DataFrame | None = None) -> None:
    """Write values as a table partitioned by variable and year.

    ``variables`` limits the conversion to its names. The rebalance hint keeps
    files even: a partition with most rows is split, small ones share a task.
    Other partitions below the path stay.
    """
    if variables is not None:
        values = _of_variables(values, variables.select(F.col("name").alias("variable")))
    (
        values.hint("rebalance", "variable", "year")
        .sortWithinPartitions("variable", "year", "cell", "band")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .format(fmt).partitionBy("variable", "year").save(path)
    )


def raw_sidecars(sidecars: DataFrame) -> DataFrame:
    """Metadata of the flat files that a conversion of these variables makes.

    What the conversion itself knows (place, order and type of the numbers) comes first,
    everything else from the sidecar of the source; band names always do. Integer types stay,
    others become ``float`` unless they are ``double``.
    """
    source = public_columns(sidecars.drop("path"))
    word = F.lower(F.col("datatype").cast("string"))
    target = source.select(
        "variable", F.coalesce("firstcell", F.lit(0)).alias("firstcell"), "ncell", "nbands",
        F.when(word.isin("byte", "short", "int", "double"), word).otherwise(F.lit("float")).alias("datatype"),
        F.lit("cellyear").alias("order"), F.lit(False).alias("bigendian"), F.lit("raw").alias("format"),
        F.concat("variable", F.lit(".bin")).alias("filename"),
        *(["ref_area"] if "ref_area" in source.columns else []))
    return merge_metadata(target, single_rows(source, "variable"))


def convert_raw(values: DataFrame, catalog: DataFrame, sidecars: DataFrame, path: str,
                ids: str | Sequence[str] | None = None, mode: str = "append", **options) -> DataFrame:
    """Outputs stored as cdf to flat blocks and merged sidecars, published together; returns the sidecars.

    ``catalog`` says what is stored how (see ``convertible``), ``sidecars`` describe the source. A
    variable without a sidecar, or with two, is an error. ``mode="append"`` replaces the (variable, year)s
    that the values hold, ``"overwrite"`` everything below the path. ``options`` are those of
    ``write_blocks``, such as ``blockelements`` and ``fill``.
    """
    names = convertible(catalog, ids).select(F.col("name").alias("variable")).distinct()
    merged = raw_sidecars(sidecars.join(names, "variable", "left_semi"))
    layout = merged.select("variable", "ncell", "nbands", "firstcell", "datatype")
    picked = _of_variables(values.select("variable", "cell", "band", "year", "value"), names)
    write_blocks(picked.join(F.broadcast(layout), "variable", "left"), merged, path, mode, **options)
    return merged
