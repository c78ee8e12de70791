"""Gridded variables from any tabular format to the long value table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridsteps.functions.times import decode_time
from gridsteps.model import canonical

AXES = ["lat", "lon", "time"]


def shape_grid(table: DataFrame, variables: Sequence[str], units: str | None = None,
               time_mode: str = "unit", cell: str | None = None) -> DataFrame:
    """Landed grid table to long values.

    Columns other than lat, lon, time, the cell and the variables are further
    dimensions: none gives band 0, one becomes the band axis, numbered 0..n-1 in
    ascending order, several are an error. ``units`` ("days since 1901-01-01")
    decodes ``time``; without it time already holds years. Axes are numbered
    over their distinct values only, one row per band or time stamp.
    """
    known = [*AXES, *variables] + ([cell] if cell else [])
    extra = [c for c in table.columns if c not in known]
    if len(extra) > 1:
        raise ValueError(f"unexpected multiple dimensions {extra}")
    if not extra:
        table = table.withColumn("band", F.lit(0))
    else:
        axis = table.select(extra[0]).distinct().select(
            extra[0],
            (F.row_number().over(Window.orderBy(extra[0])) - 1).cast("int").alias("__band"))
        table = table.join(axis, extra[0]).drop(extra[0]).withColumnRenamed("__band", "band")
    if "time" in table.columns:
        if units is None:
            table = table.withColumn("year", F.col("time").cast("int"))
        elif time_mode == "month_index":
            ticks = table.select("time").distinct().select(
                "time", (F.row_number().over(Window.orderBy("time")) - 1).alias("__tick"))
            table = table.join(ticks, "time").withColumn(
                "year", decode_time(F.col("time"), F.lit(units), F.col("__tick"), "month_index")
            ).drop("__tick")
        else:
            table = table.withColumn("year", decode_time(F.col("time"), F.lit(units)))
        table = table.drop("time")
    keys = [c for c in table.columns if c not in variables]
    if len(variables) == 1:
        long = table.withColumn("variable", F.lit(variables[0])).withColumnRenamed(
            variables[0], "value")
    else:
        long = table.select(*keys, *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(
            keys, list(variables), "variable", "value")
    if cell and cell != "cell":
        long = long.withColumnRenamed(cell, "cell")
    return canonical(long)


def load_grid(spark: SparkSession, path: str, variables: Sequence[str], fmt: str = "parquet",
              units: str | None = None, time_mode: str = "unit", cell: str | None = None,
              options: dict | None = None) -> DataFrame:
    """Read a landed grid table (parquet, csv, json, orc) as long values."""
    reader = spark.read.format(fmt).options(**(options or {}))
    return shape_grid(reader.load(path), variables, units, time_mode, cell)


def load_values(spark: SparkSession, path: str, variables: Sequence[str] | None = None,
                years: tuple[int, int] | None = None) -> DataFrame:
    """Long value table written by this library; both filters prune partitions."""
    df = spark.read.parquet(path)
    if variables is not None:
        df = df.filter(F.col("variable").isin(*variables))
    if years is not None:
        df = df.filter(F.col("year").between(*years))
    return canonical(df)
