"""Selection along years, cells and bands; calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridsteps.model import single_rows


def select_years(values: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Closed year range; an open end reaches to the border of the data.

    The filter stays on the bare column, so it prunes year partitions.
    """
    year = F.col("year")
    if start is not None:
        values = values.filter(year >= start)
    if end is not None:
        values = values.filter(year <= end)
    return values


def clamped_bounds(first: Column, last: Column, start: int | None, end: int | None,
                   default_year: int) -> tuple[Column, Column]:
    """Requested range fitted to the data period [first, last].

    A request beyond one side of the data gives the nearest single year.
    """
    start = default_year if start is None else start
    end = default_year if end is None else end
    if start > end:
        raise ValueError(f"start year {start} is later than end year {end}")
    lo = F.when(first > end, first).when(last < start, last).otherwise(
        F.greatest(first, F.lit(start)))
    hi = F.when(first > end, first).when(last < start, last).otherwise(
        F.least(last, F.lit(end)))
    return lo, hi


def clamp_years(values: DataFrame, variables: DataFrame, start: int | None, end: int | None,
                default_year: int) -> DataFrame:
    """Years of each variable within its clamped range; bounds come from metadata.

    A variable without metadata, or whose metadata name no period, has nothing to
    be clamped to and keeps the requested years; one with two rows of metadata is
    an error. The widest of the ranges also becomes a plain year filter, which
    prunes partitions before any variable is looked at.
    """
    bounds, asked = year_bounds(variables, start, end, default_year)
    widest = [F.coalesce(far(bounds.agg(f(c)).scalar(), year), year) for f, far, c, year in (
        (F.min, F.least, "__lo", asked[0]), (F.max, F.greatest, "__hi", asked[1]))]
    return (
        values.filter(F.col("year").between(*widest)).join(bounds, "variable", "left")
        .filter(F.col("year").between(F.coalesce("__lo", asked[0]), F.coalesce("__hi", asked[1])))
        .drop("__lo", "__hi")
    )


def year_bounds(variables: DataFrame, start: int | None, end: int | None,
                default_year: int) -> tuple[DataFrame, tuple[Column, Column]]:
    """(variable, __lo, __hi): the clamped range of each variable, and the range asked for."""
    lo, hi = clamped_bounds(F.col("firstyear"), F.col("lastyear"), start, end, default_year)
    known = F.col("firstyear").isNotNull() & F.col("lastyear").isNotNull()
    bounds = single_rows(variables.select(
        "variable", F.when(known, lo).alias("__lo"), F.when(known, hi).alias("__hi")), "variable")
    return bounds, (F.lit(default_year if start is None else start), F.lit(default_year if end is None else end))


def align_years(values: DataFrame) -> DataFrame:
    """Label every variable with the largest year; each must hold a single year."""
    bounds = values.groupBy("variable").agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    top = bounds.select(
        F.when(F.max((F.col("lo") != F.col("hi")).cast("int")) == 1,
               F.raise_error(F.lit("every variable must hold a single year")).cast("int"))
        .otherwise(F.max("hi")).alias("year")).scalar()
    return values.withColumn("year", top.cast("int"))


def observed_calendar(values: DataFrame, start_coupling: int) -> DataFrame:
    """Every year from the first to the last of a table, with its phase."""
    span = values.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    years = span.select(F.explode(F.sequence("lo", "hi")).alias("year"))
    return years.withColumn(
        "phase", F.when(F.col("year") < start_coupling, "historic").otherwise("coupled"))


def cell_range(spark: SparkSession, start: int, end: int, by_id: bool = True) -> DataFrame:
    """Cells start..end inclusive, as ids or as 0-based indices."""
    if by_id:
        return spark.range(start, end + 1).withColumnRenamed("id", "cell")
    return spark.range(0, end - start + 1).withColumnRenamed("id", "cell_index")


def resolve_cell_range(variables: DataFrame, start: int | str, end: int | str) -> DataFrame:
    """One row (startgrid, endgrid); "all" means 0 and the cell count less one."""
    lo = F.lit(0 if start == "all" else int(start))
    hi = F.max("ncell") - 1 if end == "all" else F.lit(int(end))
    return variables.agg(hi.cast("bigint").alias("endgrid")).select(
        lo.cast("bigint").alias("startgrid"), "endgrid")


def select_cells(df: DataFrame, start: int, end: int) -> DataFrame:
    """Cells of a closed id range with their 0-based index in it."""
    return df.filter(F.col("cell").between(start, end)).withColumn(
        "cell_index", (F.col("cell") - start).cast("bigint"))


def select_bands(values: DataFrame, bands: Sequence[int]) -> DataFrame:
    return values.filter(F.col("band").isin(*bands))


def year_calendar(spark: SparkSession, sim_year: int, start_coupling: int, last_year: int,
                  phase: str = "all", match_period: bool = False) -> DataFrame:
    """Years from the current one with their phase, historic or coupled.

    ``phase`` keeps one of the phases. With ``match_period`` asking for historic
    years when none is left, or for coupled years when historic ones are left,
    is an error; without it the coupled calendar starts at the current year.
    """
    if match_period and phase == "historic" and sim_year >= start_coupling:
        raise ValueError(f"no historic years left at {sim_year}; coupling starts {start_coupling}")
    if match_period and phase == "coupled" and sim_year < start_coupling:
        raise ValueError(f"historic years left at {sim_year}; coupling starts {start_coupling}")
    end = start_coupling - 1 if phase == "historic" else last_year
    years = spark.range(sim_year, max(sim_year, end + 1)).select(F.col("id").cast("int").alias("year"))
    return years.withColumn(
        "phase", F.when(F.col("year") < start_coupling, "historic").otherwise("coupled"))
