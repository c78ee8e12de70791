"""Reductions and time-axis operators on long value tables.

NULL is missing and is skipped by every reduction. Windows run per (variable,
cell, band) over the years; these keys are unique per year, so a window is as
long as the calendar. ``validate`` reports tables that break this.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridsteps.model import KEYS

_HOW: dict[str, Callable[[str], Column]] = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_pop,
}

SERIES = ["variable", "cell", "band"]


def reduce_dims(values: DataFrame, over: Sequence[str], how: str = "mean") -> DataFrame:
    """Reduce over any subset of cell, band and year."""
    kept = [k for k in KEYS if k not in over]
    return values.groupBy(*kept).agg(_HOW[how]("value").alias("value"))


def reduce_by_label(values: DataFrame, dim: DataFrame, on: Sequence[str], label: str,
                    over: Sequence[str] = ("cell",), how: str = "mean") -> DataFrame:
    """Reduce per label of a dimension table, such as country, region or band label.

    A first aggregate per key precedes the join where the measure allows it, so
    repeated rows of a crowded key do not travel.
    """
    kept = [k for k in KEYS if k not in over]
    labels = dim.select(*on, label)
    if how not in ("mean", "sum", "count", "min", "max"):
        return (values.join(labels, list(on)).groupBy(label, *kept)
                .agg(_HOW[how]("value").alias("value")))
    first = list(dict.fromkeys([*kept, *on]))
    partial = values.groupBy(*first).agg(
        F.sum("value").alias("s"), F.count("value").alias("n"),
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    final = {
        "mean": F.sum("s") / F.nullif(F.sum("n"), F.lit(0)),
        "sum": F.sum("s"), "count": F.sum("n"), "min": F.min("lo"), "max": F.max("hi"),
    }[how]
    return partial.join(labels, list(on)).groupBy(label, *kept).agg(final.alias("value"))


def weighted_mean(values: DataFrame, weights: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean weighted by cell, for example by area; missing values carry no weight.

    ``weights`` carries (cell, weight).
    """
    present = F.col("value").isNotNull() & F.col("weight").isNotNull()
    return (
        values.join(weights.select("cell", "weight"), "cell").groupBy(*by)
        .agg((F.sum(F.when(present, F.col("value") * F.col("weight")))
              / F.nullif(F.sum(F.when(present, F.col("weight"))), F.lit(0.0))).alias("value"))
    )


def resample_years(values: DataFrame, how: str = "sum") -> DataFrame:
    """Sub-annual steps to years."""
    return values.groupBy(*KEYS).agg(_HOW[how]("value").alias("value"))


def _series(values: DataFrame):
    """Window along time: years, and the steps inside them where there are any."""
    order = ["year", "step"] if "step" in values.columns else ["year"]
    return Window.partitionBy(*SERIES).orderBy(*order)


def rolling(values: DataFrame, size: int, how: str = "mean") -> DataFrame:
    """Trailing window of ``size`` time slices; NULL unless all of them are present."""
    frame = _series(values).rowsBetween(-(size - 1), 0)
    full = F.count("value").over(frame) == size
    return values.withColumn("value", F.when(full, _HOW[how]("value").over(frame)))


def shift(values: DataFrame, periods: int = 1) -> DataFrame:
    """Values moved along the time slices; NULL where none arrives."""
    moved = F.lag("value", periods) if periods >= 0 else F.lead("value", -periods)
    return values.withColumn("value", moved.over(_series(values)))


def diff(values: DataFrame) -> DataFrame:
    """Difference to the previous time slice; the first slice is dropped."""
    return (
        values.withColumn("__n", F.row_number().over(_series(values)))
        .withColumn("value", F.col("value") - F.lag("value").over(_series(values)))
        .filter(F.col("__n") > 1).drop("__n")
    )


def cumsum(values: DataFrame) -> DataFrame:
    """Running sum along time; a missing value adds nothing."""
    frame = _series(values).rowsBetween(Window.unboundedPreceding, 0)
    return values.withColumn("value", F.coalesce(F.sum("value").over(frame), F.lit(0.0)))


def ffill(values: DataFrame) -> DataFrame:
    """Last value carried forward along time."""
    frame = _series(values).rowsBetween(Window.unboundedPreceding, 0)
    return values.withColumn("value", F.last("value", ignorenulls=True).over(frame))


def fillna(values: DataFrame, fill: float) -> DataFrame:
    return values.withColumn("value", F.coalesce(F.col("value"), F.lit(float(fill))))


def where(values: DataFrame, condition: Column) -> DataFrame:
    """Keep rows, set the value to NULL where the condition does not hold."""
    return values.withColumn("value", F.when(condition, F.col("value")))


def arithmetic(a: DataFrame, b: DataFrame, op: Callable[[Column, Column], Column],
               on: Sequence[str] = ("cell", "band", "year")) -> DataFrame:
    """Combine two arrays on their shared axes, inner-aligned."""
    left = a.select(*on, F.col("value").alias("__a"))
    right = b.select(*on, F.col("value").alias("__b"))
    return left.join(right, list(on)).select(*on, op(F.col("__a"), F.col("__b")).alias("value"))


def sort_axes(values: DataFrame, *by: str) -> DataFrame:
    return values.orderBy(*(by or KEYS))


def quantile(values: DataFrame, q: float, by: Sequence[str], buckets: int = 64) -> DataFrame:
    """Exact quantile per group with linear interpolation, one way for every group size.

    Rows become counts per (group, value) first. A sketch of the distinct values
    cuts each group into ``buckets`` ordered runs; sums per run tell which runs
    hold the two wanted ranks, and only the values of those runs are ordered. No
    group meets in one task as a whole.
    """
    group = [F.col(c) for c in by] or [F.lit(0).alias("__all")]
    counts = values.filter(F.col("value").isNotNull()).groupBy(*group, "value").agg(
        F.count(F.lit(1)).alias("f"))
    by = list(by) or ["__all"]
    steps = [k / buckets for k in range(1, buckets)]
    cuts = counts.groupBy(*by).agg(F.percentile_approx("value", steps, 20 * buckets).alias("cuts"))
    placed = counts.join(cuts, by).select(
        *by, "value", "f", F.size(F.filter("cuts", lambda c: c < F.col("value"))).alias("run"))
    runs = placed.groupBy(*by, "run").agg(F.sum("f").alias("size"))
    ordered = Window.partitionBy(*by).orderBy("run")
    rank = F.col("n") - 1
    low = F.floor(rank * q)
    wanted = (
        runs.withColumn("upto", F.sum("size").over(ordered))
        .withColumn("n", F.sum("size").over(Window.partitionBy(*by)))
        .withColumn("low", low).withColumn("high", F.least(low + 1, rank))
        .filter((F.col("upto") > F.col("low")) & (F.col("upto") - F.col("size") <= F.col("high")))
        .select(*by, "run", "n", "low", "high", (F.col("upto") - F.col("size")).alias("before"))
    )
    inside = Window.partitionBy(*by, "run").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = placed.join(wanted, [*by, "run"]).withColumn("upto", F.col("before") + F.sum("f").over(inside))
    found = reached.groupBy(*by).agg(
        F.first("n").alias("n"), F.first("low").alias("low"),
        F.min(F.when(F.col("upto") > F.col("low"), F.col("value"))).alias("x0"),
        F.min(F.when(F.col("upto") > F.col("high"), F.col("value"))).alias("x1"))
    part = rank * q - F.col("low")
    return found.withColumn("value", F.col("x0") * (1 - part) + F.col("x1") * part).select(
        *(c for c in by if c != "__all"), "value")
