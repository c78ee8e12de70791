"""Assembly, append, overlay and comparison of runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce as fold

from pyspark.sql import DataFrame, functions as F

from gridsteps.model import KEYS
from gridsteps.operators.cube import to_wide


def assemble(parts: dict[str, DataFrame]) -> DataFrame:
    """One long table from arrays by name; coordinates are outer-aligned by nature."""
    named = [df.withColumn("variable", F.lit(v)).select(*KEYS, "value") for v, df in parts.items()]
    return fold(DataFrame.unionByName, named)


def assemble_wide(parts: dict[str, DataFrame]) -> DataFrame:
    """Wide form, outer-aligned by one aggregate rather than a join per variable."""
    return to_wide(assemble(parts), list(parts))


def merge_datasets(parts: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts): one value per key over all parts, and the keys whose values clash.

    Coordinates are outer-aligned. A key's value is that of the first part, in the given order, that has one;
    missing values (NULL and NaN) give way to any other. Values clash where parts, or rows of one part, hold
    different ones for a key: ``conflicts`` carries the key, how many values there are, the least and the largest,
    and the position of the part whose value was taken. One aggregate by key; nothing is joined.
    """
    value = F.col("value").cast("double")
    ranked = [p.select(*KEYS, F.when(~F.isnan(value), value).alias("value"), F.lit(i).alias("__part")) for i, p in enumerate(parts)]
    # Of several rows in one part the smallest value counts, so that reruns agree.
    taken = F.min(F.when(F.col("value").isNotNull(), F.struct("__part", "value")))
    merged = fold(DataFrame.unionByName, ranked).groupBy(*KEYS).agg(
        taken.alias("__taken"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.count("value").alias("n"))
    return (
        merged.select(*KEYS, F.col("__taken.value").alias("value")),
        merged.filter("low < high").select(*KEYS, "n", "low", "high", F.col("__taken.__part").alias("part")),
    )


def inherit_attributes(variables: DataFrame) -> DataFrame:
    """Dataset attributes from its first variable by ``pos``, all or none."""
    picked = ["source", "history", "cellsize", "institution", "contact", "comment"]
    have = [c for c in picked if c in variables.columns]
    return variables.agg(F.min_by(F.struct(*have), "pos").alias("a")).select("a.*")


def append_years(history: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both; every row carries its year, so time grows by itself."""
    return history.unionByName(new, allowMissingColumns=True)


def write_years(values: DataFrame, path: str) -> None:
    """Replace exactly the (variable, year) partitions that the rows touch.

    The rebalance hint splits a partition that holds most rows over several
    files and joins small ones, and a repeated write gives the same table.
    """
    (
        values.hint("rebalance", "variable", "year")
        .sortWithinPartitions("variable", "year", "cell", "band")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("variable", "year").parquet(path)
    )


def overlay(base: DataFrame, new: DataFrame) -> DataFrame:
    """Overwrite the base where ``new`` has the same keys, NULL included.

    Keys of ``new`` that the base lacks are ignored; a key that it repeats is an
    error.
    """
    twice = F.raise_error(F.concat_ws(" ", F.lit("repeated key in the overlay:"), *KEYS)).cast("double")
    update = new.groupBy(*KEYS).agg(F.struct(F.when(F.count(F.lit(1)) > 1, twice).otherwise(
        F.first("value")).alias("value")).alias("__new"))
    return (
        base.join(update, KEYS, "left")
        .withColumn("value", F.when(F.col("__new").isNotNull(), F.col("__new.value"))
                    .otherwise(F.col("value")))
        .select(*base.columns)
    )


def compare_runs(a: DataFrame, b: DataFrame, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """Per variable: are all values close, the largest difference, one-sided rows.

    Values are close when \\|a-b\\| <= atol + rtol * \\|b\\|; a missing value is
    close to nothing.
    """
    left = a.select(*KEYS, F.struct(F.col("value").alias("v")).alias("a"))
    right = b.select(*KEYS, F.struct(F.col("value").alias("v")).alias("b"))
    both = left.join(right, KEYS, "full")
    difference = F.abs(F.col("a.v") - F.col("b.v"))
    close = difference <= F.lit(atol) + F.lit(rtol) * F.abs(F.col("b.v"))
    one_sided = F.col("a").isNull() | F.col("b").isNull()
    return both.groupBy("variable").agg(
        F.bool_and(F.coalesce(close, F.lit(False)) & ~F.isnan(F.coalesce(difference, F.lit(0.0))))
        .alias("all_close"),
        F.max(F.when(~F.isnan(difference), difference)).alias("max_abs_diff"),
        F.sum(F.when(one_sided, 1).otherwise(0)).cast("bigint").alias("one_sided"),
        F.count(F.lit(1)).alias("compared"),
    )


def undefined_variables(requested: DataFrame, defined: DataFrame) -> DataFrame:
    """Requested names that are not defined; both carry ``name``."""
    return requested.select("name").distinct().join(defined.select("name"), "name", "left_anti")
