"""Validation: every broken rule is a row, not an aborted job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce as fold

from pyspark.sql import Column, DataFrame, functions as F

from gridsteps.functions.missing import is_integer_type, type_word
from gridsteps.model import KEYS
from gridsteps.operators.bands import subannual_violations


# Slots in a word of bits.
WORD = 62
# What each integer type holds; bytes are unsigned, as flat files store them.
INTEGER_RANGES = {"byte": (0, 255), "short": (-32768, 32767), "int": (-2147483648, 2147483647)}


def _violations(df: DataFrame, rule: str, detail: Column) -> DataFrame:
    """Bring a table to the violation schema; absent axes become NULL."""
    types = {"variable": "string", "year": "int", "cell": "bigint", "band": "int"}
    axes = [
        (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()
    ]
    return df.select(F.lit(rule).alias("rule"), *axes, detail.cast("string").alias("detail"))


def check_types(values: DataFrame, registry: DataFrame) -> DataFrame:
    """Fractions and out-of-range values in integer variables, and types nobody knows.

    ``registry`` carries (variable, datatype).
    """
    declared = registry.select("variable", "datatype")
    whole = values.join(declared.filter(is_integer_type(F.col("datatype"))), "variable")
    word = type_word(F.col("datatype"))
    outside = F.lit(False)
    for name, (low, high) in INTEGER_RANGES.items():
        outside = F.when(word == name, ~F.col("value").between(low, high)).otherwise(outside)
    fractions = whole.filter((F.col("value") != F.floor(F.col("value"))) | outside)
    unknown = declared.filter(type_word(F.col("datatype")).isNull())
    return _violations(fractions, "type", F.col("value")).unionByName(
        _violations(unknown, "datatype", F.col("datatype")))


def check_unknown(values: DataFrame, registry: DataFrame) -> DataFrame:
    """Variables that the registry lacks, one row each."""
    names = values.groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
    lost = names.join(registry.select("variable"), "variable", "left_anti")
    return _violations(lost, "unknown", F.col("n"))


def check_counts(values: DataFrame, registry: DataFrame, ncell: int | Column,
                 lenient: bool = False) -> DataFrame:
    """Cells and bands per (variable, year) against the registry's ``nband``.

    Every mismatch is reported. ``lenient`` reports only one-band variables
    whose cell count differs. Distinct keys are counted from one aggregate over
    the full key, so no step depends on a single crowded (variable, year).
    """
    # Both aggregates share one exchange by (variable, year, cell).
    dealt = values.select("variable", "year", "cell", "band").repartition("variable", "year", "cell")
    keys = dealt.groupBy("variable", "year", "cell", "band").agg(F.count(F.lit(1)).alias("n"))
    per_cell = keys.groupBy("variable", "year", "cell").agg(
        F.count(F.lit(1)).alias("bands"), F.max("band").alias("top"))
    shape = per_cell.groupBy("variable", "year").agg(
        F.count(F.lit(1)).alias("cells"), F.min("bands").alias("fewest"),
        F.max("bands").alias("most"), F.max("top").alias("top"))
    bad_cells = F.col("cells") != ncell
    bad_bands = (F.col("fewest") != F.col("nband")) | (F.col("most") != F.col("nband")) | (
        F.col("top") != F.col("nband") - 1)
    rule = (F.col("nband") == 1) & bad_cells if lenient else bad_cells | bad_bands
    wrong = shape.join(registry.select("variable", "nband"), "variable").filter(rule)
    return _violations(wrong, "shape", F.concat_ws(
        " ", F.concat(F.lit("cells="), F.col("cells")), F.concat(F.lit("bands="), F.col("most"))))


def check_duplicates(values: DataFrame) -> DataFrame:
    twice = values.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return _violations(twice, "duplicate", F.col("n"))


def check_missing(values: DataFrame, cells: DataFrame, bands: DataFrame,
                  variables: Sequence[str], years: tuple[int, int]) -> DataFrame:
    """Keys of the dense cube that the table lacks.

    Band and year of a key are a slot; what the values hold per cell and variable is a bit per slot, 62 to a
    word. Words meet the wanted slots of their variable, so dense keys exist only inside a row, and only missing
    ones become rows.
    """
    first, last = (F.lit(y) if isinstance(y, int) else y for y in years)
    length = (last - first + 1).cast("bigint")
    slots = (
        bands.filter(F.col("variable").isin(*variables)).select("variable", F.col("band").cast("bigint").alias("band")).distinct()
        .withColumn("n", length)
        .select("variable", F.explode(F.sequence(F.col("band") * F.col("n"), F.col("band") * F.col("n") + F.col("n") - 1)).alias("slot"))
        .groupBy("variable", F.floor(F.col("slot") / WORD).alias("word")).agg(F.collect_list("slot").alias("slots"))
    )
    slot = F.col("band").cast("bigint") * length + (F.col("year") - first)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("slot", F.lit(WORD)).cast("int"))
    have = (
        values.filter(F.col("variable").isin(*variables) & F.col("year").between(first, last))
        .select("variable", F.col("cell").cast("bigint").alias("cell"), slot.alias("slot")).filter("cell IS NOT NULL AND slot IS NOT NULL")
        .groupBy("variable", "cell", F.floor(F.col("slot") / WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))
    )
    wanted = cells.select(F.col("cell").cast("bigint").alias("cell")).withColumn(
        "variable", F.explode(F.array(*map(F.lit, variables)))).join(slots, "variable")
    held = lambda s: F.call_function("shiftright", F.coalesce("bits", F.lit(0).cast("bigint")), F.pmod(s, F.lit(WORD)).cast("int"))
    lost = F.filter("slots", lambda s: held(s).bitwiseAND(F.lit(1)) == 0)
    rows = (
        wanted.join(have, ["variable", "cell", "word"], "left").select("variable", "cell", F.explode(lost).alias("slot"))
        .withColumn("n", length).withColumn("first", first)
    )
    return _violations(rows.select(
        "variable", "cell", F.floor(F.col("slot") / F.col("n")).cast("int").alias("band"),
        (F.pmod("slot", "n") + F.col("first")).cast("int").alias("year")), "missing", F.lit("no row"))


def check_index(indices: DataFrame, supported: DataFrame) -> DataFrame:
    """Output indices without a variable that supports them; both carry ``index``, the latter ``name`` too.

    An index that is listed several times is a row of its own kind.
    """
    listed = supported.groupBy("index").agg(F.count(F.lit(1)).alias("n"))
    asked = indices.groupBy("index").agg(F.count(F.lit(1)).alias("asked"))
    state = asked.join(listed, "index", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return _violations(
        state.filter("n <> 1 OR index IS NULL").select(F.col("index").cast("string").alias("variable"), F.when(
            F.col("n") > 1, F.lit("index of several outputs")).otherwise(F.lit("index is not supported")).alias("detail")),
        "index", F.col("detail"))


def check_coupled(inputs: DataFrame, registry: DataFrame) -> DataFrame:
    """Coupled inputs (name) that the registry of input types lacks, or has under another id if both give one."""
    known = registry.select("name", F.col("id").alias("registered"), F.lit(True).alias("known"))
    asked = inputs.select("name", *([F.col("id")] if "id" in inputs.columns else [F.lit(None).cast("int").alias("id")])).distinct()
    state = asked.join(known, "name", "left")
    wrong = F.when(F.col("known").isNull(), F.lit("input is not registered")).when(
        F.col("id") != F.col("registered"), F.concat_ws(" ", F.lit("registered with id"), "registered"))
    return _violations(state.select(F.col("name").alias("variable"), wrong.alias("detail")).filter("detail IS NOT NULL"),
                       "registry", F.col("detail"))


def check_periods(values: DataFrame, variables: DataFrame) -> DataFrame:
    """Variables of a table whose metadata name no period, or several."""
    period = F.when(F.col("firstyear").isNotNull() & F.col("lastyear").isNotNull(), F.struct("firstyear", "lastyear"))
    given = variables.groupBy("variable").agg(F.count(period).alias("n"))
    state = values.select("variable").distinct().join(given, "variable", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return _violations(state.filter("n <> 1"), "period", F.col("n"))


def check_year(values: DataFrame, expected: int) -> DataFrame:
    """Years other than the expected one, one row per (variable, year)."""
    wrong = values.filter(F.col("year") != expected).groupBy("variable", "year").agg(
        F.count(F.lit(1)).alias("n"))
    return _violations(wrong, "year", F.col("n"))


def check_metadata(variables: DataFrame) -> DataFrame:
    """Cells that are not square."""
    wrong = variables.filter(~F.col("cellsize_lat").eqNullSafe(F.col("cellsize_lon")))
    return _violations(wrong, "cellsize", F.concat_ws(
        " ", F.col("cellsize_lon").cast("string"), F.col("cellsize_lat").cast("string")))


def check_streams(inputs: DataFrame, outputs: DataFrame, ncell: int | Column, config: dict) -> DataFrame:
    """Counts of cells, inputs and outputs as configured, at least one of each.

    ``config`` holds ncell, ninput and noutput, as numbers or columns.
    """
    column = lambda x: x if isinstance(x, Column) else F.lit(x)
    counted = inputs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("ninput").alias("what"), "n")
    counted = counted.unionByName(
        outputs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("noutput").alias("what"), "n"))
    expected = F.when(F.col("what") == "ninput", column(config["ninput"])).otherwise(
        column(config["noutput"]))
    wrong = counted.filter((F.col("n") != expected) | (F.col("n") == 0)).select(
        "what", F.col("n").cast("string").alias("detail"))
    cells = wrong.sparkSession.range(1).select(
        F.lit("ncell").alias("what"), column(ncell).alias("n"), column(config["ncell"]).alias("wanted"))
    wrong = wrong.unionByName(cells.filter("n != wanted").select("what", F.col("n").cast("string").alias("detail")))
    return _violations(wrong.withColumnRenamed("what", "variable"), "count", F.col("detail"))


def check_subannual(values: DataFrame) -> DataFrame:
    return _violations(subannual_violations(values), "subannual", F.lit("several bands"))


def validate(values: DataFrame, registry: DataFrame, cells: DataFrame | None = None,
             bands: DataFrame | None = None, years: tuple[int, int] | None = None,
             variables: Sequence[str] | None = None, year: int | None = None,
             ncell: int | None = None, strict: bool = False) -> DataFrame:
    """All checks the given tables allow, as (rule, variable, year, cell, band, detail).

    ``registry`` carries (variable, datatype, nband). With ``strict`` the first
    violation raises when the result is evaluated.
    """
    checks = [check_unknown(values, registry), check_types(values, registry),
              check_duplicates(values)]
    if "step" in values.columns:
        checks.append(check_subannual(values))
        checks[2] = _violations(
            values.groupBy(*KEYS, "step").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"),
            "duplicate", F.col("n"))
    if year is not None:
        checks.append(check_year(values, year))
    if ncell is not None:
        checks.append(check_counts(values, registry, ncell))
    if None not in (cells, bands, years, variables):
        checks.append(check_missing(values, cells, bands, variables, years))
    found = fold(DataFrame.unionByName, checks)
    if strict:
        text = F.concat_ws(" ", F.lit("violated"), F.col("rule"), F.col("variable"), F.col("detail"))
        found = found.filter(F.raise_error(text).isNotNull())
    return found
