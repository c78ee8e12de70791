"""Code lookups and fuzzy name matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gridsteps.functions.text import normalise
from gridsteps.model import single_rows
from gridsteps.operators.names import FOUND, match_block

BLOCK_NAMES = 1 << 16
TASK_TEXTS = 2048


def code_to_name(df: DataFrame, dim: DataFrame, column: str = "country_id",
                 out: str = "country") -> DataFrame:
    """Name of an id; an id the dimension lacks stays as text.

    ``dim`` carries (id, name). Ids compare as integers; an id listed twice is an error.
    """
    names = single_rows(dim.select(F.col("id").cast("bigint").alias("__id"), F.col("name").alias("__name")), "__id")
    return (
        df.join(names, F.col(column).cast("bigint") == F.col("__id"), "left")
        .withColumn(out, F.coalesce(F.col("__name"), F.col(column).cast("string")))
        .drop("__id", "__name")
    )


def code_to_iso(df: DataFrame, dim: DataFrame, iso: DataFrame, column: str = "country_id",
                out: str = "country", strict: bool = True) -> DataFrame:
    """ISO code of an id through its name.

    ``dim`` carries (id, name), ``iso`` carries (name, code). An id the first
    lacks stays as text; a listed name the second lacks raises when ``strict``,
    and gives NULL otherwise.
    """
    codes = single_rows(dim.select(F.col("id").cast("bigint").alias("__id"), F.col("name").alias("__name")), "__id").join(
        single_rows(iso.select(F.col("name").alias("__name"), F.col("code").alias("__code")), "__name"), "__name", "left")
    unknown = F.raise_error(F.concat(F.lit("name without a code: "), F.col("__name"))).cast("string")
    code = F.when(F.col("__id").isNull(), F.col(column).cast("string")).otherwise(
        F.coalesce(F.col("__code"), unknown) if strict else F.col("__code"))
    return (
        df.join(codes, F.col(column).cast("bigint") == F.col("__id"), "left")
        .withColumn(out, code)
        .drop("__id", "__name", "__code")
    )


def iso_to_name(df: DataFrame, iso: DataFrame, column: str = "code",
                out: str = "country") -> DataFrame:
    """Lower-case name of a code; a code listed twice is an error."""
    names = single_rows(iso.select(F.col("code").alias("__code"), F.lower("name").alias("__name")), "__code")
    return (
        df.join(names, F.col(column) == F.col("__code"), "left")
        .withColumn(out, F.col("__name")).drop("__code", "__name")
    )


def fuzzy_match(queries: DataFrame, column: str, names: DataFrame, report: bool = False) -> DataFrame:
    """Best name for every distinct query text: (query, name, code, score).

    ``names`` carries (pos, name, code); the smallest ``pos`` wins a tie, and
    there is no threshold. Names are dealt in blocks of about ``BLOCK_NAMES`` and texts
    in parts of about ``TASK_TEXTS``; every task indexes a block once (see ``names``) and
    its texts score only the names that may still win. ``report`` adds ``scored``, the
    number of names that were scored. An empty name table is an error.
    """
    names = names.select(
        normalise(F.col("name").cast("string")).alias("text"), F.col("pos").cast("bigint").alias("pos"),
        F.col("name").cast("string").alias("name"), F.col("code").cast("string").alias("code"))
    texts = queries.select(F.col(column).cast("string").alias("query")).filter("query is not null").distinct().withColumn(
        "text", normalise(F.col("query")))
    n_names = F.count(F.lit(1))
    blocks = names.agg(F.when(n_names > 0, F.ceil(n_names / BLOCK_NAMES)).otherwise(F.raise_error(
        F.lit("the name table is empty")).cast("bigint"))).scalar()
    salts = texts.agg(F.greatest(F.ceil(F.count(F.lit(1)) / TASK_TEXTS), F.lit(1))).scalar()
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    held = names.select(
        F.pmod(F.xxhash64("name", "pos"), blocks).alias("block"), every(salts).alias("salt"), F.lit(0).alias("tag"),
        F.coalesce("text", F.lit("")).alias("text"), "pos", "name", "code", F.lit(None).cast("string").alias("query"))
    asked = texts.select(
        every(blocks).alias("block"), F.pmod(F.xxhash64("query"), salts).alias("salt"), F.lit(1).alias("tag"), "text",
        *(F.lit(None).cast(t).alias(c) for c, t in (("pos", "bigint"), ("name", "string"), ("code", "string"))), "query")
    dealt = held.unionByName(asked).repartition("block", "salt").sortWithinPartitions("block", "salt", "tag")
    best = dealt.mapInArrow(match_block, FOUND).groupBy("query").agg(
        F.max_by(F.struct("name", "code"), F.struct("score", -F.col("pos"))).alias("best"),
        F.max("score").alias("score"), F.sum("scored").alias("scored"))
    return best.select("query", "best.name", "best.code", "score", *(["scored"] if report else []))


def name_metadata(variables: DataFrame, names: Sequence[str], codes: Sequence[str] = ()) -> DataFrame:
    """Metadata after ids have become names, or codes: ``long_name`` says so; others stay."""
    v = F.col("variable")
    return variables.withColumn("long_name", F.when(v.isin(*codes), F.concat(v, F.lit(" iso alpha-3 code")))
                                .when(v.isin(*names), F.concat(v, F.lit(" name"))).otherwise(F.col("long_name")))


def resolve_variable(df: DataFrame, outputs: DataFrame, column: str = "index") -> DataFrame:
    """Variable name of a numeric output index; ``outputs`` carries (index, name).

    An index that the table lacks keeps its rows, with a NULL variable; one listed twice is an error.
    """
    names = single_rows(outputs.select(F.col("index").alias("__index"), F.col("name").alias("variable")), "__index")
    return df.join(names, F.col(column) == F.col("__index"), "left").drop("__index")


def input_type_rules(inputs: DataFrame) -> DataFrame:
    """Registry of input types from (id, name): band count, type, has_bands."""
    # Band counts of multi-band inputs and names of integer inputs.
    nband = (
        F.when(F.col("name") == "landuse", 64)
        .when(F.col("name").isin("fertilizer_nr", "manure_nr"), 32)
        .when(F.col("name").isin("sdate", "crop_phu"), 24)
        .when(F.col("name") == "residue_on_field", 16)
        .otherwise(1)
    )
    return inputs.select(
        "id", "name", nband.alias("nband"),
        F.when(F.col("name").isin("with_tillage", "sdate"), "int").otherwise("float").alias("type"),
        (nband > 1).alias("has_bands"))


def find_input_type(registry: DataFrame, id: int | None = None, name: str | None = None) -> DataFrame:
    if id is not None:
        return registry.filter(F.col("id") == id)
    if name is not None:
        return registry.filter(F.col("name") == name)
    raise ValueError("give an id or a name")
