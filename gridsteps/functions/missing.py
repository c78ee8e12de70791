"""Missing values and value types as column expressions.

In tables a missing value is NULL, which Spark's aggregates skip. At the borders
it is NaN for float types and the sentinel -9999 for integer types.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridsteps.model import INTEGER_TYPES, MISSING_INT, VALUE_TYPES


def type_word(datatype: Column) -> Column:
    """Accept a type as code or word and return the word; unknown gives NULL."""
    text = F.lower(F.trim(datatype.cast("string")))
    expr = F.lit(None).cast("string")
    for code, word, _ in VALUE_TYPES:
        expr = F.when(text.isin(str(code), word), F.lit(word)).otherwise(expr)
    return expr


def is_integer_type(datatype: Column) -> Column:
    return type_word(datatype).isin(*INTEGER_TYPES)


def decode_missing(value: Column, datatype: Column) -> Column:
    """Sentinel to NULL by type, so that a real float -9999 survives."""
    return F.when(
        is_integer_type(datatype), F.nullif(value, F.lit(float(MISSING_INT)))
    ).otherwise(F.when(~F.isnan(value), value))


def encode_missing(value: Column, datatype: Column) -> Column:
    """NULL to the sentinel of the type."""
    return F.coalesce(
        value,
        F.when(is_integer_type(datatype), F.lit(float(MISSING_INT))).otherwise(
            F.lit(float("nan"))),
    )


def cast_by_datatype(value: Column, datatype: Column) -> Column:
    """Value as its declared type would hold it, back in one double column.

    Integer types drop the fraction, ``float`` rounds to four bytes. A value
    outside the range of its type, and an unknown type, give NULL.
    """
    word = type_word(datatype)
    expr = F.lit(None).cast("double")
    for _, name, spark_type in VALUE_TYPES:
        if name == "byte":  # stored unsigned
            cast = F.when(value.between(0, 255), value.cast("smallint").cast("double"))
        else:
            cast = value.try_cast(spark_type).cast("double")
        expr = F.when(word == name, cast).otherwise(expr)
    return expr
