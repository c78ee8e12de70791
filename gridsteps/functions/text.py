"""String similarity as native column expressions.

The score of two strings is 100 * 2 * LCS / (len a + len b), rounded half to
even, where LCS is the length of the longest common subsequence. For a pattern
of up to 62 characters the LCS is a fold over the other string with one bigint
as state: bit i of the state is cleared when pattern position i joins the
subsequence. Longer patterns fold whole rows of the usual table.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_BITS = 62


def normalise(text: Column) -> Column:
    """Lower case, characters other than letters and digits to blanks, trimmed."""
    return F.trim(F.lower(F.regexp_replace(text, r"(?U)\W", " ")))


def match_masks(pattern: Column) -> Column:
    """Map of each character of the pattern to the bits of its positions."""
    chars = F.split(pattern, "")
    return F.map_from_arrays(
        F.array_distinct(chars),
        F.transform(
            F.array_distinct(chars),
            lambda c: F.aggregate(
                F.transform(
                    chars,
                    lambda d, i: F.when(
                        (c == d) & (i < MAX_BITS),
                        F.call_function("shiftleft", F.lit(1).cast("bigint"), i),
                    ).otherwise(F.lit(0).cast("bigint")),
                ),
                F.lit(0).cast("bigint"),
                lambda acc, m: acc.bitwiseOR(m),
            ),
        ),
    )


def _lcs_bits(masks: Column, length: Column, chars: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), length) - 1
    hits = F.transform(chars, lambda c: F.coalesce(F.try_element_at(masks, c), zero))
    state = F.aggregate(
        hits, full,
        lambda v, m: ((v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))).bitwiseAND(full),
    )
    return length - F.bit_count(state)


def _lcs_rows(pattern: Column, other: Column) -> Column:
    first = F.array_repeat(F.lit(0), F.size(other) + 1)

    def next_row(row: Column, c: Column) -> Column:
        return F.aggregate(
            F.arrays_zip(other.alias("ch"), F.slice(row, 1, F.size(other)).alias("diag"),
                         F.slice(row, 2, F.size(other)).alias("up")),
            F.array(F.lit(0)),
            lambda acc, z: F.concat(acc, F.array(
                F.when(z["ch"] == c, z["diag"] + 1).otherwise(
                    F.greatest(z["up"], F.element_at(acc, -1))))),
        )

    return F.element_at(F.aggregate(F.split(pattern, ""), first, next_row), -1)


def lcs_length(pattern: Column, text: Column, masks: Column | None = None,
               chars: Column | None = None) -> Column:
    """Length of the longest common subsequence of two strings.

    The masks of the pattern and the characters of the text may be passed in
    where many pairs share them.
    """
    length = F.length(pattern)
    masks = match_masks(pattern) if masks is None else masks
    chars = F.split(text, "") if chars is None else chars
    return (
        F.when((length == 0) | (F.length(text) == 0), F.lit(0))
        .when(length <= MAX_BITS, _lcs_bits(masks, length, chars))
        .otherwise(_lcs_rows(pattern, chars))
    )


def score_of(lcs: Column, total: Column) -> Column:
    """Rounded score of an LCS length over the summed lengths."""
    return F.when(total == 0, F.lit(0)).otherwise(
        F.bround(F.lit(100.0) * 2 * lcs / total, 0).cast("int"))


def lcs_ratio(a: Column, b: Column) -> Column:
    """Similarity score 0..100 of two strings as they stand."""
    return score_of(lcs_length(a, b), F.length(a) + F.length(b))
