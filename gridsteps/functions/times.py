"""Time axis expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unit words of a time axis and their length.
_MONTHS = {"month": 1, "year": 12}
_DAYS = {"day": 1, "week": 7}
_SECONDS = {"hour": 3600, "minute": 60, "second": 1}


def year_end(year: Column) -> Column:
    """Last day of a year, the time stamp of an annual step."""
    return F.make_date(year.cast("int"), F.lit(12), F.lit(31))


def split_units(units: Column) -> tuple[Column, Column]:
    """``"days since 1901-01-01"`` to (unit word in singular, reference date)."""
    parts = F.split(units, "since", 2)
    unit = F.regexp_replace(F.lower(F.trim(parts[0])), "s$", "")
    reference = F.trim(F.get(parts, F.lit(1)))
    return unit, F.try_to_date(F.substring(reference, 1, 10))


def decode_time(offset: Column, units: Column, position: Column | None = None,
                mode: str = "unit") -> Column:
    """Year of a time coordinate.

    ``mode="unit"`` adds the stored offset in its unit, seconds to years, to the
    reference date; a unit of any other name is an error.
    ``mode="month_index"`` ignores the stored offsets and counts whole months
    from the reference by position; a reference inside a month rolls to the
    next first of month.
    """
    unit, reference = split_units(units)
    if mode == "month_index":
        if position is None:
            raise ValueError("month_index needs the position on the axis")
        first = F.trunc(reference, "MM")
        start = F.when(first == reference, first).otherwise(F.add_months(first, 1))
        return F.year(F.add_months(start, position.cast("int")))
    if mode != "unit":
        raise ValueError(f"unknown mode {mode!r}")
    step = F.floor(offset).cast("int")
    date = F.lit(None).cast("date")
    for word, months in _MONTHS.items():
        date = F.when(unit == word, F.add_months(reference, step * months)).otherwise(date)
    for word, days in _DAYS.items():
        date = F.when(unit == word, F.date_add(reference, step * days)).otherwise(date)
    known = [*_MONTHS, *_DAYS, *_SECONDS]
    for word, seconds in _SECONDS.items():
        days = F.floor(offset.cast("double") * seconds / 86400).cast("int")
        date = F.when(unit == word, F.date_add(reference, days)).otherwise(date)
    unknown = F.raise_error(F.concat(F.lit("unknown unit of a time axis: "), units)).cast("int")
    return F.when(unit.isin(*known) | units.isNull(), F.year(date)).otherwise(unknown)
