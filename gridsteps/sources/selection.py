"""What a filter lets a reader of flat grid files skip: files, and ranges of elements inside them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import datasource as ds

AXES = ("year", "band", "cell")
# Ranges closer than this are read as one; what lies between is masked out.
GAP_ELEMENTS = 16_384


@dataclass
class Selection:
    """Closed bounds and listed members per axis, and listed variables; no bound means everything."""

    variables: frozenset[str] | None = None
    low: dict[str, int] = field(default_factory=dict)
    high: dict[str, int] = field(default_factory=dict)
    members: dict[str, frozenset[int]] = field(default_factory=dict)

    def add(self, f: ds.Filter) -> bool:
        """Take one more filter; False when Spark has to evaluate it."""
        if isinstance(f, ds.IsNotNull):
            return f.attribute in {(a,) for a in (*AXES, "variable")}  # never null in a file
        name, value = getattr(f, "attribute", ("",))[0], getattr(f, "value", None)
        if name == "variable":
            return self._add_variables(f, value)
        if name not in AXES:
            return False
        if isinstance(f, ds.In) and all(isinstance(v, int) for v in value):
            listed = frozenset(value) & self.members.get(name, frozenset(value))
            self.members[name] = listed
            self._bound(name, min(listed, default=1), max(listed, default=0))
            return True
        if not isinstance(value, int) or isinstance(value, bool):
            return False
        bounds = {ds.EqualTo: (value, value), ds.EqualNullSafe: (value, value), ds.GreaterThan: (value + 1, None),
                  ds.GreaterThanOrEqual: (value, None), ds.LessThan: (None, value - 1), ds.LessThanOrEqual: (None, value)}
        if type(f) not in bounds:
            return False
        self._bound(name, *bounds[type(f)])
        return True

    def _add_variables(self, f: ds.Filter, value) -> bool:
        if isinstance(f, (ds.EqualTo, ds.EqualNullSafe)) and isinstance(value, str):
            listed = frozenset([value])
        elif isinstance(f, ds.In) and all(isinstance(v, str) for v in value):
            listed = frozenset(value)
        else:
            return False
        self.variables = listed if self.variables is None else self.variables & listed
        return True

    def _bound(self, name: str, low: int | None, high: int | None) -> None:
        if low is not None:
            self.low[name] = max(low, self.low.get(name, low))
        if high is not None:
            self.high[name] = min(high, self.high.get(name, high))

    @classmethod
    def of(cls, variables: Iterable[str] | None = None, years: Sequence[int] | None = None,
           bands: Sequence[int] | None = None, cells: Sequence[int] | None = None) -> "Selection":
        """From lists of variables and closed ranges of the axes."""
        own = cls(None if variables is None else frozenset(variables))
        for name, ends in (("year", years), ("band", bands), ("cell", cells)):
            if ends is not None:
                own._bound(name, *ends)
        return own

    def takes_variable(self, variable: str) -> bool:
        return self.variables is None or variable in self.variables

    def span(self, name: str, first: int, count: int) -> tuple[int, int]:
        """Offsets from ``first`` (begin, end) of what the bounds leave of an axis of ``count``."""
        begin = max(0, self.low.get(name, first) - first)
        end = min(count, self.high.get(name, first + count - 1) - first + 1)
        return begin, max(begin, end)

    def may_take_year(self, first: int, last: int) -> bool:
        begin, end = self.span("year", first, last - first + 1)
        listed = self.members.get("year")
        return begin < end and (listed is None or any(first <= y <= last for y in listed))

    def ranges(self, lay: dict) -> list[tuple[int, int]]:
        """(start, count) of the elements of one file that may pass, ascending; near ones joined.

        ``lay`` says that the file holds ``elements`` values from place ``base`` of the array
        ordered by year (from ``firstyear``), band, cell.
        """
        if not self.takes_variable(lay["variable"]):
            return []
        ncell, nbands = lay["ncell"], lay["nbands"]
        first, end = lay["base"], lay["base"] + lay["elements"]
        years = -(-end // (ncell * nbands))
        bands, cells = self.span("band", 0, nbands), self.span("cell", lay["firstcell"], ncell)
        listed = self.members.get("year")
        found: list[tuple[int, int]] = []
        for y in range(*self.span("year", lay["firstyear"], years)):
            if listed is not None and y + lay["firstyear"] not in listed:
                continue
            for b in range(*bands):
                at = (y * nbands + b) * ncell
                low, high = max(first, at + cells[0]), min(end, at + cells[1])
                if low >= high:
                    continue
                if found and low - found[-1][1] <= GAP_ELEMENTS:
                    found[-1] = found[-1][0], high
                else:
                    found.append((low, high))
        return [(low - first, high - low) for low, high in found]

    def mask(self, axes: dict[str, np.ndarray]) -> np.ndarray | None:
        """True for the elements that pass, or None when all do."""
        out = None
        for name, values in axes.items():
            for test in (
                values >= self.low[name] if name in self.low else None,
                values <= self.high[name] if name in self.high else None,
                np.isin(values, list(self.members[name])) if name in self.members else None,
            ):
                if test is not None:
                    out = test if out is None else out & test
        return None if out is None or out.all() else out


def shares(ranges: list[tuple[int, int]], k: int, n: int) -> list[tuple[int, int]]:
    """The k-th of n nearly equal parts of some element ranges."""
    total = sum(count for _, count in ranges)
    begin, end = total * k // n, total * (k + 1) // n
    out, at = [], 0
    for start, count in ranges:
        low, high = max(begin, at), min(end, at + count)
        if low < high:
            out.append((start + low - at, high - low))
        at += count
    return out
