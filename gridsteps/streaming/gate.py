"""Completeness of steps as streaming state.

A stream of arrivals is dealt by (variable, year, page), where a page is a part of the
keys that a variable delivers in a year, of bounded size. The state of a page holds
which of its keys have come; what is new is counted once and passed on. The state of a
year holds the counts of its variables; when none lacks a key, the year is released and
its state shrinks to a mark. Nothing that has come is read again, and a variable and year
that hold most rows are spread over as many tasks as they have pages.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

PAGE_KEYS = 4096
# What a key is made of.
_KEY = np.dtype([("cell", "<i8"), ("step", "<i8"), ("band", "<i4")])

PAGES = "variable string, year int, page long, added long, keys long, wanted string"
RELEASED = "year int, keys long, missing long"


def use_state(spark: SparkSession) -> None:
    """Settings that state of this kind needs, for queries started later in the session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Pages(StatefulProcessor):
    """Keys of a page that have come, as one sorted block of bytes; emits how many are new."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "keys binary", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        wanted, parts = None, []
        for frame in rows:
            wanted = frame["wanted"].iloc[0]
            part = np.empty(len(frame), _KEY)
            for name in _KEY.names:
                part[name] = frame[name].to_numpy()
            parts.append(part)
        held = np.frombuffer(self.seen.get()[0], _KEY) if self.seen.exists() else np.empty(0, _KEY)
        now = np.unique(np.concatenate([held, *parts]))
        if now.size > held.size:
            self.seen.update((now.tobytes(),))
            yield pd.DataFrame({"variable": [key[0]], "year": [key[1]], "page": [key[2]], "added": [now.size - held.size],
                                "keys": [now.size], "wanted": [wanted]})

    def close(self) -> None:
        pass


class _Years(StatefulProcessor):
    """Keys still missing per variable of a year; emits the year once, when there are none."""

    def __init__(self, keep_ms: int | None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", "counts string, released boolean", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        counts, released = self.counts.get() if self.counts.exists() else ("{}", False)
        if released:
            for _ in rows:
                pass
            return
        got = json.loads(counts)
        wanted: dict[str, int] = {}
        for frame in rows:
            wanted = json.loads(frame["wanted"].iloc[0])
            for variable, n in frame.groupby("variable")["added"].sum().items():
                got[variable] = got.get(variable, 0) + int(n)
        missing = sum(max(0, n - got.get(v, 0)) for v, n in wanted.items())
        if missing:
            self.counts.update((json.dumps(got), False))
        else:
            self.counts.update(("{}", True))
            yield pd.DataFrame({"year": [key[0]], "keys": [sum(got.values())], "missing": [0]}).astype({"year": "int32"})

    def close(self) -> None:
        pass


def count_keys(stream: DataFrame, expected: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """(variable, year, page, added, keys, wanted): the keys of a page that are new, whenever there are some.

    ``stream`` carries (variable, cell, band, year, step), ``expected`` (variable, year, n), one row each. Rows of
    a variable or year that is not expected are left out, as are rows without a key.
    """
    per_year = expected.groupBy("year").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
        "variable", F.col("n").cast("bigint"))))).alias("wanted"))
    pages = expected.select("variable", "year", F.greatest(F.ceil(F.col("n") / PAGE_KEYS), F.lit(1)).alias("pages")).join(per_year, "year")
    key = [F.col("cell").cast("bigint").alias("cell"), F.col("band").cast("int").alias("band"),
           F.coalesce(F.col("step").cast("bigint"), F.lit(0)).alias("step")]
    dealt = (
        stream.select("variable", F.col("year").cast("int").alias("year"), *key).filter("cell IS NOT NULL AND band IS NOT NULL")
        .join(pages, ["variable", "year"])
        .withColumn("page", F.pmod(F.xxhash64("cell", "band", "step"), F.col("pages")))
        .select("variable", "year", "page", "cell", "step", "band", "wanted")
    )
    return dealt.groupBy("variable", "year", "page").transformWithStateInPandas(
        _Pages(keep_ms), PAGES, "Update", "ProcessingTime" if keep_ms else "None")


def release_years(stream: DataFrame, expected: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """(year, keys, missing): every expected year once, in the batch that makes it complete.

    ``expected`` carries (variable, year, n): how many distinct (cell, band, step) a variable delivers in a
    year; static variables are left out of it. A key counts once however often it comes, also after a restart
    from the checkpoint. ``keep_ms`` lets state expire that long after its last change; a year must be complete
    by then. The session needs ``use_state``.
    """
    counted = count_keys(stream, expected, keep_ms)
    return counted.groupBy("year").transformWithStateInPandas(
        _Years(keep_ms), RELEASED, "Update", "ProcessingTime" if keep_ms else "None")
