"""Inputs for a set of cells, from metadata, labels and the nearest source points."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsteps.model import canonical
from gridsteps.operators.bands import label_bands
from gridsteps.operators.select import align_years, clamp_years
from gridsteps.operators.spatial import select_nearest


def read_input(values: DataFrame, variables: DataFrame, labels: DataFrame, points: DataFrame,
               cells: DataFrame, start: int | None = None, end: int | None = None,
               default_year: int = 2000, spacing: float | None = None) -> DataFrame:
    """Values of one year for every cell, as one lazy plan.

    ``values`` hold source points in ``cell``; ``points`` give (cell, lon, lat) of
    these. Years are clamped to the period of each variable, which must leave a
    single one and are then labelled alike; bands get their labels; each of
    ``cells`` takes the values of the point nearest to it, per axis. Every cell has
    a row per variable and band that occurs, with a NULL value where its point does
    not exist or lacks the value.
    """
    clamped = clamp_years(values, variables, start, end, default_year)
    labelled = align_years(label_bands(clamped, labels)).withColumnRenamed("cell", "source")
    source = points.withColumnRenamed("cell", "source")
    nearest = select_nearest(source, cells, spacing).select("cell", "source")
    # A row per variable and band; every cell is expanded by them in place.
    axes = ["variable", "band", "year", "band_label"]
    axis = labelled.select(*axes).distinct().agg(F.collect_list(F.struct(*axes))).scalar()
    wanted = nearest.select("cell", "source", F.inline(axis))
    found = labelled.select("source", "variable", "band", "value")
    return canonical(wanted.join(found, ["source", "variable", "band"], "left").drop("source"))
