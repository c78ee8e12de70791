"""Nothing is lost, wrapped or evaluated early without an error."""

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from gridsteps.functions.times import decode_time
from gridsteps.operators import combine, numbering, spatial, validate
from gridsteps.plans import views
from gridsteps.plans.queries import QUERIES
from gridsteps.sources import files, flatgrid, metadata
from gridsteps.streaming import steps as S

CELLS = "variable string, year int, cell long, band int, value double"


@pytest.mark.parametrize("rows,options", [
    ([("v", 2000, 1, 0, 70000.0)], {"datatype": "short"}),
    ([("v", 2000, 8, 0, 1.0)], {"datatype": "short"}),
    ([("v", 2000, 0, 1, 1.0)], {"datatype": "short", "firstcell": 1}),
    ([("v", 2000, 1, 2, 1.0)], {"datatype": "short"}),
    ([("v", 2000, None, 0, 1.0)], {"datatype": "short"}),
    ([("v", 2000, 1, 0, 1.0), ("v", 2000, 1, 0, 2.0)], {"datatype": "short"}),
    ([("v", 2000, 1, 0, 1.0), ("v", 2000, 1, 0, None)], {"datatype": "short"}),
    ([("v", 2000, 1, 0, None)], {"datatype": "byte"}),
    ([("v", 2000, 1, 0, -1.0)], {"datatype": "byte", "fill": 0}),
])
def test_flat_files_refuse(spark, tmp_path, rows, options):
    with pytest.raises(Exception):
        flatgrid.write_flat_grid(spark.createDataFrame(rows, CELLS), str(tmp_path / "o"), 8, 2, **options)


def test_flat_files_hold_every_block(spark, tmp_path):
    rows = [("v", 2000, 7, 1, 5.0), ("v", 2001, 0, 0, 6.0), ("w", 2000, 3, 0, 0.0)]
    layout = dict(ncell=8, nbands=2, datatype="byte", blockelements=3, fill=255)
    flatgrid.write_flat_grid(spark.createDataFrame(rows, CELLS), str(tmp_path / "o"), **layout)
    back = flatgrid.scan_flat_grid(spark, str(tmp_path / "o"), blocks="true", **layout)
    assert back.count() == 3 * 16
    assert {(r.variable, r.year, r.cell, r.band, r.value) for r in back.filter("value <> 255").collect()} == set(rows)
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "o" / "v" / "2000").iterdir()))
    assert np.frombuffer(whole, "u1").tolist() == [255] * 15 + [5]


def test_listing(spark, tmp_path):
    for name in ("a.txt", "b/c.txt", "b/d/e.bin", "b/_x.txt", "_hidden/f.txt", ".g"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "b/c.txt" else b"123")
    found = lambda glob: {(r.path[len(str(tmp_path)) + 1:], r.length)
                          for r in files.list_files(spark, str(tmp_path), glob).collect()}
    assert found("*") == {("a.txt", 3), ("b/c.txt", 0), ("b/d/e.bin", 3)}
    assert found("*.txt") == {("a.txt", 3), ("b/c.txt", 0)} and found("[ae].*") == {("a.txt", 3), ("b/d/e.bin", 3)}
    assert files.list_files(spark, str(tmp_path / "a.txt")).count() == 1
    with pytest.raises(Exception):
        files.list_files(spark, str(tmp_path / "none")).collect()


def test_integer_ranges(spark):
    df = spark.createDataFrame([("s", 2000, 1, 0, 70000.0), ("s", 2000, 2, 0, 7.0), ("b", 2000, 1, 0, 255.0), ("b", 2000, 2, 0, -1.0)], CELLS)
    registry = spark.createDataFrame([("s", "short"), ("b", "byte")], "variable string, datatype string")
    assert {(r.variable, r.cell) for r in validate.check_types(df, registry).collect()} == {("s", 1), ("b", 2)}


@pytest.mark.parametrize("unit,offset,year", [
    ("hours", 24 * 366.0, 2001), ("minutes", 60.0, 2000), ("seconds", -1.0, 1999), ("days", 366.0, 2001), ("weeks", 53.0, 2001)])
def test_time_units(spark, unit, offset, year):
    df = spark.createDataFrame([(offset, f"{unit} since 2000-01-01 00:00:00")], "t double, u string")
    assert df.select(decode_time(F.col("t"), F.col("u"))).first()[0] == year


def test_unknown_time_unit(spark):
    df = spark.createDataFrame([(1.0, "fortnights since 2000-01-01")], "t double, u string")
    with pytest.raises(Exception, match="unknown unit"):
        df.select(decode_time(F.col("t"), F.col("u"))).collect()


def test_labels_stay_labels(spark):
    df = spark.createDataFrame([(["1d", "nan", "2", "200.000000", "Infinity", "-1.50"], 6)], "band_names array<string>, nbands int")
    assert metadata.default_band_names(df).first().band_names == ["1d", "nan", "2", "200.0", "Infinity", "-1.5"]


def test_overlay_refuses_repeated_keys(spark):
    base = spark.createDataFrame([("v", 2000, 1, 0, 1.0)], CELLS)
    new = spark.createDataFrame([("v", 2000, 1, 0, 2.0), ("v", 2000, 1, 0, 3.0)], CELLS)
    assert combine.overlay(base, new.limit(1)).first().value == 2.0
    with pytest.raises(Exception, match="repeated key"):
        combine.overlay(base, new).collect()


def test_nearest_keeps_every_cell(spark):
    raster = spark.createDataFrame([(0.0, 0.0, 1), (2.0, 2.0, 2), (1e9, 1e9, 3)], "lon double, lat double, r int")
    cells = spark.createDataFrame([(1, 0.1, 0.1), (2, 0.1, 1.9), (3, 1.0, 1.0), (4, None, 0.0)], "cell long, lon double, lat double")
    got = {r.cell: (r.rlon, r.rlat, r.r) for r in spatial.select_nearest(raster, cells).collect()}
    assert got == {1: (0.0, 0.0, 1), 2: (0.0, 2.0, None), 3: (2.0, 2.0, 2), 4: (None, 0.0, None)}


def test_mapping_by_id_or_by_single_coordinates(spark):
    old = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 1.0, 0.0)], "cell long, lon double, lat double")
    new = spark.createDataFrame([(1, 0, 0.0, 0.0), (3, 1, 1.0, 0.0)], "cell long, new_cell long, lon double, lat double")
    assert sorted(map(tuple, spatial.cell_mapping(old, new).collect())) == [(1, 0), (3, 1)]
    with pytest.raises(Exception, match="several cells"):
        spatial.cell_mapping(old, new.drop("cell")).collect()
    assert sorted(map(tuple, spatial.cell_mapping(old.filter("cell <> 2"), new.drop("cell")).collect())) == [(1, 0), (3, 1)]


@pytest.mark.parametrize("bits", [22, 2])
def test_numbering_of_sparse_keys(spark, bits):
    keys = [-2**62, -7, 0, 5, 6, 4194304, 2**44, 2**44 + 1, 2**61]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k long")
    assert [(r.k, r.cell_index) for r in numbering.dense_index(df, "k", bits=bits).orderBy("k").collect()] == [
        (k, i) for i, k in enumerate(keys)]


def test_steps_without_rows_or_year(spark):
    schema = "variable string, cell long, band int, year int, step long, value double"
    rows = spark.createDataFrame([("v", 1, 0, 2000, 2**40, 1.0), ("v", 1, 0, None, 1, 1.0), ("v", 1, 0, 1999, 2, 1.0)], schema)
    expected = spark.createDataFrame([("v", y, 1) for y in (2000, 2001)], "variable string, year int, n long")
    got = {r.year: (r.complete, r.missing) for r in S.complete_steps(rows, expected).collect()}
    assert got == {2000: (True, 0), 2001: (False, 1)}
    accepted, late = S.route_late(rows, 2000)
    assert accepted.count() == 1 and {r.reason for r in late.collect()} == {"row without a step", "step closed, open step is 2000"}
    accepted, late = S.route_late(rows, None)
    assert accepted.count() == 2 and late.count() == 1


@pytest.mark.parametrize("name", [
    "fuzzy_match", "quantile", "steps_as_bands", "load_grid", "labels_by_crop", "labels_by_meta", "years_clamped", "calendar",
    "validate_shape", "validate_streams", "read_input", "nearest_with_holes", "densify", "cells_selected"])
def test_building_a_query_starts_no_job(spark, monkeypatch, name):
    reads, plain = [], views.table

    def counted(*args):
        reads.append(args)
        return plain(*args)

    monkeypatch.setattr(views, "table", counted)
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", "")
    try:
        QUERIES[name](spark, DATA)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= len(reads)
