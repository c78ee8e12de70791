"""Flat grid source: filters that skip files, versions, streams of writes, conversion with sidecars."""

import json

import numpy as np
import pytest
from pyspark.sql import datasource as ds, functions as F

from gridsteps.sources import convert, files, flatgrid, versions
from gridsteps.sources.selection import Selection, shares

CELLS = "variable string, year int, cell long, band int, value double"


def cube(spark, variables=("v", "w"), years=range(2000, 2006), bands=3, cells=7):
    rows = [(v, y, c, b, float(1000 * (y - 2000) + 100 * b + c + (0.5 if v == "w" else 0)))
            for v in variables for y in years for b in range(bands) for c in range(cells)]
    return spark.createDataFrame(rows, CELLS)


def as_set(df):
    return {(r.variable, r.year, r.cell, r.band, r.value) for r in df.collect()}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flat") / "o")
    flatgrid.write_flat_grid(cube(spark), path, ncell=7, nbands=3, datatype="double", blockelements=5)
    return path


FILTERS = [
    ("year = 2003", lambda v, y, c, b: y == 2003),
    ("variable = 'w' AND year BETWEEN 2001 AND 2002", lambda v, y, c, b: v == "w" and 2001 <= y <= 2002),
    ("variable IN ('v', 'x') AND cell > 4 AND band <= 1", lambda v, y, c, b: v == "v" and c > 4 and b <= 1),
    ("year IN (2000, 2005) AND cell IN (0, 6, 99)", lambda v, y, c, b: y in (2000, 2005) and c in (0, 6)),
    ("cell < 2 OR band = 2", lambda v, y, c, b: c < 2 or b == 2),
    ("NOT (year = 2000) AND band >= 2 AND value > 3000", lambda v, y, c, b: y != 2000 and b == 2 and y >= 2003),
    ("year = 1900", lambda v, y, c, b: False),
    ("year > 2001 AND year < 2001", lambda v, y, c, b: False),
    ("variable <=> 'v' AND year <=> 2004", lambda v, y, c, b: v == "v" and y == 2004),
]


@pytest.mark.parametrize("text,keep", FILTERS)
def test_filters(spark, folder, text, keep):
    wanted = {r for r in as_set(cube(spark)) if keep(*r[:4])}
    assert as_set(flatgrid.read_flat_grid(spark, folder).filter(text)) == wanted


def test_pushed_filters_are_in_the_plan(spark, folder):
    df = flatgrid.read_flat_grid(spark, folder).filter("year = 2003 AND cell > 4")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter (" not in plan  # nothing is left to filter above the scan


class Counted:
    """Counts what is opened, and the bytes read."""

    def __init__(self, monkeypatch):
        self.files, self.bytes = [], 0
        plain = flatgrid.open_path
        outer = self

        class File:
            def __init__(self, f):
                self.f = f

            def __enter__(self):
                self.f.__enter__()
                return self

            def __exit__(self, *args):
                return self.f.__exit__(*args)

            def seek(self, n):
                return self.f.seek(n)

            def read(self, n):
                outer.bytes += n
                return self.f.read(n)

        class System:
            def __init__(self, system):
                self.system = system

            def open_input_file(self, name):
                outer.files.append(name)
                return File(self.system.open_input_file(name))

        monkeypatch.setattr(flatgrid, "open_path", lambda p: (System(plain(p)[0]), plain(p)[1]))


def read_with(reader, filters):
    left = list(reader.pushFilters(filters))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    return left, rows


def test_files_opened(folder, monkeypatch):
    seen = Counted(monkeypatch)
    left, rows = read_with(flatgrid.FlatGridReader({"path": folder}), [])
    assert len(rows) == 2 * 6 * 21 and len(seen.files) == 2 * 6 * 5
    seen.files.clear()
    filters = [ds.EqualTo(("variable",), "v"), ds.EqualTo(("year",), 2003), ds.GreaterThan(("value",), 1.0), ds.IsNotNull(("year",))]
    left, rows = read_with(flatgrid.FlatGridReader({"path": folder}), filters)
    assert left == [filters[2]] and len(rows) == 21 and len(seen.files) == 5
    seen.files.clear()
    # Cell 0 of band 0 lies in the first block of a year only.
    filters = [ds.EqualTo(("cell",), 0), ds.EqualTo(("band",), 0), ds.In(("year",), (2001, 2002)), ds.In(("variable",), ("w",))]
    left, rows = read_with(flatgrid.FlatGridReader({"path": folder}), filters)
    assert not left and [r["value"] for r in rows] == [1000.5, 2000.5] and len(seen.files) == 2


def test_parts_are_left_out_when_planning(folder):
    reader = flatgrid.FlatGridReader({"path": folder})
    every = len(reader.partitions())
    reader.pushFilters([ds.EqualTo(("variable",), "none")])
    assert every >= 1 and [p.count for p in reader.partitions()] == [0]


def test_foreign_file_with_filter(spark, tmp_path, monkeypatch):
    values = np.arange(8 * 2 * 5, dtype="<i2")
    (tmp_path / "x.bin").write_bytes(values.tobytes())
    options = dict(datatype="short", ncell=5, nbands=2, firstyear=2000)
    df = flatgrid.read_flat_grid(spark, str(tmp_path), **options).filter("year BETWEEN 2003 AND 2004 AND cell = 4")
    assert sorted(r.value for r in df.collect()) == [34.0, 39.0, 44.0, 49.0]
    assert flatgrid.read_flat_grid(spark, str(tmp_path), **options).filter("variable = 'y'").count() == 0
    listed = flatgrid.scan_flat_grid(spark, str(tmp_path), years=(2003, 2004), cells=(4, 4), **options)
    assert sorted(r.value for r in listed.collect()) == [34.0, 39.0, 44.0, 49.0]
    monkeypatch.setattr("gridsteps.sources.selection.GAP_ELEMENTS", 0)
    seen = Counted(monkeypatch)
    filters = [ds.EqualTo(("year",), 2003), ds.GreaterThanOrEqual(("cell",), 3)]
    _, rows = read_with(flatgrid.FlatGridReader({"path": str(tmp_path)} | {k: str(v) for k, v in options.items()}), filters)
    assert len(rows) == 4 and seen.bytes == 8  # of 160


def test_shares_cut_ranges_evenly():
    ranges = [(0, 10), (20, 5), (40, 7)]
    parts = [shares(ranges, k, 4) for k in range(4)]
    assert sorted(x for p in parts for s, n in p for x in range(s, s + n)) == [x for s, n in ranges for x in range(s, s + n)]
    assert {sum(n for _, n in p) for p in parts} == {5, 6}


def test_selection_of_ranges(monkeypatch):
    monkeypatch.setattr("gridsteps.sources.selection.GAP_ELEMENTS", 0)
    lay = {"variable": "v", "ncell": 4, "nbands": 2, "firstcell": 10, "firstyear": 2000, "base": 6, "elements": 12}
    every = Selection()
    assert every.ranges(lay) == [(0, 12)]
    own = Selection.of(years=(2000, 2001), bands=(1, 1), cells=(11, 12))
    # Places 5 and 6 of year 2000, of which the file holds 6, and 13 and 14 of year 2001.
    assert own.ranges(lay) == [(0, 1), (7, 2)]
    assert Selection.of(["w"]).ranges(lay) == [] and Selection.of(cells=(0, 9)).ranges(lay) == []


def test_block_size_may_change(spark, tmp_path):
    path = str(tmp_path / "o")
    values = cube(spark, ["v"], range(2000, 2003))
    layout = dict(ncell=7, nbands=3, datatype="float")
    flatgrid.write_flat_grid(values, path, blockelements=2, **layout)
    later = values.filter("year > 2000").withColumn("value", F.col("value") + 1)
    flatgrid.write_flat_grid(later, path, blockelements=20, **layout)
    both = as_set(values.filter("year = 2000").unionByName(later))
    assert as_set(flatgrid.read_flat_grid(spark, path)) == both
    newest = versions.newest(path)
    assert newest["number"] == 2 and [w["number"] for w in newest["writes"]] == [1, 2]
    flatgrid.write_flat_grid(values, path, mode="overwrite", blockelements=3, **layout)
    assert as_set(flatgrid.read_flat_grid(spark, path)) == as_set(values) and len(versions.newest(path)["writes"]) == 1
    # A write that replaces all that is left of an earlier one drops it.
    flatgrid.write_flat_grid(later, path, **layout)
    flatgrid.write_flat_grid(later, path, **layout)
    assert [w["number"] for w in versions.newest(path)["writes"]] == [3, 5]


def test_failed_write_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "o")
    values = cube(spark, ["v"], [2000])
    layout = dict(ncell=7, nbands=3, datatype="short")
    flatgrid.write_flat_grid(values, path, **layout)
    before = as_set(flatgrid.read_flat_grid(spark, path))
    with pytest.raises(Exception):
        flatgrid.write_flat_grid(values.withColumn("value", F.when(F.col("cell") == 6, 1e6).otherwise(1.0)), path, **layout)
    (tmp_path / "o" / "v" / "2000" / "00000000-left.bin").write_bytes(b"\x01")
    assert as_set(flatgrid.read_flat_grid(spark, path)) == before and versions.newest(path)["number"] == 1


def test_stream_of_writes_and_replay(spark, tmp_path):
    path = str(tmp_path / "o")
    layout = dict(ncell=7, nbands=3, datatype="double", blockelements=5)
    assert versions.newest(path) is None
    reader = flatgrid.FlatGridStreamReader({"path": path, "progress": str(tmp_path / "done.json")})
    assert reader.initialOffset() == reader.latestOffset() == {"version": 0} and reader.partitions({"version": 0}, {"version": 0}) == []

    def between(start, end):
        return {(r["variable"], r["year"], r["value"]) for p in reader.partitions({"version": start}, {"version": end})
                for b in reader.read(p) for r in b.to_pylist()}

    values = cube(spark, ["v"], range(2000, 2004))
    flatgrid.write_flat_grid(values.filter("year < 2002"), path, **layout)
    first = between(0, 1)
    changed = values.filter("year > 2000").withColumn("value", -F.col("value"))
    flatgrid.write_flat_grid(changed, path, **layout)
    assert reader.latestOffset() == {"version": 2} and between(0, 1) == first and len(first) == 42
    assert {y for _, y, _ in between(1, 2)} == {2001, 2002, 2003} and all(v <= 0 for _, _, v in between(1, 2))
    reader.commit({"version": 2})
    assert json.loads((tmp_path / "done.json").read_text()) == {"version": 2}

    def run():
        flatgrid.stream_flat_grid(spark, path).writeStream.format("parquet").option("path", str(tmp_path / "rows")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(str(tmp_path / "rows")).count()

    assert run() == 84 and run() == 84
    flatgrid.write_flat_grid(values.filter("year = 2003"), path, **layout)
    assert run() == 84 + 21


def test_convert_raw_with_sidecars(spark, tmp_path):
    path = str(tmp_path / "o")
    values = cube(spark, ["v", "w", "grid"], [2000, 2001])
    schema = ("variable string, firstcell int, ncell int, nbands int, datatype string, unit string, band_names array<string>, "
              "ref_area struct<filename:string,format:string>, _private int")
    area = ("terr_area.nc4.json", "meta")
    sidecars = spark.createDataFrame([("v", 0, 7, 3, "short", "kg", ["a", "b", "c"], area, 1),
                                      ("w", None, 7, 3, "3", "m", None, None, 1)], schema)
    catalog = spark.createDataFrame([("v", "cdf"), ("w", "cdf"), ("grid", "cdf"), ("x", "raw")], "name string, fmt string")
    convert.convert_raw(values, catalog, sidecars, path, blockelements=4)
    assert as_set(flatgrid.read_flat_grid(spark, path)) == as_set(values.filter("variable <> 'grid'"))
    got = {r.variable: r for r in flatgrid.read_sidecars(spark, path).collect()}
    assert set(got) == {"v", "w"} and got["v"].band_names == ["a", "b", "c"] and got["w"].band_names == ["0", "1", "2"]
    assert (got["v"].format, got["v"].filename, got["v"].unit, got["v"].datatype, got["w"].datatype) == ("raw", "v.bin", "kg", "short", "float")
    assert got["v"].ref_area.filename == "terr_area.bin.json" and got["w"].firstcell == 0
    # One variable again, as another type: its sidecar goes with it.
    wide = sidecars.filter("variable = 'v'").withColumn("datatype", F.lit("int"))
    convert.convert_raw(values.withColumn("value", F.col("value") * 100), catalog, wide, path, ids="v", blockelements=9)
    back = flatgrid.read_flat_grid(spark, path)
    assert back.filter("variable = 'v' AND year = 2001").agg(F.max("value")).first()[0] == 120600.0
    assert as_set(back.filter("variable = 'w'")) == as_set(values.filter("variable = 'w'"))
    assert {r.datatype for r in flatgrid.read_sidecars(spark, path).filter("variable = 'v'").collect()} == {"int"}
    with pytest.raises(Exception, match="no layout"):
        convert.convert_raw(values, catalog, sidecars.filter("variable = 'w'"), str(tmp_path / "p"))
    with pytest.raises(Exception, match="repeated key"):
        convert.convert_raw(values, catalog, sidecars.unionByName(sidecars), str(tmp_path / "q"))


def test_listing_goes_down_in_bounded_batches(spark, tmp_path, monkeypatch):
    names = [f"{a}/{b}/{c}/{i}.bin" for a in "xy" for b in "pq" for c in "rs" for i in range(5)] + [f"{i}.bin" for i in range(11)]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"1" * (len(name) % 3))
    monkeypatch.setattr(files, "LISTED_ROWS", 4)
    got = {(r.path[len(str(tmp_path)) + 1:], r.length) for r in files.list_files(spark, str(tmp_path)).collect()}
    assert got == {(n, len(n) % 3) for n in names}
    assert {r.path for r in files.list_files(spark, f"file://{tmp_path}", "3.bin").collect()} == {
        f"file://{tmp_path}/{n}" for n in names if n.endswith("/3.bin") or n == "3.bin"}
