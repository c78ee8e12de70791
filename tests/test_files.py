import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsteps.sources import convert, files, flatgrid, grid, metadata


def header(name=b"LPJTEST", version=3, mark="<", ncell=21, nbands=1, datatype=0, firstyear=1901, nyear=1):
    data = name + struct.pack(mark + "7i", version, 1, firstyear, nyear, 0, ncell, nbands)
    if version >= 2:
        data += struct.pack(mark + "2f", 0.5, 1.0)
    if version >= 3:
        data += struct.pack(mark + "fi", 0.5, datatype)
    if version >= 4:
        data += struct.pack(mark + "2i", 12, 1)
    return data


def test_header_catalog(spark, tmp_path):
    (tmp_path / "a.clm").write_bytes(header() + bytes(21))
    (tmp_path / "b.clm").write_bytes(header(b"LPJTEST", 2, ">"))
    (tmp_path / "c.clm").write_bytes(header(b"LPJRESTART"))
    (tmp_path / "d.clm").write_bytes(b"NOPE" + bytes(60))
    (tmp_path / "e.clm").write_bytes(header(version=4))
    (tmp_path / "f.clm").write_bytes(b"LPJTEST\x01\x00")
    (tmp_path / "g.clm").write_bytes(header(version=7))
    got = {r.path[-5]: r for r in files.header_catalog(spark, str(tmp_path)).collect()}
    a = got["a"]
    assert (a.name, a.version, a.endian, a.order, a.firstyear, a.nyear, a.firstcell, a.ncell) == (
        "LPJTEST", 3, "little", 1, 1901, 1, 0, 21)
    assert (a.nbands, a.cellsize_lon, a.scalar, a.cellsize_lat, a.datatype, a.nstep, a.timestep) == (
        1, 0.5, 1.0, 0.5, 0, 1, 1)
    assert a.header_bytes == 51 and a.lastyear == 1901 and a.error is None and a.length == 72
    assert (got["b"].header_bytes, got["b"].endian, got["b"].datatype) == (43, "big", 1)
    assert got["c"].error and got["d"].error and got["f"].error and got["g"].header_bytes is None
    assert (got["e"].header_bytes, got["e"].nstep) == (59, 12)
    forced = {r.path[-5]: r for r in files.header_catalog(spark, str(tmp_path), "a*", 1).collect()}
    assert forced["a"].version == 1 and forced["a"].header_bytes == 35
    meta = files.header_metadata(files.header_catalog(spark, str(tmp_path)))
    assert meta.count() == 3 and meta.filter("band_names is not null").count() == 0


def test_inventory(spark, tmp_path):
    content = {"clm": b"LPJTEST", "cdf1": b"CDF\x01", "cdf2": b"\x89HDF\r\n\x1a\nxx", "meta": b' \n{"a": 1}',
               "text1": b"year,cell\n", "text2": b"", "raw1": b"\x07\x0b", "raw2": "é{".encode()}
    for name, data in content.items():
        (tmp_path / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: r.io_type for r in files.inventory_files(spark, str(tmp_path)).collect()}
    assert got == {n: n.rstrip("12") for n in content}


def test_flat_scan(spark, tmp_path):
    data = np.array([7] * 19 + [200, 1], dtype="u1")
    (tmp_path / "soil.bin").write_bytes(data.tobytes())
    df = flatgrid.scan_flat_grid(spark, str(tmp_path / "soil.bin"), datatype="byte", ncell=21)
    assert df.count() == 21 and df.agg(F.sum("value")).first()[0] == 334.0
    assert df.filter("cell = 19").first().value == 200.0


def test_flat_scan_with_header_in_ranges(spark, tmp_path, monkeypatch):
    values = np.arange(3 * 2 * 5, dtype=">f4")
    (tmp_path / "x.clm").write_bytes(
        header(version=4, mark=">", ncell=5, nbands=2, datatype=3, firstyear=2000, nyear=3) + values.tobytes())
    monkeypatch.setattr(flatgrid, "READ_ELEMENTS", 7)
    df = flatgrid.scan_flat_grid(spark, str(tmp_path), header="true")
    got = {(r.year, r.band, r.cell): r.value for r in df.collect()}
    assert got == {(2000 + i // 10, i // 5 % 2, i % 5): float(i) for i in range(30)}


def test_flat_scan_rejects(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(bytes(7))
    for options in ({"datatype": "short"}, {"datatype": "byte", "ncell": 5}, {"order": "cellseq"}, {"datatype": "?"}):
        with pytest.raises(Exception):
            flatgrid.scan_flat_grid(spark, str(tmp_path), **options).collect()


def test_flat_write_blocks(spark, tmp_path):
    rows = [("v", y, c, b, float(y * 100 + b * 10 + c)) for y in (2000, 2001) for b in range(3) for c in range(7)
            if (b, c) != (1, 2)]
    values = spark.createDataFrame(rows, "variable string, year int, cell long, band int, value double")
    values = values.withColumn("value", F.when(F.col("cell") != 6, F.col("value")))
    layout = dict(ncell=7, nbands=3, datatype="int", blockelements=4)
    flatgrid.write_flat_grid(values, str(tmp_path / "o"), **layout)
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "o" / "v" / "2001").iterdir()))
    expected = [-9999 if c == 6 or (b, c) == (1, 2) else 200100 + b * 10 + c for b in range(3) for c in range(7)]
    assert np.frombuffer(whole, "<i4").tolist() == expected
    back = flatgrid.scan_flat_grid(spark, str(tmp_path / "o"), blocks="true", **layout)
    assert back.count() == 42
    assert back.filter("year = 2000 and band = 2 and cell = 3").first().value == 200023.0


def sidecar(**more):
    return {"variable": "v", "nbands": 2, "cellsize_lon": 0.5, "cellsize_lat": 0.5, "datatype": "float", **more}


def test_load_metadata(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(sidecar(variable="a"), indent=2))
    (tmp_path / "b.json").write_text('{"variable": "b", "nbands": 2,\n "band_names": [200.000000, 500.000000]}')
    (tmp_path / "c.json").write_text(json.dumps(sidecar(
        variable="c", nbands=0, global_attrs={"comment": "check"}, ref_area={"filename": "x.json", "format": "meta"}), indent=1))
    got = {r.variable: r for r in metadata.load_metadata(spark, str(tmp_path)).collect()}
    assert got["a"].band_names == ["0", "1"] and got["b"].band_names == ["200.0", "500.0"]
    assert got["c"].band_names == [] and got["c"].global_attrs.comment == "check"
    assert got["c"].ref_area.filename == "x.json" and got["a"].path.endswith("a.json")


def test_write_metadata_hides_private(spark, tmp_path):
    df = spark.createDataFrame([("v", 1)], "variable string, _n int")
    metadata.write_metadata(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).columns == ["variable"]
    assert json.loads(metadata.as_json(df).first().json) == {"variable": "v"}


def test_merge_metadata(spark):
    area = "ref_area struct<filename:string,format:string>"
    target = spark.createDataFrame([("v", None, ["t"], ("old.json", "meta"))],
                                   f"variable string, unit string, band_names array<string>, {area}")
    source = spark.createDataFrame([("v", "kg", ["s"], ("terr.x.nc4.json", "meta"), "l")],
                                   f"variable string, unit string, band_names array<string>, {area}, long_name string")
    row = metadata.merge_metadata(target, source).first()
    assert (row.unit, row.band_names, row.long_name) == ("kg", ["s"], "l")
    assert row.ref_area.filename == "terr.bin.json"


def test_catalogs(spark, tmp_path):
    config = {
        "outputvar": [{"id": 0, "name": "grid", "var": "g", "unit": ""}, {"id": 5, "name": "npp", "var": "n", "unit": "g"}],
        "output": [{"id": "grid", "file": {"fmt": "cdf", "name": "grid.nc4", "socket": True}},
                   {"id": "npp", "file": {"fmt": "cdf", "name": "npp.nc4"}}],
        "input": {"soil": {"id": 0, "fmt": "clm", "name": "s.clm"}, "tillage": {"id": 7, "fmt": "clm", "name": "t", "socket": True}},
    }
    (tmp_path / "c.json").write_text(json.dumps(config, indent=2))
    df = metadata.read_config(spark, str(tmp_path))
    assert {r.name for r in metadata.catalog_available(df).collect()} == {"grid", "npp"}
    assert metadata.catalog_outputs(df, fmt="raw").count() == 0
    coupled = metadata.catalog_outputs(df, coupled=True).collect()
    assert [(r.name, r["index"]) for r in coupled] == [("grid", 0)]
    assert [r.name for r in metadata.catalog_inputs(df, coupled=True).collect()] == ["tillage"]
    assert [r.name for r in convert.convertible(metadata.catalog_outputs(df)).collect()] == ["npp"]
    assert convert.convertible(metadata.catalog_outputs(df), "soilc").count() == 0


def test_load_grid(spark, tmp_path):
    table = spark.createDataFrame(
        [(0.25, 50.25, 0, d, float(d)) for d in (200, 500)] + [(0.25, 50.25, 366, 200, 9.0)],
        "lon double, lat double, time int, depth int, soilc double")
    table.write.parquet(str(tmp_path / "g"))
    df = grid.load_grid(spark, str(tmp_path / "g"), ["soilc"], units="days since 2000-01-01")
    assert sorted((r.variable, r.band, r.year, r.value) for r in df.collect()) == [
        ("soilc", 0, 2000, 200.0), ("soilc", 0, 2001, 9.0), ("soilc", 1, 2000, 500.0)]
    months = grid.shape_grid(table, ["soilc"], "years since 2000-12-01", "month_index")
    assert {r.year for r in months.collect()} == {2000, 2001}
    plain = grid.shape_grid(table.drop("depth").withColumn("b", F.lit(1.0)), ["soilc", "b"])
    assert {r.band for r in plain.collect()} == {0} and plain.count() == 6
    with pytest.raises(ValueError):
        grid.shape_grid(table.withColumn("x", F.lit(1)), ["soilc"])


def test_conversion_leaves_values_where_they_are(spark, tmp_path, monkeypatch):
    """No task gathers the rows of a variable before the files are cut."""
    values = spark.range(2000).repartition(8).selectExpr(
        "IF(id % 10 = 0, 'price', 'quantity') AS variable", "id AS cell", "0 AS band", "2000 AS year", "id * 1.0D AS value")
    catalog = spark.createDataFrame([("quantity", "cdf"), ("quantity", "cdf"), ("price", "raw"), (None, "cdf")], "name string, fmt string")
    spread, hint = [], type(values).hint

    def watched(df, name, *columns):
        spread.append(df.select(F.spark_partition_id()).distinct().count())
        return hint(df, name, *columns)

    monkeypatch.setattr(type(values), "hint", watched)
    convert.convert_format(values, str(tmp_path / "p"), variables=convert.convertible(catalog))
    assert spread == [8]
    back = grid.load_values(spark, str(tmp_path / "p")).select("variable", "cell", "band", "year", "value")
    assert sorted(back.collect()) == sorted(values.filter("variable = 'quantity'").collect())
