import datetime
import math

import pytest
from pyspark.sql import functions as F

from gridsteps.functions.missing import cast_by_datatype
from gridsteps.functions.times import decode_time, year_end
from gridsteps.model import canonical
from gridsteps.operators import bands as B
from gridsteps.operators import combine, cube, select
from gridsteps.operators import reduce as R

VALUES = "variable string, cell long, band int, year int, value double"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_canonical(spark):
    df = spark.createDataFrame([(1.5, 7, "x", 2000)], "v float, id int, note string, year long")
    out = canonical(df, {"v": "value", "id": "cell"})
    assert out.dtypes == [("cell", "bigint"), ("band", "int"), ("year", "int"),
                          ("value", "double"), ("note", "string")]


@pytest.mark.parametrize("start,end,expected", [
    (2005, 2015, (2005, 2015)), (1980, 1998, (2000, 2000)), (2024, 2025, (2022, 2022)),
    (1998, 2025, (2000, 2022)), (1998, 2020, (2000, 2020)), (2020, 2025, (2020, 2022)),
    (None, 2024, (2022, 2022)), (1998, None, (2000, 2022)), (None, None, (2022, 2022))])
def test_clamped_bounds(spark, start, end, expected):
    lo, hi = select.clamped_bounds(F.lit(2000), F.lit(2022), start, end, 2022)
    assert tuple(spark.range(1).select(lo, hi).first()) == expected


def test_clamped_bounds_reversed():
    with pytest.raises(ValueError):
        select.clamped_bounds(None, None, 2025, 1998, 2022)


def test_select_years_open_ends(spark):
    df = spark.range(1990, 2000).select(F.col("id").cast("int").alias("year"))
    assert select.select_years(df, 1995).count() == 5
    assert select.select_years(df, None, 1995).count() == 6
    assert select.select_years(df).count() == 10


def test_align_years(spark):
    df = spark.createDataFrame([("a", 1, 0, 2001, 1.0), ("b", 1, 0, 2003, 2.0)], VALUES)
    assert rows(select.align_years(df), "variable", "year") == [("a", 2003), ("b", 2003)]
    bad = df.unionByName(df.withColumn("year", F.lit(1999)))
    with pytest.raises(Exception):
        select.align_years(bad).collect()


def test_calendar(spark):
    years = select.year_calendar(spark, 2020, 2022, 2024)
    assert rows(years, "year", "phase") == [
        (2020, "historic"), (2021, "historic"), (2022, "coupled"), (2023, "coupled"), (2024, "coupled")]
    assert select.year_calendar(spark, 2020, 2022, 2024, "historic").count() == 2
    assert select.year_calendar(spark, 2051, 2023, 2050).count() == 0
    assert select.year_calendar(spark, 2023, 2023, 2050, "historic").count() == 0
    with pytest.raises(ValueError):
        select.year_calendar(spark, 2023, 2023, 2050, "historic", match_period=True)
    with pytest.raises(ValueError):
        select.year_calendar(spark, 2022, 2023, 2050, "coupled", match_period=True)
    assert select.year_calendar(spark, 2022, 2023, 2025, "coupled").count() == 4


def test_cells(spark):
    assert rows(select.cell_range(spark, 27410, 27411), "cell") == [(27410,), (27411,)]
    assert rows(select.cell_range(spark, 27410, 27411, by_id=False), "cell_index") == [(0,), (1,)]
    meta = spark.createDataFrame([(21,)], "ncell int")
    assert tuple(select.resolve_cell_range(meta, "all", "all").first()) == (0, 20)
    assert tuple(select.resolve_cell_range(meta, 3, 5).first()) == (3, 5)


def test_band_labels_from_names(spark):
    meta = spark.createDataFrame(
        [("grid", 2, None), ("soil", 3, ["a", "b", "c"]), ("odd", 2, ["a"]), ("one", 1, ["x"]),
         ("header", 2, None)], "variable string, nbands int, band_names array<string>")
    assert rows(B.band_labels_from_names(meta), "variable", "band", "band_label") == [
        ("grid", 0, "lon"), ("grid", 1, "lat"), ("header", 0, "1"), ("header", 1, "2"),
        ("odd", 0, "1"), ("odd", 1, "2"), ("soil", 0, "a"), ("soil", 1, "b"), ("soil", 2, "c")]


def test_crop_labels(spark):
    crops = spark.createDataFrame([(1, "rice"), (0, "maize")], "pos int, crop string")
    uses = spark.createDataFrame([(i, f"u{i}") for i in range(5)], "pos int, crop string")
    counts = spark.createDataFrame(
        [("a", 4), ("b", 8), ("c", 12), ("d", 6), ("e", 20), ("f", 7), ("g", 1)], "variable string, nbands int")
    got = {}
    for v, _, label in rows(B.crop_band_labels(counts, crops, uses), "variable", "band", "band_label"):
        got.setdefault(v, []).append(label)
    assert got["a"] == ["rainfed maize", "rainfed rice", "irrigated maize", "irrigated rice"]
    assert got["b"][2] == "surface irrigated maize" and got["b"][-1] == "drip irrigated rice"
    assert got["c"] == [str(i) for i in range(1, 13)] and got["g"] == ["1"]
    assert got["d"] == [str(i) for i in range(6)]  # three systems: unchanged
    assert got["f"] == [str(i) for i in range(7)]  # no rule: unchanged
    # 20 is a multiple of the two crops first, which gives ten systems: unchanged
    assert got["e"] == [str(i) for i in range(20)]


def test_steps_to_bands(spark):
    df = spark.createDataFrame(
        [("m", 1, 0, 2000, 1, 10.0), ("m", 1, 0, 2000, 3, 30.0), ("m", 2, 0, 2000, 3, 31.0),
         ("m", 2, 0, 2000, 7, 70.0), ("y", 1, 4, 2000, 1, 5.0)],
        "variable string, cell long, band int, year int, step int, value double")
    # cell 2 lacks the first step, its bands must not move
    assert rows(B.steps_to_bands(df), "variable", "cell", "band", "value") == [
        ("m", 1, 0, 10.0), ("m", 1, 1, 30.0), ("m", 2, 1, 31.0), ("m", 2, 2, 70.0), ("y", 1, 4, 5.0)]
    bad = df.withColumn("band", F.col("cell").cast("int"))
    assert rows(B.subannual_violations(bad), "variable") == [("m",)]
    with pytest.raises(Exception):
        B.steps_to_bands(bad).collect()


def test_select_variable_strips_suffix(spark):
    df = spark.createDataFrame([("a", 1, 0, 1.0), ("b", 1, 3, 2.0)],
                               "variable string, cell long, `band (a)` int, value double")
    assert B.select_variable(df, "a").columns == ["variable", "cell", "band", "value"]


def test_metadata_rules(spark):
    values = spark.createDataFrame([("a", 1, 0, 2000, 1.0)], VALUES)
    meta = spark.createDataFrame(
        [("a", "long", "u", "s", "h", 0.5, 0.25, ("i", "c", "check"))],
        "variable string, long_name string, unit string, source string, history string, "
        "cellsize_lon double, cellsize_lat double, "
        "global_attrs struct<institution:string,contact:string,comment:string>")
    with pytest.raises(Exception):
        cube.attach_metadata(values, meta).collect()
    row = cube.attach_metadata(values, meta, strict=False).first()
    assert row.cellsize is None and row.comment == "check" and row.standard_name == "a"


def test_densify(spark):
    cells = spark.createDataFrame([(1,), (2,)], "cell long")
    bands = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "variable string, band int")
    values = spark.createDataFrame([("a", 1, 1, 2001, 5.0)], VALUES)
    dense = cube.densify(values, cells, bands, ["a", "b"], (2000, 2002))
    assert dense.count() == 2 * 3 * 3
    assert rows(dense.filter("value is not null"), *values.columns) == [("a", 1, 1, 2001, 5.0)]
    static = cube.densify(values, cells, bands, ["a"], None)
    assert static.columns == ["variable", "cell", "band", "value"] and static.count() == 4


def test_missing_values(spark):
    meta = spark.createDataFrame([("i", "short"), ("f", "3")], "variable string, datatype string")
    values = spark.createDataFrame(
        [("i", 1, 0, 2000, -9999.0), ("i", 2, 0, 2000, 4.0), ("f", 1, 0, 2000, -9999.0),
         ("f", 2, 0, 2000, float("nan"))], VALUES)
    plain = cube.decode_missing_values(values, meta)
    assert rows(plain.filter("value is null"), "variable", "cell") == [("f", 2), ("i", 1)]
    back = {(r.variable, r.cell): r.value for r in cube.encode_missing_values(plain, meta).collect()}
    assert back["i", 1] == -9999.0 and back["f", 1] == -9999.0 and math.isnan(back["f", 2])


def test_cast_by_datatype(spark):
    cases = [(200.0, "byte", 200.0), (-1.0, "0", None), (40000.0, "short", None), (1.7, "int", 1.0),
             (0.1, "float", 0.10000000149011612), (0.1, "4", 0.1), (0.1, "half", None)]
    df = spark.createDataFrame([c[:2] for c in cases], "v double, t string")
    got = [r[0] for r in df.select(cast_by_datatype(F.col("v"), F.col("t"))).collect()]
    assert got == [c[2] for c in cases]


def test_scalar_only_static(spark):
    meta = spark.createDataFrame([("terr_area", 10.0), ("npp", 10.0)], "variable string, scalar double")
    values = spark.createDataFrame([("terr_area", 1, 0, 2000, 1.0), ("npp", 1, 0, 2000, 1.0)], VALUES)
    got = dict(rows(cube.apply_scalar(values, meta, only_static=True), "variable", "value"))
    assert got == {"terr_area": 10.0, "npp": 1.0}


def test_wide_long_identity(spark):
    values = spark.createDataFrame(
        [("a", 1, 0, 2000, 1.0), ("b", 1, 0, 2000, 2.0), ("b", 2, 0, 2001, 3.0)], VALUES)
    back = cube.to_long(cube.to_wide(values, ["a", "b"]), ["a", "b"])
    assert rows(back, *values.columns) == rows(values, *values.columns)
    split = cube.split_variables(values, ["a", "b"])
    assert split["a"].count() == 1 and split["b"].count() == 2


def test_decode_time(spark):
    def year(offset, units, position=None, mode="unit"):
        cols = decode_time(F.lit(offset), F.lit(units),
                           None if position is None else F.lit(position), mode)
        return spark.range(1).select(cols).first()[0]

    assert year(366, "days since 2000-01-01") == 2001
    assert year(25, "months since 2000-01-01 00:00:00") == 2002
    assert year(5, "years since 1901-1-1") == 1906
    # the stored offset is ignored: position 12 after a rolled start
    assert year(0, "years since 2000-01-15", 11, "month_index") == 2001
    assert year(0, "years since 2000-01-01", 11, "month_index") == 2000
    assert spark.range(1).select(year_end(F.lit(2022))).first()[0] == datetime.date(2022, 12, 31)


def test_overlay(spark):
    base = spark.createDataFrame([("a", 1, 0, 2000, 1.0), ("a", 2, 0, 2000, 2.0)], VALUES)
    new = spark.createDataFrame([("a", 1, 0, 2000, None), ("a", 9, 0, 2000, 9.0)], VALUES)
    assert {r.cell: r.value for r in combine.overlay(base, new).collect()} == {1: None, 2: 2.0}


def test_compare_runs(spark):
    a = spark.createDataFrame([("x", 1, 0, 2000, 1.0), ("y", 1, 0, 2000, 1.0), ("z", 1, 0, 2000, float("nan"))], VALUES)
    b = spark.createDataFrame([("x", 1, 0, 2000, 1.000001), ("y", 2, 0, 2000, 1.0), ("z", 1, 0, 2000, float("nan"))], VALUES)
    got = {r.variable: (r.all_close, r.one_sided) for r in combine.compare_runs(a, b).collect()}
    assert got == {"x": (True, 0), "y": (False, 2), "z": (False, 0)}


def test_write_years_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    values = spark.createDataFrame([("a", 1, 0, 2000, 1.0), ("a", 1, 0, 2001, 2.0)], VALUES)
    combine.write_years(values, path)
    for _ in range(2):
        combine.write_years(values.filter("year = 2001").withColumn("value", F.lit(7.0)), path)
    assert rows(spark.read.parquet(path), "year", "value") == [(2000, 1.0), (2001, 7.0)]


def test_inherit_attributes(spark):
    meta = spark.createDataFrame([(1, "b", "h2", 0.5), (0, "a", None, 0.25)],
                                 "pos int, source string, history string, cellsize double")
    assert tuple(combine.inherit_attributes(meta).first()) == ("a", None, 0.25)


SERIES = [("a", 1, 0, 2000 + i, v) for i, v in enumerate([1.0, None, 3.0, 4.0, 8.0])]


@pytest.mark.parametrize("fn,expected", [
    (lambda d: R.rolling(d, 2), [None, None, None, 3.5, 6.0]),
    (lambda d: R.shift(d), [None, 1.0, None, 3.0, 4.0]),
    (lambda d: R.shift(d, -1), [None, 3.0, 4.0, 8.0, None]),
    (lambda d: R.diff(d), [None, None, 1.0, 4.0]),
    (lambda d: R.cumsum(d), [1.0, 1.0, 4.0, 8.0, 16.0]),
    (lambda d: R.ffill(d), [1.0, 1.0, 3.0, 4.0, 8.0]),
    (lambda d: R.fillna(d, 0), [1.0, 0.0, 3.0, 4.0, 8.0]),
    (lambda d: R.where(d, F.col("value") > 3), [None, None, None, 4.0, 8.0]),
])
def test_series(spark, fn, expected):
    df = spark.createDataFrame(SERIES, VALUES)
    assert [r.value for r in fn(df).orderBy("year").collect()] == expected


@pytest.mark.parametrize("how,expected", [
    ("mean", 4.0), ("sum", 16.0), ("min", 1.0), ("max", 8.0), ("count", 4), ("std", 2.5495097567963922)])
def test_reduce(spark, how, expected):
    df = spark.createDataFrame(SERIES, VALUES)
    assert R.reduce_dims(df, ["year"], how).first().value == pytest.approx(expected)
    dim = spark.createDataFrame([(1, "here")], "cell long, label string")
    got = R.reduce_by_label(df, dim, ["cell"], "label", over=("cell", "year"), how=how).first()
    assert got.label == "here" and got.value == pytest.approx(expected)


def test_weighted_mean_skips_missing(spark):
    df = spark.createDataFrame([("a", 1, 0, 2000, 2.0), ("a", 2, 0, 2000, None), ("a", 3, 0, 2000, 5.0)], VALUES)
    w = spark.createDataFrame([(1, 1.0), (2, 100.0), (3, 2.0)], "cell long, weight double")
    assert R.weighted_mean(df, w, ["variable"]).first().value == 4.0


@pytest.mark.parametrize("q", [0.0, 0.93])
def test_quantile_of_crowded_groups(spark, q):
    df = spark.range(6000).select(
        (F.col("id") % 3 == 0).cast("int").alias("k"),
        F.when(F.col("id") % 4 == 0, 7.0).otherwise(F.floor(F.rand(1) * 900).cast("double")).alias("value"))
    df = df.unionByName(spark.range(9).select(F.lit(5).alias("k"), F.col("id").cast("double").alias("value")))
    exact = rows(df.groupBy("k").agg(F.percentile("value", F.lit(q)).alias("v")), "k", "v")
    for buckets in (64, 2):
        got = rows(R.quantile(df, q, ["k"], buckets), "k", "value")
        assert [(k, pytest.approx(v)) for k, v in exact] == got
