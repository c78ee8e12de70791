import pytest

from gridsteps.operators import validate as C

VALUES = "variable string, cell long, band int, year int, value double"


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame([("a", "short", 2), ("b", "float", 1)],
                                 "variable string, datatype string, nband int")


def rules(df):
    return sorted((r.rule, r.variable) for r in df.collect())


def dense(spark, cells=(1, 2)):
    return spark.createDataFrame(
        [("a", c, b, 2000, 1.0) for c in cells for b in (0, 1)] + [("b", c, 0, 2000, 0.5) for c in cells], VALUES)


def test_clean(spark, registry):
    assert rules(C.validate(dense(spark), registry, year=2000, ncell=2)) == []


def test_each_rule(spark, registry):
    extra = spark.createDataFrame(
        [("a", 1, 0, 2000, 1.5), ("c", 1, 0, 2000, 1.0), ("b", 1, 0, 2001, 1.0)], VALUES)
    found = rules(C.validate(dense(spark).unionByName(extra), registry, year=2000, ncell=2))
    assert found == [("duplicate", "a"), ("shape", "b"), ("type", "a"), ("unknown", "c"), ("year", "b")]


def test_strict_raises(spark, registry):
    bad = spark.createDataFrame([("c", 1, 0, 2000, 1.0)], VALUES)
    with pytest.raises(Exception):
        C.validate(bad, registry, strict=True).collect()


def test_shape_lenient(spark, registry):
    one_band_short = dense(spark).filter("NOT (variable = 'a' AND band = 1)")
    assert rules(C.check_counts(one_band_short, registry, 2)) == [("shape", "a")]
    assert rules(C.check_counts(one_band_short, registry, 2, lenient=True)) == []
    assert rules(C.check_counts(one_band_short, registry, 3, lenient=True)) == [("shape", "b")]


def test_missing_keys(spark):
    cells = spark.createDataFrame([(1,), (2,)], "cell long")
    bands = spark.createDataFrame([("a", 0), ("a", 1)], "variable string, band int")
    lost = C.check_missing(dense(spark).filter("NOT (cell = 2 AND band = 1)"), cells, bands, ["a"], (2000, 2000))
    assert [(r.cell, r.band, r.year) for r in lost.collect()] == [(2, 1, 2000)]


def test_subannual_and_metadata(spark, registry):
    steps = spark.createDataFrame(
        [("a", 1, b, 2000, s, 1.0) for b in (0, 1) for s in (1, 2)],
        "variable string, cell long, band int, year int, step int, value double")
    assert rules(C.validate(steps, registry)) == [("subannual", "a")]
    meta = spark.createDataFrame([("a", 0.5, 0.5), ("b", 0.5, 0.25)],
                                 "variable string, cellsize_lon double, cellsize_lat double")
    assert rules(C.check_metadata(meta)) == [("cellsize", "b")]


def test_streams(spark):
    one = spark.createDataFrame([("x",)], "name string")
    config = {"ncell": 2, "ninput": 1, "noutput": 1}
    assert rules(C.check_streams(one, one, 2, config)) == []
    assert rules(C.check_streams(one, one.filter("false"), 3, config)) == [
        ("count", "ncell"), ("count", "noutput")]
