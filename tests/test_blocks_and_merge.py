"""Blocks with a border, merges with conflicts, nested private keys, name index, unique dimensions."""

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gridsteps.operators import bands, blocks, combine, cube, inputs, lookup, select, validate
from gridsteps.operators.names import NameIndex
from gridsteps.sources import metadata

CELLS = "variable string, year int, cell long, band int, value double"


def plain_counts(points, radius):
    return {i: sum(abs(x - a) <= radius and abs(y - b) <= radius for _, a, b in points) for i, x, y in points}


def count_near(radius):
    def fn(own, around):
        x, y = (around.column(c).to_numpy() for c in ("lon", "lat"))
        n = [int(((abs(x - a) <= radius) & (abs(y - b) <= radius)).sum())
             for a, b in zip(own.column("lon").to_pylist(), own.column("lat").to_pylist())]
        return pa.table({"cell": own.column("cell"), "n": pa.array(n, pa.int64())})
    return fn


@pytest.mark.parametrize("max_rows", [10_000, 20, 1])
def test_focal_counts_do_not_depend_on_blocks(spark, max_rows):
    rng = random.Random(4)
    points = [(i, rng.uniform(-20, 20), rng.uniform(-9, 9)) for i in range(300)]
    points += [(300 + i, rng.gauss(3.9, 0.4), rng.gauss(0, 0.4)) for i in range(200)]
    points += [(500, 4.0, 0.0), (501, 4.0, 0.0), (502, -4.0, 4.0), (503, 4.75, 0.75)]
    rows = spark.createDataFrame(points, "cell long, lon double, lat double")
    lost = spark.createDataFrame([(900, None, 1.0), (901, float("nan"), 1.0)], rows.schema)
    got = blocks.map_blocks(rows.unionByName(lost), count_near(0.75), "cell long, n long", side=4.0, halo=0.75, max_rows=max_rows).collect()
    assert len(got) == len(points) and {r.cell: r.n for r in got} == plain_counts(points, 0.75)


def test_crowded_blocks_are_cut(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame([(i, rng.uniform(0, 8), rng.uniform(0, 8)) for i in range(2000)], "cell long, lon double, lat double")
    sizes = lambda m: [r["count"] for r in blocks.with_halo(rows, 8.0, 0.5, m).filter("core").groupBy("block").count().collect()]
    assert sizes(10_000) == [2000] and max(sizes(200)) <= 200 and sum(sizes(200)) == 2000
    copies = blocks.with_halo(rows, 8.0, 0.5, 200).filter("NOT core").count()
    assert 0 < copies < 4000
    with pytest.raises(ValueError):
        blocks.most_cuts(1.0, 2.0)


def test_blocks_by_years(spark):
    rows = spark.createDataFrame([(i, 0.5 * i, 0.0, y) for i in range(10) for y in (1, 2) if (i + y) % 2], "cell long, lon double, lat double, year int")

    def fn(own, around):
        assert len(set(around.column("year").to_pylist())) == 1
        return pa.table({"cell": own.column("cell"), "n": pa.array([around.num_rows] * own.num_rows, pa.int64())})

    assert blocks.map_blocks(rows, fn, "cell long, n long", 100.0, 1.0, by=["year"]).agg(F.sum("n")).first()[0] == 50


def test_merge_reports_what_clashes(spark):
    nan = float("nan")
    a = spark.createDataFrame([("v", 2000, 1, 0, 1.0), ("v", 2000, 2, 0, None), ("v", 2000, 3, 0, nan), ("v", 2000, 4, 0, 4.0)], CELLS)
    b = spark.createDataFrame([("v", 2000, 1, 0, 1.0), ("v", 2000, 2, 0, 2.0), ("v", 2000, 4, 0, 5.0), ("w", 2000, 1, 0, None)], CELLS)
    c = spark.createDataFrame([("w", 2001, 1, 0, 7.0), ("w", 2001, 1, 0, 6.0)], CELLS)
    merged, conflicts = combine.merge_datasets([a, b, c])
    assert {(r.variable, r.year, r.cell): r.value for r in merged.collect()} == {
        ("v", 2000, 1): 1.0, ("v", 2000, 2): 2.0, ("v", 2000, 3): None, ("v", 2000, 4): 4.0, ("w", 2000, 1): None, ("w", 2001, 1): 6.0}
    assert {(r.variable, r.cell): (r.n, r.low, r.high, r.part) for r in conflicts.collect()} == {
        ("v", 4): (2, 4.0, 5.0, 0), ("w", 1): (2, 6.0, 7.0, 2)}
    assert combine.merge_datasets([a.filter("false")])[0].count() == 0


def test_repeated_keys_are_an_error(spark):
    twice = spark.createDataFrame([("v", 2000, 1, 0, 1.0), ("v", 2000, 1, 0, 2.0)], CELLS)
    same = spark.createDataFrame([("v", 2000, 1, 0, 1.0), ("v", 2000, 1, 0, 1.0)], CELLS)
    cells = spark.createDataFrame([(1, 0.0, 0.0)], "cell long, lon double, lat double")
    axis = spark.createDataFrame([("v", 0)], "variable string, band int")
    assert cube.to_wide(same, ["v"]).first().v == 1.0
    assert cube.densify(same, cells, axis, ["v"], (2000, 2000)).first().value == 1.0
    for broken in (lambda: cube.to_wide(twice, ["v"]), lambda: cube.densify(twice, cells, axis, ["v"], (2000, 2000))):
        with pytest.raises(Exception, match="different values of one key"):
            broken().collect()


def test_dimensions_have_one_row_per_key(spark):
    values = spark.createDataFrame([("v", 2000, 1, 0, 1.0)], CELLS).withColumn("country_id", F.lit(1)).withColumn("index", F.lit(1)).withColumn("code", F.lit("A"))
    names = spark.createDataFrame([(1, "x", "A", 1)], "id int, name string, code string, index int")
    labels = spark.createDataFrame([("v", 0, "a")], "variable string, band int, band_label string")
    meta = spark.createDataFrame([("v", "l", "u", "s", "h", 0.5, 0.5, "short", 1.0, 2000, 2001)],
                                 "variable string, long_name string, unit string, source string, history string, cellsize_lon double, "
                                 "cellsize_lat double, datatype string, scalar double, firstyear int, lastyear int")
    joins = [
        (lambda d: lookup.code_to_name(values, d), names), (lambda d: lookup.iso_to_name(values, d), names),
        (lambda d: lookup.resolve_variable(values.drop("variable"), d), names), (lambda d: lookup.code_to_iso(values, d, names), names),
        (lambda d: lookup.code_to_iso(values, names, d), names), (lambda d: bands.label_bands(values, d), labels),
        (lambda d: cube.attach_metadata(values, d), meta), (lambda d: cube.apply_scalar(values, d), meta),
        (lambda d: cube.cast_types(values, d), meta), (lambda d: select.clamp_years(values, d, 2000, 2001, 2000), meta)]
    for join, dim in joins:
        assert join(dim).count() == 1
        with pytest.raises(Exception, match="repeated key"):
            join(dim.unionByName(dim)).collect()


def test_variables_without_period_keep_their_years(spark):
    values = spark.createDataFrame([(v, y, 1, 0, 1.0) for v in "abc" for y in range(1990, 2010)], CELLS)
    meta = spark.createDataFrame([("a", 1995, 1996), ("b", None, 1999)], "variable string, firstyear int, lastyear int")
    got = {}
    for r in select.clamp_years(values, meta, 1994, 1997, 1994).collect():
        got.setdefault(r.variable, set()).add(r.year)
    assert got == {"a": {1995, 1996}, "b": {1994, 1995, 1996, 1997}, "c": {1994, 1995, 1996, 1997}}
    alone = select.clamp_years(values, meta.filter("false"), 2001, 2002, 1994)
    assert {r.year for r in alone.collect()} == {2001, 2002} and alone.count() == 6
    broken = validate.check_periods(values, meta.unionByName(meta.filter("variable = 'a'")))
    assert {(r.variable, r.detail) for r in broken.collect()} == {("a", "2"), ("b", "0"), ("c", "0")}


def test_input_keeps_every_cell(spark):
    values = spark.createDataFrame([("a", 2000, 10, 0, 1.0), ("a", 2000, 10, 1, 2.0), ("b", 2000, 11, 0, 3.0)], CELLS)
    points = spark.createDataFrame([(10, 0.0, 0.0), (11, 1.0, 0.0), (12, 2.0, 5.0)], "cell long, lon double, lat double")
    cells = spark.createDataFrame([(1, 0.1, 0.0), (2, 0.9, 0.0), (3, 2.1, 0.0), (4, None, 0.0)], "cell long, lon double, lat double")
    meta = spark.createDataFrame([("a", 2000, 2000)], "variable string, firstyear int, lastyear int")
    labels = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y")], "variable string, band int, band_label string")
    got = {(r.cell, r.variable, r.band): (r.value, r.band_label) for r in inputs.read_input(
        values, meta, labels, points, cells, 2000, 2000).collect()}
    assert got == {(c, v, b): (value if c == at else None, label) for c in (1, 2, 3, 4) for v, b, at, value, label in (
        ("a", 0, 1, 1.0, "x"), ("a", 1, 1, 2.0, "y"), ("b", 0, 2, 3.0, None))}


def test_missing_keys_and_plan(spark):
    values = spark.createDataFrame([("v", -1, 1, 0, 1.0), ("v", 0, 1, 2, 1.0), ("v", 0, 1, 2, 1.0), ("w", 1, 2, 5, 1.0), ("v", 9, 2, 0, 1.0),
                                    ("v", 0, None, 0, 1.0)], CELLS)
    cells = spark.createDataFrame([(1,), (2,)], "cell long")
    axis = spark.createDataFrame([("v", 0), ("v", 2), ("w", 5)], "variable string, band int")
    lost = validate.check_missing(values, cells, axis, ["v", "w"], (-1, 1))
    got = {(r.variable, r.year, r.cell, r.band) for r in lost.collect()}
    every = {(v, y, c, b) for v, b in (("v", 0), ("v", 2), ("w", 5)) for y in (-1, 0, 1) for c in (1, 2)}
    assert got == every - {("v", -1, 1, 0), ("v", 0, 1, 2), ("w", 1, 2, 5)} and lost.count() == len(got)
    plan = lost._jdf.queryExecution().executedPlan().toString()
    assert "year" not in "".join(x for x in plan.split("\n") if "Exchange" in x)


def test_index_and_registry_rules(spark):
    asked = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "index int")
    known = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "index int, name string")
    assert {(r.variable, r.detail) for r in validate.check_index(asked, known).collect()} == {
        ("2", "index of several outputs"), ("3", "index is not supported"), (None, "index is not supported")}
    inputs_ = spark.createDataFrame([("a", 1), ("b", 7), ("c", None), ("d", 4)], "name string, id int")
    registry = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    assert {(r.variable, r.detail) for r in validate.check_coupled(inputs_, registry).collect()} == {
        ("b", "registered with id 2"), ("d", "input is not registered")}


def test_private_keys_of_every_level(spark, tmp_path):
    schema = ("variable string, _p int, ref struct<_secret:int,file:string,deep:array<struct<_x:int,y:int>>>, only struct<_a:int>, "
              "m map<string,struct<_q:int,r:int>>, plain array<int>, gone struct<_b:int,c:int>")
    df = spark.createDataFrame([("v", 1, (2, "f", [(3, 4), None]), (5,), {"k": (6, 7), "_k": (8, 9)}, [1], None)], schema)
    wanted = {"variable": "v", "ref": {"file": "f", "deep": [{"y": 4}, None]}, "only": {}, "m": {"k": {"r": 7}}, "plain": [1]}
    assert json.loads(metadata.as_json(df).first().json) == wanted
    metadata.write_metadata(df, str(tmp_path / "m"))
    text = next((tmp_path / "m").glob("part-*")).read_text()
    assert json.loads(text) == wanted and "_" not in text


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


words = st.text(alphabet=st.sampled_from(list("abcdé 中")), max_size=12) | st.text(alphabet="ab", min_size=60, max_size=75)


@given(st.lists(words, min_size=1, max_size=60), st.lists(words, max_size=8))
@settings(max_examples=80, deadline=None)
def test_name_index_finds_what_all_pairs_give(names, texts):
    pos = [(7 * i) % len(names) if len(names) % 7 else i for i in range(len(names))]
    score, name, scored = NameIndex(names, pos).best(texts)
    for i, t in enumerate(texts):
        rated = [(-(round(100.0 * 2 * plain_lcs(x, t) / (len(x) + len(t))) if x or t else 0), p, j) for j, (x, p) in enumerate(zip(names, pos))]
        best = min(rated)
        assert (-best[0], pos[best[2]]) == (score[i], pos[name[i]]) and 1 <= scored[i] <= len(names) + 1


def test_matching_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    names = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 14))) for _ in range(300)]
    texts = [n[:-1].upper() + "!" for n in names[:80]] + ["", None, "zzz"]
    table = spark.createDataFrame([(i, n, f"C{i}") for i, n in enumerate(names)], "pos int, name string, code string")
    asked = spark.createDataFrame([(t,) for t in texts], "q string")
    whole = {r.query: (r.code, r.score) for r in lookup.fuzzy_match(asked, "q", table).collect()}
    monkeypatch.setattr(lookup, "BLOCK_NAMES", 64)
    monkeypatch.setattr(lookup, "TASK_TEXTS", 9)
    cut = lookup.fuzzy_match(asked, "q", table, report=True).collect()
    assert {r.query: (r.code, r.score) for r in cut} == whole and len(whole) == 82
    assert sum(r.scored for r in cut) < 0.4 * 82 * 300
    assert lookup.fuzzy_match(asked.filter("false"), "q", table).count() == 0
    with pytest.raises(Exception, match="name table is empty"):
        lookup.fuzzy_match(asked, "q", table.filter("false")).collect()
    assert np.isfinite(sum(s for _, s in whole.values()))
